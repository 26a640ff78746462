"""Preparation of sources: filters, counts, checks, sections of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.text import is_blank, strip


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def keep_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with one of the values; none for an empty list."""
    return df.where(F.col(column).isin(*values) if values else F.lit(False))


def drop_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows other than those of a value; nulls stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def keep_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_blank(F.coalesce(F.col(column).cast("string"), F.lit(""))))


def blank_ids(df: DataFrame, id_col: str, columns: list[str], n: int = 5) -> DataFrame:
    """The first ids of rows with a blank column, for a report."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | is_blank(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return df.where(bad).select(id_col).orderBy(id_col).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def uniqueness(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(column).alias("n_distinct"), (F.count(F.lit(1)) == F.count_distinct(column)).alias("is_unique"))


def longest(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(F.length(column)).cast("long").alias("longest"))


def edited_by_strip(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(strip(F.col(column)) != F.col(column)).cast("long").alias("edited"))


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """`column.x` becomes `column_x`."""
    fields = df.schema[column].dataType.fieldNames()
    return df.select(*[c for c in df.columns if c != column], *[F.col(f"{column}.`{f}`").alias(f"{column}_{f}") for f in fields])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep and rename the named columns; an error names those that are missing."""
    lost = [c for c in names if c not in df.columns]
    if lost:
        raise ValueError(f"missing columns {lost}")
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()])


def positional_id(df: DataFrame, prefix: Column, index: str = "row_index", name: str = "id") -> DataFrame:
    return df.withColumn(name, F.concat_ws("-", prefix, F.format_string("%04d", F.col(index))))


def chunk_of(ordinal: Column, size: int) -> Column:
    return F.floor(ordinal / size).cast("long")


def tag_stream(df: DataFrame, key: str, page: str, pattern: str) -> DataFrame:
    """A row for each match of a pattern (group 1: what to keep) in a page, with its place among the matches."""
    return df.select(key, F.posexplode(F.regexp_extract_all(page, F.lit(pattern), F.lit(1))).alias("place", "tag"))


def div_depth(df: DataFrame, key: str, page: str) -> DataFrame:
    """Nesting depth after each div tag of a page: key, place, delta, depth."""
    tags = tag_stream(df, key, page, r"(<div\b|</div>)")
    w = Window.partitionBy(key).orderBy("place")
    return tags.withColumn("delta", F.when(F.col("tag") == "</div>", -1).otherwise(1)).withColumn("depth", F.sum("delta").over(w)).drop("tag")


def first_close(depths: DataFrame, key: str) -> DataFrame:
    """The place where the first div of each page closes; null if it never does."""
    return depths.groupBy(key).agg(F.min(F.when(F.col("depth") == 0, F.col("place"))).alias("closed_at"))


def section_of(df: DataFrame, key: str, page: str, heading: str, item: str) -> DataFrame:
    """Each item tag of a page with the number of the last heading before it (0: none)."""
    tags = tag_stream(df, key, page, rf"(<{heading}\b|<{item}\b)")
    w = Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    out = tags.withColumn("section", F.sum(F.when(F.col("tag") == f"<{heading}", 1).otherwise(0)).over(w))
    return out.where(F.col("tag") == f"<{item}").drop("tag")


def typed_json(df: DataFrame, column: str, kind: T.StructType | str) -> DataFrame:
    return df.withColumn(column, F.from_json(column, kind))


def prepared_facts(df: DataFrame, id_col: str, columns: list[str], held: Column) -> DataFrame:
    """What a prepared table should show, as counts of rows that do not: a filter that is not held, a blank column, an id made unique by a `#` and a number, an id that others have."""
    blank = F.lit(False)
    for c in columns:
        blank = blank | is_blank(F.coalesce(F.col(c).cast("string"), F.lit("")))
    ids = F.col(id_col).cast("string")
    ends = F.coalesce(ids.rlike("#[0-9]+$"), F.lit(False))
    n = lambda x: F.count_if(x).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), n(~F.coalesce(held, F.lit(False))).alias("not_held"), n(blank).alias("blank"), n(ends).alias("suffixed"), (F.count(F.lit(1)) - F.count_distinct(ids)).alias("repeated"))
