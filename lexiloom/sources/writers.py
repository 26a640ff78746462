"""Sinks."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.hashing import row_digest
from lexiloom.functions.text import cell, file_safe
from lexiloom.operators.identity import row_index
from lexiloom.operators.preparation import chunk_of


#: Ordinals of a value that are looked up together when orders are compared.
RUN = 1 << 14


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """JSON lines with nulls kept; `append` is the audit log."""
    (df.coalesce(files) if files else df).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_final(df: DataFrame, path: str, kind: str = "jsonl") -> None:
    if kind not in ("jsonl", "parquet"):
        raise ValueError(f"no output format {kind!r}")
    write_jsonl(df, path) if kind == "jsonl" else df.write.mode("overwrite").parquet(path)


def write_document(spark: SparkSession, row: dict, path: str) -> None:
    """A summary or manifest: one JSON document in a file of the output store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(row, indent=2, ensure_ascii=False, default=str).encode()))
    finally:
        out.close()


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """A spreadsheet: nested values as JSON, null as an empty cell, doubled quotes."""
    flat = df.select(*[cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
    (flat.coalesce(files) if files else flat).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def review_sheet(rows: DataFrame, fields: list[str], human: list[str], rounds: list[int] | None = None) -> DataFrame:
    """The reviewer's columns: source beside translation, scores, and blanks to fill in; `source` and `translation` are structs."""
    from lexiloom.operators.review import round_scores

    rows = round_scores(rows, rounds or [])
    part = lambda s: [F.col(f"{s}.`{f}`").alias(f"{s}_{f}") for f in fields]
    more = [*[f"judge_r{n}_score" for n in rounds or []], *(["best_score", "correction_rounds", "recorrected", "score_history"] if rounds else [])]
    return rows.select("record_id", "row_id", "language", "review_reason", "final_score", "was_corrected", *part("source"), *part("translation"), "final_feedback", "first_score", *more, *[F.lit("").alias(h) for h in human])


def sheet_prefix(path: str) -> str:
    """A name for a spreadsheet that says what it is of without its folders: <benchmark>[_<config>]_<file>, from .../<benchmark>/review/<config>/<file>.csv.

    A config called default, or like the benchmark, is left out; without a review
    folder the file's own folder is the benchmark.
    """
    folders, _, name = path.rstrip("/").rpartition("/")
    steps = [x for x in folders.split("/") if x]
    config = steps[-1] if steps else ""
    benchmark = steps[steps.index("review") - 1] if steps[1:].count("review") else config
    words = [benchmark, config if config not in ("default", benchmark) else "", name.removesuffix(".csv")]
    return re.sub(r"[^A-Za-z0-9._-]+", "_", "_".join(w for w in words if w))


def split_by(df: DataFrame, column: str, path: str) -> DataFrame:
    """One folder of CSV files for each value of a column, which stays in the files; the index of the parts."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("_blank"))
    df.withColumn("part", file_safe(value)).write.mode("overwrite").partitionBy("part").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)
    return split_index(df, column)


def split_index(df: DataFrame, column: str) -> DataFrame:
    """Rows, queued rows and bytes of text for each value."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("_blank"))
    queued = F.count_if(F.coalesce(F.col("review_reason"), F.lit("")) != "") if "review_reason" in df.columns else F.lit(0)
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"), queued.cast("long").alias("queued"), F.sum(size).cast("long").alias("bytes"))


def digests(df: DataFrame, value: str, columns: list[str]) -> DataFrame:
    """How often each row digest occurs for each value."""
    return df.groupBy(F.col(value).alias("value"), row_digest([F.col(f"`{c}`") for c in columns]).alias("digest")).agg(F.count(F.lit(1)).alias("n"))


def verify_split(source: DataFrame, parts: DataFrame, value: str, columns: list[str]) -> DataFrame:
    """Values whose rows differ: value, missing and extra rows.  Empty if the parts are the source, rearranged."""
    a, b = digests(source, value, columns), digests(parts, value, columns).withColumnRenamed("n", "m")
    both = a.join(b, ["value", "digest"], "full").withColumn("d", F.coalesce("n", F.lit(0)) - F.coalesce("m", F.lit(0)))
    out = both.groupBy("value").agg(F.sum(F.greatest("d", F.lit(0))).alias("missing"), F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("extra"))
    return out.where("missing > 0 OR extra > 0")


def ordered(df: DataFrame, value: str, columns: list[str], order: list[str]) -> DataFrame:
    """value, ordinal (within the value, by the order) and digest of each row; stored once, so no uses differ."""
    rows = df.select(F.col(f"`{value}`").alias("value"), *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], row_digest([F.col(f"`{c}`") for c in columns]).alias("digest"))
    return row_index(rows, [f"_o{i}" for i in range(len(order))], ["value"], "ordinal").select("value", "ordinal", "digest")


def order_digests(rows: DataFrame) -> DataFrame:
    """For each value its rows and two digests of `ordered` rows that depend on their order.

    A digest is a sum of hashes of ordinal and row, so those of parts add up to that
    of the whole, however rows are dealt over tasks.
    """
    total = lambda *cols: F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.struct(total("ordinal", "digest"), total("digest", "ordinal")).alias("d"))


def verify_order(source: DataFrame, parts: DataFrame, value: str, columns: list[str], source_order: list[str], parts_order: list[str]) -> DataFrame:
    """Values whose rows are not the same in the same order: value, first_at (ordinal), n_differ, n_missing, n_extra.

    Only rows of values whose digests differ are compared one by one; they are found
    by runs of RUN ordinals, so that no task has all rows of a value.
    """
    a, b = ordered(source, value, columns, source_order), ordered(parts, value, columns, parts_order)
    both = order_digests(a).alias("a").join(order_digests(b).alias("b"), F.col("a.value").eqNullSafe(F.col("b.value")), "full")
    runs = F.sequence(F.lit(0), F.floor(F.greatest("a.n", "b.n") / RUN).cast("int"))
    odd = both.where("NOT a.d <=> b.d").select(F.coalesce("a.value", "b.value").alias("odd"), F.explode(runs).alias("run"))
    few = lambda rows: rows.join(odd, F.col("value").eqNullSafe(F.col("odd")) & (F.floor(F.col("ordinal") / RUN).cast("int") == F.col("run")), "left_semi")
    same = F.col("x.value").eqNullSafe(F.col("y.value")) & (F.col("x.ordinal") == F.col("y.ordinal"))
    rows = few(a).alias("x").join(few(b).alias("y"), same, "full").where("NOT x.digest <=> y.digest")
    rows = rows.select(F.coalesce("x.value", "y.value").alias("value"), F.coalesce("x.ordinal", "y.ordinal").alias("ordinal"), F.col("y.digest").isNull().alias("missing"), F.col("x.digest").isNull().alias("extra"))
    return rows.groupBy("value").agg(F.min("ordinal").alias("first_at"), F.count(F.lit(1)).alias("n_differ"), F.count_if("missing").cast("long").alias("n_missing"), F.count_if("extra").cast("long").alias("n_extra"))


def write_chunks(requests: DataFrame, path: str, size: int = 50_000, near: bool = False) -> None:
    """Request lines (ordinal, line) in folders chunk=<n> of at most `size` lines each, in order.

    Where rows of near ordinals are near one another, they are not shuffled; a chunk
    that two tasks have is two files then.
    """
    chunked = requests.withColumn("chunk", chunk_of(F.col("ordinal"), size))
    (chunked if near else chunked.repartition("chunk")).sortWithinPartitions("chunk", "ordinal").select("chunk", "line").write.partitionBy("chunk").option("lineSep", "\n").text(path)
