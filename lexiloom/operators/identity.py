"""Row identity: positions, ids, keys, fields, units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.canonical import canonical_row
from lexiloom.functions.hashing import uuid5
from lexiloom.sources.shared import stored


def row_index(df: DataFrame, order: list, within: list[str] | None = None, name: str = "row_index") -> DataFrame:
    """0-based position in a stated order, in each unit of `within` if given (null is a unit).

    Without order and units, rows are numbered as their partitions have them and
    nothing is shuffled; else the order is made by a range sort, and positions by counts of the sorted
    partitions, so no task sees all rows, nor all rows of a unit.  The sorted rows
    are stored, so that both uses see the same partitions, and so are the counts: where
    they are small, Spark sends them to the rows, which are not shuffled again.
    """
    keys = list(within or [])
    placed = stored((df.orderBy(*keys, *order) if keys or order else df).withColumn("_at", F.monotonically_increasing_id()), "placed").withColumn("_part", F.shiftright("_at", 33))
    units = {c: f"_u{i}" for i, c in enumerate(keys)}
    sizes = placed.groupBy("_part", *[F.col(c).alias(u) for c, u in units.items()]).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*units.values()).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each sorted partition that has the unit
    base = stored(sizes.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n").withColumnRenamed("_part", "_p"), "bases")
    on = F.col("_part") == F.col("_p")
    for c, u in units.items():
        on = on & placed[c].eqNullSafe(F.col(u))
    out = placed.join(base, on).withColumn(name, (F.col("_base") + F.col("_at") - F.col("_first")).cast("long"))
    return out.select(*df.columns, name) if name not in df.columns else out.select(*[c for c in df.columns if c != name], name)


def disambiguate(df: DataFrame, id_col: str, order: list, name: str = "row_id") -> DataFrame:
    """The n-th repeat of an id gets `#n`, from 1."""
    out, n, own = row_index(df, order, [id_col], "_repeat"), F.col("_repeat"), F.col(f"`{id_col}`").cast("string")
    return out.withColumn(name, F.when(n > 0, F.concat_ws("#", own, n.cast("string"))).otherwise(own)).drop("_repeat")


def numbered_slugs(df: DataFrame, slug_col: str, order: list, name: str = "id") -> DataFrame:
    """The second and later uses of a slug get `-2`, `-3` ..."""
    out, n = row_index(df, order, [slug_col], "_repeat"), F.col("_repeat") + 1
    return out.withColumn(name, F.when(n > 1, F.concat_ws("-", slug_col, n.cast("string"))).otherwise(F.col(slug_col))).drop("_repeat")


def content_id(benchmark: str, config: Column, split: Column, index: Column, content: Column) -> Column:
    """A UUID from a row's place and its canonical JSON, for rows without an id of their own."""
    digest = F.substring(F.sha2(content, 256), 1, 16)
    return uuid5(F.concat_ws("|", F.lit(benchmark), config, split, index.cast("string"), digest))


def attach_row_ids(rows: DataFrame, benchmark: str, config: str, split: str, order: list, id_field: str = "id") -> DataFrame:
    """Add row_index and row_id: the row's own id, or a generated one where it is null or empty, made unique."""
    indexed = row_index(rows, order)
    content = canonical_row(rows.schema, [c for c in rows.columns if not c.startswith("__")])
    made = content_id(benchmark, F.lit(config), F.lit(split), F.col("row_index"), content)
    own = F.col(f"`{id_field}`").cast("string") if id_field in rows.columns else F.lit(None).cast("string")
    named = indexed.withColumn("_id", F.when(own.isNull() | (own == ""), made).otherwise(own))
    renamed = stored(disambiguate(named.select("row_index", "_id"), "_id", ["row_index"]).where(~F.col("row_id").eqNullSafe(F.col("_id"))).select("row_index", "row_id"), "renamed")
    if renamed.isEmpty():  # ids are numbered on their own, and rows meet only those that repeat
        out = named.withColumnRenamed("_id", "row_id")
    else:
        out = named.join(renamed, "row_index", "left").withColumn("row_id", F.coalesce("row_id", "_id")).drop("_id")
    out = out if id_field in rows.columns else out.withColumn(id_field, made)
    return out.select(*[c for c in rows.columns if c not in ("row_index", "row_id")], *([id_field] if id_field not in rows.columns else []), "row_index", "row_id")


def has_path(schema: T.StructType, path: str) -> bool:
    """Whether a column, or a dotted path into structs, is in the schema; a column of that very name wins."""
    if path in schema.fieldNames():
        return True
    head, _, rest = path.partition(".")
    if head not in schema.fieldNames():
        return False
    kind = schema[head].dataType
    return not rest or (isinstance(kind, T.StructType) and has_path(kind, rest))


def missing_fields(schema: T.StructType, paths: list[str]) -> list[str]:
    return [p for p in paths if not has_path(schema, p)]


def path_column(schema: T.StructType, path: str) -> Column:
    """The column at a path; a ValueError that names the columns there are, if there is none."""
    if not has_path(schema, path):
        raise ValueError(f"no field {path!r}; there are {[f for f in schema.fieldNames() if not f.startswith('__')]}")
    return F.col(f"`{path}`") if path in schema.fieldNames() else F.col(".".join(f"`{p}`" for p in path.split(".")))


def field_key(path: str) -> str:
    return path.replace(".", "_")


def group_struct(schema: T.StructType, paths: list[str]) -> Column:
    """The fields of one request as a struct."""
    return F.struct(*[path_column(schema, p).alias(field_key(p)) for p in paths])


def groups_for(spec: list | dict, config: str, split: str) -> list[list[str]]:
    """Field groups of a unit: the entry for config/split, split, config or default, the first there is."""
    if isinstance(spec, list):
        return [list(g) for g in spec]
    for key in (f"{config}/{split}", split, config, "default"):
        if key in spec:
            return [list(g) for g in spec[key]]
    raise ValueError(f"no fields for {config}/{split}")


def resolve_groups(units: DataFrame, spec: DataFrame) -> DataFrame:
    """The same choice as joins: units (config, split) and spec (key, fields) to config, split, matched, fields."""
    keys = F.array(F.concat_ws("/", "config", "split"), F.col("split"), F.col("config"), F.lit("default"))
    tried = units.select("config", "split", F.posexplode(keys).alias("rank", "key"))
    best = tried.join(spec, "key").groupBy("config", "split").agg(F.min_by(F.struct("key", "fields"), "rank").alias("m"))
    return units.join(best, ["config", "split"], "left").select("config", "split", F.col("m.key").alias("matched"), F.col("m.fields").alias("fields"))


def with_unit(df: DataFrame) -> DataFrame:
    """Defaults for a missing dataset config and split."""
    return df.withColumns({"dataset_config": F.coalesce("dataset_config", F.lit("default")), "split": F.coalesce("split", F.lit("train"))})
