"""Joins whose keys may be lopsided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many of all rows is dealt over several tasks.
SHARE = 512


def heavy_keys(counts: DataFrame, on: list[str], total: int | None = None) -> dict[int, int]:
    """Hashes of the keys with more than one in SHARE of the rows that column n of `counts` counts, and how many such shares each has.

    As the counts sum up to all rows, there are fewer than SHARE such keys.
    `total` is the number of all rows, where it is known without the counts.
    """
    if total is None:
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0]
    parts = F.ceil(F.col("n") * F.lit(SHARE) / F.lit(max(total, 1))).cast("int")
    rows = counts.where(F.col("n") * SHARE > total).select(F.xxhash64(*on).alias("key"), parts.alias("parts")).collect()
    found: dict[int, int] = {}
    for r in rows:
        if r["parts"] > 1:
            found[r["key"]] = max(r["parts"], found.get(r["key"], 0))
    return found


def spread_join(many: DataFrame, few: DataFrame, on: list[str], heavy: dict[int, int], salt: Column, how: str = "inner") -> DataFrame:
    """`many` joined with `few` on keys of which `heavy` are dealt over as many tasks as they have shares.

    `salt` is a number of the row of `many`; rows of `few` with a heavy key are
    repeated, once for each task.  Keys are not null.
    """
    if not heavy:
        return many.join(few, on, how)
    key = F.xxhash64(*on)
    parts = F.when(key.isin(list(heavy)), F.try_element_at(F.create_map(*[F.lit(x) for kv in heavy.items() for x in kv]), key)).otherwise(F.lit(1))
    dealt = many.withColumn("__part", F.pmod(salt, parts).cast("int"))
    few = few.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(few, [*on, "__part"], how).drop("__part")
