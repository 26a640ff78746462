"""As-of joins: each row with the last row of another table up to its time, within a key.

Both tables are put in one order over the cluster: by key, time, table and a
number that no two rows share, in ranges.  So a key of any size is dealt over
as many ranges as it fills.  In a range the last right row is carried down the
rows of its key; a range begins with what the ranges before it ended with, of
which there is one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.sources.shared import stored


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, keep: list[str] | None = None) -> DataFrame:
    """All rows of `left` with columns of the last row of `right` that has the same `by` and is not later.

    `keep` names the columns of `right` that come along (by default all but `by`);
    none may be a column of left.  Of right rows at one time the largest by the kept
    columns counts.  Rows whose key or time is null match nothing; left rows without
    a match have nulls.
    """
    keep = keep or [c for c in right.columns if c not in by]
    clash = sorted(set(keep) & set(left.columns))
    if clash:
        raise ValueError(f"both tables have columns {clash}; rename them")
    struct = lambda cols: F.struct(*[F.col(f"`{c}`") for c in cols])
    key = lambda cols: F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)])
    r = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*by, right_time])).select(key(by).alias("key"), F.col(f"`{right_time}`").alias("time"), F.lit(0).alias("side"), struct(keep).alias("r"))
    l = left.select(key(by).alias("key"), F.col(f"`{left_time}`").alias("time"), F.lit(1).alias("side"), struct(left.columns).alias("l"))  # noqa: E741
    both = r.withColumn("l", F.lit(None).cast(l.schema["l"].dataType)).unionByName(l.withColumn("r", F.lit(None).cast(r.schema["r"].dataType)))
    both = both.withColumn("row", F.monotonically_increasing_id())
    order = ["key", "time", "side", "r", "row"]
    dealt = stored(both.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "asof")

    known = F.col("time").isNotNull() & F.forall(F.array(*[F.col(f"key.k{i}").isNotNull() for i in range(len(by))]), lambda x: x)
    down = Window.partitionBy("range", "key").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = dealt.withColumn("r", F.last("r", ignorenulls=True).over(down)).where("side = 1")
    ends = dealt.where("side = 0").groupBy("range").agg(F.max(F.struct("key", "time", "r")).alias("end"))  # a row for each range
    before = _ends_before(ends, dealt)
    out = carried.join(before, "range", "left")
    found = F.coalesce("r", F.when(F.col("end.key") == F.col("key"), F.col("end.r")))
    return out.withColumn("r", F.when(known, found)).select("l.*", "r.*")


def _ends_before(ends: DataFrame, dealt: DataFrame) -> DataFrame:
    """For each range the end of the last range before it that has right rows: tables of one row for each range."""
    all_ = dealt.select("range").distinct().join(ends, "range", "left")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return all_.select("range", F.last("end", ignorenulls=True).over(earlier).alias("end"))

