"""Connected components by alternating large and small stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import cut


def _ends(e: DataFrame) -> DataFrame:
    """Each edge from both of its ends: (u, v)."""
    both = F.array(F.struct(F.col("child").alias("u"), F.col("parent").alias("v")), F.struct(F.col("parent").alias("u"), F.col("child").alias("v")))
    return e.select(F.explode(both).alias("x")).select("x.u", "x.v")


def _stars(e: DataFrame) -> bool:
    """Whether each id hangs below one parent at most, and no parent hangs below another."""
    ends = _ends(e).groupBy("u").agg(F.count_if(F.col("v") < F.col("u")).alias("up"), F.count_if(F.col("v") > F.col("u")).alias("down"))
    return ends.where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of long ids to (id, component): the smallest id that links reach, for each id with a link.

    Each round hangs the larger neighbours of an id, then the smaller, below its
    smallest neighbour; rounds grow with the logarithm of the longest chain, and
    there is none over links that are stars.
    Self links and repeated links change nothing; nulls link with nothing.
    """
    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct())
    while not _stars(e):
        least = _ends(e).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = e.withColumnRenamed("parent", "u").join(least, "u").select("child", F.col("m").alias("parent"))
        small = large.join(large.groupBy("child").agg(F.min("parent").alias("m")), "child")
        hung = F.array(F.col("child"), F.when(F.col("parent") > F.col("m"), F.col("parent")))
        e = cut(small.select(F.explode(hung).alias("child"), F.col("m").alias("parent")).where("child IS NOT NULL").distinct())
    roots = e.select(F.col("parent").alias("id"), F.col("parent").alias("component")).distinct()
    return e.select(F.col("child").alias("id"), F.col("parent").alias("component")).union(roots)
