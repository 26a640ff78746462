"""The queries over the test tables, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["translate_summary"](spark, sf_dir)


def n():
    return F.count(F.lit(1)).alias("n")


from lexiloom.plans import queries_prepare, queries_review, queries_stages  # noqa: E402, F401  they register their queries here
