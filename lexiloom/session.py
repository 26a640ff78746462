"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that fix results (time zone, map merging) or let Spark re-plan at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; keyword settings use __ for dots."""
    builder = SparkSession.builder.appName("lexiloom")
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
