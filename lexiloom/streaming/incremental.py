"""Structured Streaming over stage records: judge what is new, sum usage by event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """New files of a folder as a stream; each is read once."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def run_available(stream: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Apply a stage to all that has arrived and stop.

    Each micro-batch is written to a folder of its number, overwritten if it is
    repeated after a failure, so its records count once.
    """

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_of_each(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Rows without repeats of a key within the time that the watermark keeps."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def usage_windows(stream: DataFrame, time: str, keys: list[str], value: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts and sums by window of event time and keys; a window is given out once it is past the watermark."""
    w = F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")
