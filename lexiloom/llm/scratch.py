"""Tables and checkpoints in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexiloom.sources.shared import new_path, shared_folder
from lexiloom.sources.shared import stored as written

__all__ = ["cut", "new_path", "shared_folder", "written"]


def cut(df: DataFrame) -> DataFrame:
    """The rows of a small state table with its lineage cut by a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
