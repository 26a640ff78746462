"""Assembly of the wide parallel dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_name(template: str, field: str, language: str, code: str) -> str:
    return template.format(field=field, language=language, code=code, language_code=code)


def wide(rows: DataFrame, best: DataFrame, fields: list[str], languages: dict[str, str], template: str = "{field}_{language}", keep: bool = True, quality: bool = False) -> DataFrame:
    """Rows with a column for each field and language.

    `best` has row_id, language and a column for each field (and stage and score
    with `quality`).  Names and languages are known, so this is one aggregation of
    conditional maxima by row_id and one join, without a pivot's distinct scan.
    """
    names = {}
    for language, code in languages.items():
        here = F.col("language") == language
        for f in fields:
            names[column_name(template, f, language, code)] = F.max(F.when(here, F.col(f)))
        if quality:
            names[f"stage_{code}"], names[f"score_{code}"] = F.max(F.when(here, F.col("stage"))), F.max(F.when(here, F.col("score")))
    pivoted = best.groupBy("row_id").agg(*[c.alias(n) for n, c in names.items()])
    base = rows if keep else rows.select("row_id", "row_index")
    return base.join(pivoted, "row_id", "left")


def missing(slots: DataFrame, best: DataFrame) -> DataFrame:
    """Slots (record_id, row_id, language, group_index, fields) without a usable record."""
    return slots.join(best.select("record_id"), "record_id", "left_anti")
