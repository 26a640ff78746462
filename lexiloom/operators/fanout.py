"""Fan-out of rows over field groups and languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import record_id

# The languages of the built-in benchmarks, their codes and scripts.
LANGUAGES = {
    "Assamese": ("as", "Bengali-Assamese"),
    "Bengali": ("bn", "Bengali"),
    "Gujarati": ("gu", "Gujarati"),
    "Hindi": ("hi", "Devanagari"),
    "Kannada": ("kn", "Kannada"),
    "Malayalam": ("ml", "Malayalam"),
    "Marathi": ("mr", "Devanagari"),
    "Nepali": ("ne", "Devanagari"),
    "Odia": ("or", "Odia"),
    "Punjabi": ("pa", "Gurmukhi"),
    "Sanskrit": ("sa", "Devanagari"),
    "Tamil": ("ta", "Tamil"),
    "Telugu": ("te", "Telugu"),
    "Urdu": ("ur", "Perso-Arabic"),
}
# The scripts of further languages, which have no code.
SCRIPTS = {name: script for name, (_, script) in LANGUAGES.items()} | {
    "Bodo": "Devanagari",
    "Dogri": "Devanagari",
    "Kashmiri": "Perso-Arabic",
    "Konkani": "Devanagari",
    "Maithili": "Devanagari",
    "Manipuri": "Meitei Mayek",
    "Odiya": "Odia",
    "Santali": "Ol Chiki",
    "Sindhi": "Perso-Arabic",
    "English": "Latin",
}


def _lookup(table: dict[str, str], name: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name) if pairs else name


def language_code(name: Column, codes: dict[str, str] | None = None) -> Column:
    """The code of a language; the language itself if it has none."""
    return _lookup({n: c for n, (c, _) in LANGUAGES.items()} | (codes or {}), name)


def language_script(name: Column, scripts: dict[str, str] | None = None) -> Column:
    return _lookup(SCRIPTS | (scripts or {}), name)


def fan_out(rows: DataFrame, languages: list[str], groups: int = 1, codes: dict[str, str] | None = None) -> DataFrame:
    """A row for each row, field group and language, in that order, by exploding literal arrays: no join, no shuffle."""
    out = rows.withColumn("group_index", F.explode(F.array(*[F.lit(g) for g in range(groups)])))
    out = out.withColumn("language", F.explode(F.array(*[F.lit(x) for x in languages])))
    return out.withColumn("language_code", language_code(F.col("language"), codes))


def with_record_id(items: DataFrame, benchmark: str) -> DataFrame:
    return items.withColumn("record_id", record_id(F.lit(benchmark), F.col("dataset_config"), F.col("split"), F.col("row_id"), F.col("language"), F.col("group_index")))
