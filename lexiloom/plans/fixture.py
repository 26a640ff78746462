"""A deterministic run over `documents`: what a model would answer, without one.

Documents are the source benchmark, their language the split.  Every document
is fanned out over the languages.  Scores are hashes of the record id and the
round; corrections exist where the first score is at most FIXED.  The same
relations are written as SQL in BASE.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators.fanout import LANGUAGES, fan_out, language_script, with_record_id

FIXED, THRESHOLD, FAILING = 70, 98, 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fake_score(record_id: Column, round_: int) -> Column:
    return (F.conv(F.substring(F.md5(F.concat(record_id, F.lit(f"|j{round_}"))), 1, 4), 16, 10).cast("long") % 101).cast("double")


def items(spark: SparkSession, sf_dir: str, texts: bool = False) -> DataFrame:
    """Work items: doc_id, split, row_id, language, language_code, script, group_index, record_id (and text)."""
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", F.lit("default").alias("dataset_config"), F.col("lang").alias("split"), F.col("doc_id").cast("string").alias("row_id"), *(["text"] if texts else []))
    return with_record_id(fan_out(rows, list(LANGUAGES)), "docs").withColumn("script", language_script(F.col("language")))


def model(answer: Callable[[str, str, int], str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A backend that answers answer(key, prompt, attempt); tokens are characters."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            text = [answer(k, p, int(a)) for k, p, a in zip(f["key"], f["prompt"], f["attempt"], strict=True)]
            i, o = f["prompt"].str.len(), pd.Series([len(t) for t in text], index=f.index)
            yield pd.DataFrame({"key": f["key"], "text": text, "error": None, "input_tokens": i, "output_tokens": o, "reasoning_tokens": 0, "total_tokens": i + o})

    return run


def translator(key: str, prompt: str, attempt: int) -> str:
    """Prose on the first attempt for every seventh document, else what follows the prompt's first line, marked with its language."""
    if attempt == 1 and int(key.split("|")[3]) % 7 == 0:
        return "I cannot help with that."
    head, _, body = prompt.partition("\n")
    return json.dumps({"text": f"[{head.removeprefix('Translate into ').rpartition(' (')[0]}] {body}"}, ensure_ascii=False)


def task(key: str, prompt: str, attempt: int) -> str:
    """Answers a prompt that ends in TASK <stage> <json>: translations are the values with a mark, scores hashes of the key."""
    kind, _, body = prompt.rpartition("TASK ")[2].partition(" ")
    if kind == "judge":
        return json.dumps({"score": int(hashlib.md5(key.encode()).hexdigest()[:4], 16) % 101, "feedback": "seen"})
    if kind == "translate" and attempt == 1 and int(key.split("|")[3]) % 7 == 0:
        return "I cannot help with that."
    return json.dumps({k: f"[{kind}] {v}" for k, v in json.loads(body).items()}, ensure_ascii=False)


def count_characters(prompt: str, settings: dict) -> dict:
    if not prompt:
        raise ValueError("empty")
    return {"text": str(len(prompt)), "input_tokens": len(prompt) % 97, "output_tokens": 0, "reasoning_tokens": 0, "total_tokens": len(prompt) % 97}


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rounds' judgements in one row for each work item: score_1, fixed, score_2."""
    i = items(spark, sf_dir)
    i = i.withColumn("score_1", fake_score(F.col("record_id"), 1))
    return i.withColumns({"fixed": F.col("score_1") <= FIXED, "score_2": fake_score(F.col("record_id"), 2)})


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stage records: one translation, a correction where there is one, two judgements for each work item."""
    j = judged(spark, sf_dir)
    text = lambda s: F.concat(F.lit("["), F.col("language"), F.lit(f"] {s} "), F.col("row_id"))
    none = F.lit(None)

    def record(stage, round_, position, translation, score, of_stage, of_round):
        return F.struct(
            F.lit(stage).alias("stage"), F.lit(round_).alias("round"), F.lit(position).cast("long").alias("position"), translation.cast("string").alias("translation"),
            score.cast("double").alias("score"), (score >= THRESHOLD).alias("passed"), F.when(score.isNotNull(), F.lit("seen")).alias("feedback"), of_stage.cast("string").alias("translation_stage"), of_round.cast("int").alias("translation_round"),
        )

    fixed = F.col("fixed")
    all_ = F.array(
        record("translate", 0, 0, text("t"), none.cast("double"), none, none),
        record("judge", 1, 1, none, F.col("score_1"), F.lit("translate"), F.lit(0)),
        record("correct", 1, 2, F.when(fixed, text("c")), none.cast("double"), none, none),
        record("judge", 2, 3, none, F.col("score_2"), F.when(fixed, "correct").otherwise("translate"), F.when(fixed, 1).otherwise(0)),
    )
    keep = F.filter(all_, lambda r: (r["stage"] != "correct") | r["translation"].isNotNull())
    return j.select("record_id", "dataset_config", "split", "row_id", "language", F.lit(True).alias("valid"), F.explode(keep).alias("r")).select("record_id", "dataset_config", "split", "row_id", "language", "valid", "r.*")


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A usage row for each work item of the translate stage, and for each judgement and correction."""
    j = judged(spark, sf_dir)
    stage = F.array(F.struct(F.lit("translate").alias("stage"), F.lit(0).alias("round")), F.struct(F.lit("judge").alias("stage"), F.lit(1).alias("round")), F.struct(F.lit("correct").alias("stage"), F.lit(1).alias("round")))
    u = j.withColumn("s", F.explode(stage)).where((F.col("s.stage") != "correct") | F.col("fixed")).select("*", "s.*")
    i, o, r = F.length("record_id").cast("long") * (F.col("round") + 1), F.col("score_1").cast("long") + 20, F.col("doc_id") % 10
    u = u.withColumns({"input_tokens": i, "output_tokens": o, "reasoning_tokens": r, "total_tokens": i + o + r, "mode": F.when(F.col("doc_id") % 2 == 0, "batch").otherwise("parallel")})
    return u.select("dataset_config", "split", "language", "stage", "round", "mode", "input_tokens", "output_tokens", "reasoning_tokens", "total_tokens", (F.col("total_tokens") / 1000).alias("cost_usd"))


def _hex(expr: str, n: int) -> str:
    return "(" + " + ".join(f"(strpos('0123456789abcdef', substr({expr}, {i + 1}, 1)) - 1) * {16 ** (n - 1 - i)}" for i in range(n)) + ")"


_LANG = ", ".join(f"('{n}', '{c}', '{s}')" for n, (c, s) in LANGUAGES.items())
#: The relations lang, items, judged, records and usage as DuckDB SQL, for a WITH clause.
BASE = f"""lang(language, code, script) AS (VALUES {_LANG}),
items AS (SELECT doc_id, 'default' AS dataset_config, lang AS split, doc_id::VARCHAR AS row_id, language, code AS language_code, script,
  concat_ws('|', 'docs', 'default', lang, doc_id::VARCHAR, language, 'g0') AS record_id, text FROM documents CROSS JOIN lang),
judged AS (SELECT *, score_1 <= {FIXED} AS fixed FROM (SELECT *, ({_hex("md5(record_id || '|j1')", 4)} % 101)::DOUBLE AS score_1,
  ({_hex("md5(record_id || '|j2')", 4)} % 101)::DOUBLE AS score_2 FROM items)),
usage AS (SELECT *, input_tokens + output_tokens + reasoning_tokens AS total_tokens, (input_tokens + output_tokens + reasoning_tokens) / 1000.0::DOUBLE AS cost_usd FROM (
  SELECT dataset_config, split, language, stage, round, CASE WHEN doc_id % 2 = 0 THEN 'batch' ELSE 'parallel' END AS mode,
    (length(record_id) * (round + 1))::BIGINT AS input_tokens, score_1::BIGINT + 20 AS output_tokens, doc_id % 10 AS reasoning_tokens
  FROM judged CROSS JOIN (VALUES ('translate', 0), ('judge', 1), ('correct', 1)) s(stage, round) WHERE stage <> 'correct' OR fixed))"""
