"""A training corpus from `documents`: quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept.  All but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import minhash, packing, quality, substrings
from lexiloom.llm.scratch import written

#: Words of a shingle and least similarity in per cent of near-duplicates; words of a repeated passage; ids of a sequence.
SHINGLE, SIMILAR, PASSAGE, SEQUENCE = 5, 80, 35, 2048


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, gives a good grade with probability 0.5 or more.

    Null and empty texts are scored like others, by their empty set of words.
    Repeated rows and null ids are rows of their own; a row with exactly the
    bound is kept.  Without usable labels every row stays.
    """
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest doc_id (null last), of each group of near-duplicates.

    Rows that repeat a doc_id or have none count each for itself; between rows of
    one doc_id the least content stays.  Null, empty and blank texts are near no
    other and stay.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # so that no name of another column matters
    doc_id, text = (f"c{names.index(c)}" for c in ("doc_id", "text"))
    keyed = written(plain.withColumn("row_key", F.monotonically_increasing_id()), "keyed")
    groups = minhash.near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), F.col(text).alias("text")), k=SHINGLE, percent=SIMILAR)
    ids = keyed.select("row_key", F.col(doc_id).alias("id"), F.xxhash64(*plain.columns).alias("content"))
    of = groups.select(F.col("doc_id").alias("row_key"), "component_id").join(ids, "row_key")
    order = F.struct(F.col("id").isNull(), "id", "content", "row_key")
    stay = of.groupBy("component_id").agg(F.min_by("row_key", order).alias("row_key")).select("row_key")
    return keyed.join(stay, "row_key", "left_semi").select(*plain.columns).toDF(*names)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages that repeat: texts that lose words are the rest joined by one space; n_chars follows.

    Null, empty and blank texts stay as they are.  Rows that repeat a doc_id or
    have none are places of their own.
    """
    names = docs.columns
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(names)])
    cut, n_chars = substrings.without_repeats(plain, PASSAGE), f"c{names.index('n_chars')}"
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(n_chars))
    return cut.withColumn(n_chars, size.cast(docs.schema["n_chars"].dataType)).select(*plain.columns).toDF(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences; null and empty texts are their end id alone, equal rows are documents of their own."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0, capacity=SEQUENCE)


STAGES = [("quality", good_quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", pack)]

#: The classifier and the genetic algorithm are beyond SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`, each result written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
