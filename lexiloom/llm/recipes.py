"""Exact dedup by recipes of content-defined chunks, with DataFrame expressions only.

A text is cut where the bytes before a place look alike in every text: the last
WINDOW bytes must each be in a set of a quarter of each kind of byte, a set of its
own for each place in the window.  So equal passages of different texts are cut
alike, whatever stands before them.  A chunk has LEAST to MOST bytes (the last
one of a text may be shorter).

Chunks are identified by their hash, and each hash is verified on the chunks
themselves: all distinct chunks are gathered once, and where a hash stands for
more than one chunk, these are numbered and the number becomes part of the
identifier.  Texts are equal when their ordered lists of identifiers are.  A
text is moved once, as distinct chunks; after that only its list is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import let
from lexiloom.llm.scratch import written
from lexiloom.llm.skew import heavy_keys, spread_join

#: Bytes that decide on a cut, and the least and most bytes of a chunk.
WINDOW, LEAST, MOST = 5, 256, 8192


def _mixed(place: int, byte: int) -> int:
    x = (byte + 1) * 0x9E3779B1 ^ (place + 1) * 0x85EBCA6B
    return ((x ^ x >> 15) * 0xC2B2AE35 >> 9) & 0xFFFF


def _quarter(place: int) -> str:
    """A character class of a quarter of each kind of byte, by a hash of place and value; bytes that begin a longer character are all in it."""
    kinds = [range(0x20), b" ", b"0123456789", *[[b for b in range(0x21, 0x7F) if test(chr(b))] for test in (str.islower, str.isupper, lambda c: not c.isalnum())], range(0x80, 0xC0)]
    chosen = set(range(0xC0, 0x100))
    for kind in kinds:
        most = (len(kind) + 2 + place % 2) // 4  # of ten digits two or three
        chosen.update(sorted(kind, key=lambda b: _mixed(place, b))[:most])
    return "[" + "".join(f"\\x{b:02x}" for b in sorted(chosen)) + "]"


#: From LEAST bytes on to the first place for a cut; else MOST bytes, or what is left.
CHUNK = f"(?s).{{{LEAST - WINDOW},{MOST - WINDOW}}}?{''.join(map(_quarter, range(WINDOW)))}|.{{1,{MOST}}}"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty.

    Plain replacements scan a text many times faster than a pattern does, and few
    texts have runs.
    """
    out = F.coalesce(text.cast("string"), F.lit(""))
    for blank in "\t\n\x0b\f\r":
        out = F.replace(out, F.lit(blank), F.lit(" "))
    return let(out, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, "  +", " ")).otherwise(t))


def chunks(text: Column) -> Column:
    """The chunks of a text, as strings with one character for each byte; joined they are the text."""
    return F.regexp_extract_all(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), F.lit(CHUNK), F.lit(0))


def _with_ranks(recipes: DataFrame, clashes: DataFrame) -> DataFrame:
    """`ids` with, for chunks whose hash stands for several, the number of the chunk among them."""
    at = recipes.select("row_key", F.posexplode("chunks").alias("at", "chunk"), "ids").withColumn("hash", F.element_at("ids", F.col("at") + 1))
    found = at.drop("ids").join(clashes, ["hash", "chunk"]).groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("at", "rank"))).alias("ranks"))
    ranked = F.transform("ids", lambda h, i: F.struct(h.alias("hash"), F.coalesce(F.try_element_at("ranks", i), F.lit(0)).alias("rank")))
    return recipes.join(found, "row_key", "left").withColumn("ids", ranked).drop("ranks")


def exact_duplicates(docs: DataFrame, name: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    keep_id is the least doc_id of the rows with an equal text (null only if all
    are null).  Exactly one row of each group is kept: of rows that repeat the
    least doc_id, any one.  Null and empty texts are equal; all texts of
    white space alone are one space.  Other columns, whatever their names,
    are not read.  `name` names a chunk by a long and may clash.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    cut = src.select("doc_id", F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text")).alias("chunks"))
    made = written(cut.select(F.monotonically_increasing_id().alias("row_key"), "*", F.transform("chunks", lambda c: name(c)).alias("ids")), "recipes")

    distinct = made.select(F.explode(F.arrays_zip("ids", "chunks")).alias("c")).select(F.col("c.ids").alias("hash"), F.col("c.chunks").alias("chunk")).distinct()
    several = distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    several = written(several, "clashes")
    if several.isEmpty():  # each hash is proven to be one chunk
        recipes = made.drop("chunks")
    else:
        clashes = distinct.join(several, "hash", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))
        recipes = written(_with_ranks(made, clashes).drop("chunks"), "verified")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    groups = written(recipes.groupBy("ids").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "groups")
    few = groups.select("ids", F.col("first.doc_id").alias("keep_id"), F.col("first.row_key").alias("keep_key"), F.col("n").alias("group_size"))
    rows = spread_join(recipes, few, ["ids"], heavy_keys(groups, ["ids"]), F.col("row_key"))
    return rows.select("doc_id", "keep_id", "group_size", (F.col("row_key") == F.col("keep_key")).alias("kept"), "text_sha256", F.size("ids").alias("n_chunks"))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text no other row with a smaller doc_id has: the texts that stay, with all their columns.

    Of equal rows one stays; see `exact_duplicates` for nulls and empty texts.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    keyed = written(plain.withColumn("row_key", F.monotonically_increasing_id()), "keyed")
    groups = exact_duplicates(keyed.select(F.col("row_key").alias("doc_id"), F.col(text).alias("text")))
    of = groups.select(F.col("doc_id").alias("row_key"), F.col("keep_id").alias("class_id"))
    ids = keyed.select("row_key", F.col(doc_id).alias("id")).join(of, "row_key")
    stay = ids.groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row_key")).alias("m")).select("m.row_key")
    return keyed.join(stay, "row_key", "left_semi").select(*plain.columns).toDF(*docs.columns)


def op11(spark, sf_dir: str) -> DataFrame:
    """See exact_duplicates."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("n_chunks")


OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
