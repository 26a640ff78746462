"""Where texts hold passages: one automaton over many passages, run once over each text.

Passages are dealt into shards of a bounded size.  A shard's automaton
(Aho-Corasick) has the first characters of its passages; where it finds some,
the passages that begin so are compared whole, by their lengths.  Texts stay
where they are: each shard is sent to the tasks, nothing is joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of passages in a shard (twice as many at most), and of those that the automaton has of each.
SHARD, ANCHOR = 4_000_000, 32


class Finder:
    """Finds passages (item, text) in texts."""

    def __init__(self, passages: list[tuple[int, str]]):
        import ahocorasick

        self.begin: dict[str, dict[int, dict[str, list[int]]]] = {}
        self.empty = [i for i, p in passages if not p]
        for item, passage in passages:
            if passage:
                self.begin.setdefault(passage[:ANCHOR], {}).setdefault(len(passage), {}).setdefault(passage, []).append(item)
        self.automaton = ahocorasick.Automaton()
        for anchor in self.begin:
            self.automaton.add_word(anchor, anchor)
        if self.begin:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """The first place of each passage that the text holds; an empty passage is at 0."""
        found = dict.fromkeys(self.empty, 0)
        for end, anchor in self.automaton.iter(text) if self.begin else ():
            start = end - len(anchor) + 1
            for size, whole in self.begin[anchor].items():
                for item in whole.get(text[start : start + size], ()):
                    found.setdefault(item, start)
        return found


_FINDERS: dict[str, Finder] = {}


def _search(name: str, shard) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _FINDERS:
            _FINDERS.clear()  # one shard at a time
            _FINDERS[name] = Finder(shard.value)
        find = _FINDERS[name].find
        for batch in batches:
            out = [(item, doc, at) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for item, at in find(text).items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ()))], ["item_id", "doc_id", "at"])

    return run


def shards(passages: DataFrame, size: int = SHARD) -> list[DataFrame]:
    """Passages (item_id, text) dealt out by a hash, into shards of at most twice so many characters unless one passage alone has more."""
    longest, total = passages.agg(F.coalesce(F.max(F.length("text")), F.lit(0)), F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()
    n = max(1, -(-total // size))
    while True:
        dealt = passages.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        most = dealt.groupBy("shard").agg(F.sum(F.length("text") + 1).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= max(2 * size, 2 * longest):
            return [dealt.where(F.col("shard") == i).drop("shard") for i in range(n)]
        n *= 2


def held_passages(docs: DataFrame, passages: DataFrame, size: int = SHARD) -> DataFrame:
    """(item_id, doc_id, at) where the text of a document holds the text of a passage, with its first place in characters from 0.

    `docs` has doc_id and text, `passages` item_id and text; nulls hold nothing and
    are held by nothing, an empty passage is held by every text.  Rows that repeat
    a doc_id, or an item_id with another text, count each for itself; of rows that
    repeat both once.  The driver has one shard at a time, of a bounded size.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    p = passages.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    out = None
    for shard in shards(p, size):
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in shard.collect()])
        found = d.mapInArrow(_search(uuid.uuid4().hex, sent), "item_id long, doc_id long, at long")
        out = found if out is None else out.unionByName(found)
    return out
