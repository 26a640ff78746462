"""Substring dedup by seed and extend.

Seeds are winnowed anchors: in every window of `length` consecutive words the
run of SEED words with the least hash (the rightmost of equals).  Equal windows
have equal anchors, so two places can share a window only if they share an
anchor.  Documents are joined on their anchors, and those that occur at one
place alone drop out.  At each place that is left the anchor is extended to both
sides, by 0 to length - SEED words to the left and the rest to the right, to the
windows that it anchors; extensions that match those of another place are
matches, and matches that overlap or touch join into maximal repeats.

Copies of whole stretches would give a row for each word and copy.  Stretches
between sparse anchors (with the words that complete their last window) are
therefore matched first: of equal stretches one, the least place, stands for
all in the extension.  Of equal texts one stands for all from the start.  Counts
are aggregated before they are shuffled, no pairs of places are formed, and a
passage in a third of all rows costs one row for each place it stands in, dealt
over many tasks.

Rows have a number of their own; texts are compared by two 64-bit hashes, words
and windows by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm import words as W
from lexiloom.llm.scratch import written
from lexiloom.llm.skew import heavy_keys, spread_join

SEED = 8
#: One anchor in so many, by hash, bounds a stretch.
SPARSE = 8
_FIRST = "rid long, k0 long, k1 long, doc_id long, n_words int, whole string, anchors array<long>, places array<int>, stretches array<long>, starts array<int>, ends array<int>"
_SPANS = "array<struct<start: int, end: int>>"


def anchor_of(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of SEED words, and for each window of `length` words the place of its anchor."""
    seeds, width = W.run_hashes(words, SEED, 801), length - SEED + 1
    n = len(words) - length + 1
    if n <= 0:
        return seeds, np.zeros(0, np.int64)
    key = (seeds & W.U64(0xFFFFFFFF00000000)) | (W.U64(0xFFFFFFFF) - np.arange(len(seeds), dtype=W.U64))
    step = 1
    while step * 2 <= width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if step < width:
        key = np.minimum(key[: n], key[width - step : width - step + n])
    return seeds, (W.U64(0xFFFFFFFF) - (key[:n] & W.U64(0xFFFFFFFF))).astype(np.int64)


def _stretches(words: np.ndarray, seeds: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of window starts between sparse anchors, with a hash of all words that their windows hold."""
    n = len(words) - length + 1
    sparse = places[(seeds[places] >> W.U64(7)) % W.U64(SPARSE) == 0]
    starts = np.unique(np.concatenate([[0], sparse[sparse < n]])).astype(np.int64)
    ends = np.append(starts[1:], n)
    out = np.empty(len(starts), W.U64)
    powers = W._UP if n + length < len(W._UP) else W._powers(W._RADIX, n + length + 1)
    run = np.zeros(len(words) + 1, W.U64)
    np.cumsum(W.mix(words) * powers[: len(words)], out=run[1:])
    inverse = W._DOWN if n + length < len(W._DOWN) else W._powers(W._INVERSE, n + length + 1)
    span = ends + length - 1
    out = W.mix((run[span] - run[starts]) * inverse[starts] + (span - starts).astype(W.U64) * W.U64(0x9E3779B97F4A7C15))
    return out, starts, ends


def _scan(length: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text"):
                data, at = W.flat(part.column("text"))
                start, end, of = W.word_bounds(data, at)
                hashes = W.word_hashes(data, start, end, fold=False)
                raw, lists = data.tobytes(), [[] for _ in range(5)]
                sizes, whole = np.zeros((2, part.num_rows + 1), np.int64), []
                for i in range(part.num_rows):
                    lo, hi = int(of[i]), int(of[i + 1])
                    whole.append(hashlib.sha256(b" ".join(raw[at[i] : at[i + 1]].split())).hexdigest())
                    words = hashes[lo:hi]
                    seeds, anchor = anchor_of(words, length)
                    if len(anchor):
                        places = anchor[np.flatnonzero(np.diff(anchor, prepend=-1))]
                        found = (seeds[places], places, *_stretches(words, seeds, places, length))
                        for k, x in enumerate(found):
                            lists[k].append(x)
                        sizes[0, i + 1], sizes[1, i + 1] = len(places), len(found[2])
                joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in lists]
                few, many = np.cumsum(sizes[1]), np.cumsum(sizes[0])
                ints = lambda x: pa.array(x.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rid", "k0", "k1", "doc_id")), pa.array(np.diff(of).astype(np.int32)), pa.array(whole, pa.string()),
                     W.lists(W.longs(joined[0]), many), W.lists(ints(joined[1]), many),
                     W.lists(W.longs(joined[2]), few), W.lists(ints(joined[3]), few), W.lists(ints(joined[4]), few)],
                    ["rid", "k0", "k1", "doc_id", "n_words", "whole", "anchors", "places", "stretches", "starts", "ends"],
                )

    return scan


def _extend(length: int):
    """(rid, text, marked, skip) to the windows that extend a marked anchor and that no other stretch stands for."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text", 2 << 20):
                data, at = W.flat(part.column("text"))
                start, end, of = W.word_bounds(data, at)
                hashes = W.word_hashes(data, start, end, fold=False)
                values, sizes, where = [np.zeros(0, W.U64)], np.zeros(part.num_rows + 1, np.int64), [np.zeros(0, np.int64)]
                for i, (marked, skip) in enumerate(zip(part.column("marked"), part.column("skip"), strict=True)):
                    words = hashes[of[i] : of[i + 1]]
                    _, anchor = anchor_of(words, length)
                    if not len(anchor):
                        continue
                    on = np.zeros(len(words), bool)
                    on[marked.values.to_numpy()] = True
                    wanted = on[anchor]
                    if skip.is_valid and len(skip):
                        for lo, hi in zip(skip.values.field("start").to_numpy(), skip.values.field("end").to_numpy(), strict=True):
                            wanted[lo:hi] = False
                    here = np.flatnonzero(wanted)
                    values.append(W.run_hashes(words, length, 802)[here])
                    where.append(here)
                    sizes[i + 1] = len(here)
                offsets = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), W.lists(W.longs(np.concatenate(values)), offsets), W.lists(pa.array(np.concatenate(where).astype(np.int32)), offsets)],
                    ["rid", "windows", "places"],
                )

    return extend


def _maximal(n: int, length: int, places, runs) -> np.ndarray:
    """The maximal repeats of a text of n words, as rows of start and end, from windows at `places` and ranges `runs` of window starts."""
    edge = np.zeros(n + 1, np.int64)
    if places.is_valid and len(places):
        p = np.unique(places.values.to_numpy())
        edge[p] += 1
        edge[p + length] -= 1
    if runs.is_valid and len(runs):
        np.add.at(edge, runs.values.field("start").to_numpy(), 1)
        np.add.at(edge, runs.values.field("end").to_numpy() + length - 1, -1)
    turn = np.flatnonzero(np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0, append=0))
    return turn.reshape(-1, 2).astype(np.int32)


def _keep(length: int, texts: bool):
    """(k0, k1, n, text, places, runs) to the maximal repeats of each text and what is left of it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text"):
                removed, left, spans = [], [], [np.zeros((0, 2), np.int32)]
                data, at = W.flat(part.column("text"))
                raw = data.tobytes()
                for i, (places, runs) in enumerate(zip(part.column("places"), part.column("runs"), strict=True)):
                    words = raw[at[i] : at[i + 1]].split()
                    found = _maximal(len(words), length, places, runs)
                    removed.append(int((found[:, 1] - found[:, 0]).sum()))
                    bounds = np.concatenate([[0], found.ravel(), [len(words)]]).tolist()
                    kept = b" ".join([w for a, b in zip(bounds[::2], bounds[1::2], strict=True) for w in words[a:b]])
                    left.append(kept.decode() if texts else hashlib.sha256(kept).hexdigest())
                    spans.append(found)
                offsets, flat = np.cumsum([0, *map(len, spans[1:])]), np.concatenate(spans)
                pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("k0", "k1", "n")), pa.array(removed, pa.int32()), pa.array(left, pa.string()), W.lists(pairs, offsets)], ["k0", "k1", "n", "removed", "left", "repeats"])

    return keep


def _keyed(text: Column) -> dict[str, Column]:
    """The two hashes of a text."""
    return {"k0": F.xxhash64(text), "k1": F.xxhash64(F.lit(7), text)}


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns(_keyed(F.col("text")))


def _twice(rows: DataFrame, place: Column) -> DataFrame:
    """Hashes that stand at more than one place, with their number and the least place."""
    return written(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1"), "shared")


def _joined(rows: DataFrame, shared: DataFrame, salt: Column) -> DataFrame:
    return spread_join(rows, shared.drop("n"), ["hash"], heavy_keys(shared, ["hash"]), salt)


def _repeats(src: DataFrame, length: int, texts: bool) -> tuple[DataFrame, DataFrame]:
    """The stored scan of all rows, and for each text (k0, k1) with repeats: n rows, removed, left, repeats."""
    if length < SEED:
        raise ValueError(f"length must be {SEED} at least")
    first = written(src.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(_scan(length), _FIRST), "passages")
    one = written(first.groupBy("k0", "k1").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("n")), "texts")

    # Stretches that repeat: the least place stands for the others.
    place = F.struct("rid", "start", "end")
    stretch = first.select("rid", F.explode(F.arrays_zip("stretches", "starts", "ends")).alias("s")).select("rid", F.col("s.stretches").alias("hash"), F.col("s.starts").alias("start"), F.col("s.ends").alias("end"))
    same = _joined(stretch, _twice(stretch, place), F.xxhash64("rid", "start"))
    runs = written(
        same.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("runs"), F.collect_list(F.when(~place.eqNullSafe(F.col("least")), F.struct("start", "end"))).alias("skip")),
        "runs",
    )

    # Rows joined on anchors: those at more than one place are marked.
    seeds = first.select("rid", F.explode(F.arrays_zip("anchors", "places")).alias("s")).select("rid", F.col("s.anchors").alias("hash"), F.col("s.places").alias("place"))
    shared = _twice(seeds, F.xxhash64("rid", "place")).drop("least")
    marked = _joined(seeds, shared, F.xxhash64("rid", "place")).groupBy("rid").agg(F.collect_list("place").alias("marked"))
    marks = one.join(marked, "rid").join(runs.select("rid", "skip"), "rid", "left")
    whole = src.groupBy("k0", "k1").agg(F.first("text").alias("text"))  # copies are dropped before the shuffle
    touched = written(whole.join(marks, ["k0", "k1"]).select("rid", "k0", "k1", "n", "text", "marked", "skip"), "touched")

    windows = touched.mapInArrow(_extend(length), "rid long, windows array<long>, places array<int>")
    windows = written(windows.where(F.size("windows") > 0), "windows")
    windows = windows.select("rid", F.explode(F.arrays_zip("windows", "places")).alias("w")).select("rid", F.col("w.windows").alias("hash"), F.col("w.places").alias("place"))
    again = _twice(windows, F.xxhash64("rid", "place")).drop("least")
    places = _joined(windows, again, F.xxhash64("rid", "place")).groupBy("rid").agg(F.collect_list("place").alias("places"))

    cut = touched.select("rid", "k0", "k1", "n", "text").join(places.join(runs.select("rid", "runs"), "rid", "full"), "rid")
    cut = cut.mapInArrow(_keep(length, texts), f"k0 long, k1 long, n long, removed int, left string, repeats {_SPANS}")
    return first, written(cut, "cut")


def repeated_passages(docs: DataFrame, length: int = 35) -> DataFrame:
    """The maximal repeats of each row, and what is left of it without each word covered by a window of `length` words whose sequence also starts anywhere else.

    `docs` has doc_id (integer) and text; other columns are ignored.  Result:
    doc_id, n_words, n_removed, left (the SHA-256 in hex of the kept words joined
    by one space) and repeats (array of start and end in words, null if none).

    Null, empty and blank texts have no words and lose none.  A null doc_id is
    an id like others.  Rows that repeat a doc_id are places of their own: two
    equal rows repeat each other whole.  An empty table gives no rows.
    """
    first, cut = _repeats(_texts(docs), length, texts=False)
    rows = first.select("rid", "k0", "k1", "doc_id", "n_words", "whole")
    out = spread_join(rows, cut, ["k0", "k1"], heavy_keys(cut, ["k0", "k1"]), F.col("rid"), "left")
    return out.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("left", "whole").alias("left"), "repeats")


def without_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """All rows and columns of `docs`, the texts that lose words replaced by the rest joined by one space, and n_removed.

    Rows are treated as by `repeated_passages`.  A column that is already named
    n_removed is replaced.
    """
    docs = docs.drop("n_removed")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # so that no name of another column matters
    text = f"c{names.index('text')}"
    _, cut = _repeats(_texts(docs), length, texts=True)
    rows = plain.withColumns(_keyed(F.coalesce(F.col(text).cast("string"), F.lit(""))) | {"rid": F.monotonically_increasing_id()})
    cut = cut.drop("repeats").where("removed > 0")
    out = spread_join(rows, cut, ["k0", "k1"], heavy_keys(cut, ["k0", "k1"]), F.col("rid"), "left")
    new = out.withColumn(text, F.coalesce("left", F.col(text).cast("string"))).select(*plain.columns, F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"))
    return new.toDF(*names, "n_removed")


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeated_passages(docs).select("doc_id", "n_words", "n_removed", F.col("left").alias("kept_sha256"))


#: The windows of 35 words, counted by their word sequences.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i+34], ' ')) AS h FROM s),
r AS (SELECT doc_id, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, i + j AS p FROM r, (SELECT unnest(range(0, 35)) AS j)),
n AS (SELECT doc_id, list(p) AS p FROM g GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(n.p), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN n.p IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(n.p, k)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
"""
