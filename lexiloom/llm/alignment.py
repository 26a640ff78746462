"""Which tokens of two vocabularies end together, and how often over a corpus.

Tokenizer A is a byte-level BPE, B a BPE of pieces whose U+2581 is a space.
Neither merges over the place before a space that follows a character other than
white space, so the stretches between such places are encoded and aligned on
their own, and a worker keeps those that it has met.  Offsets where tokens of
both end cut a text into groups; the last tokens of a group are a link.

A link's pair of ids is one integer, b * 2 ** 32 + a.  Tasks count their pairs
with np.unique, the partial counts are sorted over the cluster by ranges of the
key, and each range is summed run by run into a shard: two files of sorted keys
and of counts, which readers map into memory and search.  A hot pair is one row
for each partial count, whatever its number of links.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import new_path, written
from lexiloom.llm.tokenfiles import _open
from lexiloom.llm.tokens import SPACES, byte_signs, vocabulary
from lexiloom.llm.words import pieces

#: Pairs that a task counts before it hands them on, stretches that a worker keeps and the longest of these, stretches in work at once and encoded in one row.
PAIRS, KEPT, LONGEST, AT_ONCE, TOGETHER = 1 << 20, 200_000, 64, 50_000, 256
SHIFT = np.int64(32)


class Aligner:
    """Aligns texts under two vocabulary files."""

    def __init__(self, path_a: str, path_b: str):
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(regex.search("[^▁]▁", p) for p in names):
            raise ValueError("a piece goes on after the space that ends a word")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        sign, vocab = byte_signs(), vocabulary(path_a)["model"]["vocab"]
        self.size_a, self.size_b = np.zeros(max(vocab.values()) + 1, np.int64), np.array([len(x) for x in self.bytes_b])
        for t, i in vocab.items():
            self.size_a[i] = sum(c in sign for c in t)
        #: Ids as text, each with the sign that follows within a group and at its end.
        self.signs = [f"{i}{end}" for size, last in ((len(self.size_a), "|"), (len(self.size_b), ";")) for i in range(size) for end in (",", last)]
        self.tokenizer = Tokenizer.from_file(path_a)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.odd = [c + " " for c in map(chr, range(0x3001)) if regex.match(f"[{SPACES}]", c)]  # where a space may be no cut
        self.cuts = regex.compile(rf"(?<=[^{SPACES}])(?= )").split
        self.lead = len(self.model.encode("a"))
        self.met, self.before, self.long = {}, {}, []

    def stretches(self, text: str) -> list[str]:
        """The stretches of space + text, each without the space that it begins with."""
        if any(x in text for x in self.odd) or text[:1] == " ":
            return [s[1:] for s in self.cuts(" " + text)]
        return text.split(" ")

    def _meet(self, stretches: list[str]) -> None:
        """Align stretches: numbers of A tokens, B tokens and groups, the groups as text and the packed pairs of each; empty if the bytes of B are not the stretch."""
        new = []
        for s in stretches:
            known = self.before.get(s)
            if known is None:
                new.append(s)
            else:
                self.met[s] = known
            if len(s) > LONGEST:
                self.long.append(s)
        rows = [s for s in new if s and not s[-1].isspace()]
        for at in range(0, len(rows), TOGETHER):
            self._together(rows[at : at + TOGETHER])
        for s in new:
            if s not in self.met:  # it may be the end of a text only
                self._together([s])

    def _together(self, part: list[str]) -> None:
        """Encode and align stretches in a row, as one text that is cut again where they end."""
        text = " " + " ".join(part)
        data = text.encode()
        a = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        ids = self.model.encode("a" + text)[self.lead :]
        if b"".join(map(self.bytes_b.__getitem__, ids)) != data:
            for s in part if len(part) > 1 else ():
                self._together([s])
            if len(part) == 1:
                self.met[part[0]] = ()
            return
        b = np.array(ids, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends, signs, pairs = self._groups(a, b, ends_a, ends_b)
        stops = np.cumsum([len(s) + 1 if s.isascii() else len(s.encode()) + 1 for s in part])  # tokens of both sides and a group end there
        until = [np.concatenate([[0], np.searchsorted(x, stops) + 1]) for x in (ends_a, ends_b, ends)]
        n_a, n_b, n_groups = (np.diff(x).tolist() for x in until)
        groups, packed, at = signs.split(";"), pairs.tobytes(), until[2].tolist()
        for i, s in enumerate(part):
            self.met[s] = (n_a[i], n_b[i], n_groups[i], ";".join(groups[at[i] : at[i + 1]]), packed[8 * at[i] : 8 * at[i + 1]])

    def _forget(self) -> None:
        """Keep memory bounded: long stretches go at once, others when KEPT later ones were met."""
        for s in self.long:
            del self.met[s]
        self.long.clear()
        if len(self.met) > KEPT:
            self.before, self.met = self.met, {}

    def _groups(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, str, np.ndarray]:
        """The end of each group of two sides with the same bytes, the groups as text and the pairs of their last tokens."""
        at = np.searchsorted(ends_b, ends_a)  # no token is empty, so ends rise
        last_a = ends_b[at] == ends_a
        last = at[last_a]
        last_b = np.zeros(len(b), bool)
        last_b[last] = True
        before_a, before_b = np.concatenate([[0], np.flatnonzero(last_a) + 1]), np.concatenate([[0], last + 1])  # tokens before each group
        signs = np.empty(len(a) + len(b), np.int64)
        signs[np.arange(len(a)) + before_b[np.cumsum(last_a) - last_a]] = 2 * a + last_a
        signs[np.arange(len(b)) + before_a[np.cumsum(last_b) - last_b + 1]] = 2 * (len(self.size_a) + b) + last_b
        return ends_a[last_a], "".join(map(self.signs.__getitem__, signs.tolist())), b[last] << SHIFT | a[last_a]

    def text(self, text: str | None) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, the digest of the groups, and the distinct pairs with how often each occurs; zeros where a side does not give the text back."""
        none = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not text:
            return none
        digest, totals, links, stretches = hashlib.sha256(), np.zeros(3, np.int64), [], self.stretches(text)
        for at in range(0, len(stretches), AT_ONCE):
            part = stretches[at : at + AT_ONCE]
            found = list(map(self.met.get, part))
            if None in found:
                self._meet(list(dict.fromkeys([s for s, f in zip(part, found, strict=True) if f is None])))
                found = list(map(self.met.get, part))
                self._forget()
            if () in found:
                return none
            n_a, n_b, n_groups, groups, packed = zip(*found, strict=True)
            totals += (sum(n_a), sum(n_b), sum(n_groups))
            digest.update(((";" if at else "") + ";".join(groups)).encode())
            links.append(np.frombuffer(b"".join(packed), "<i8"))
        keys, times = np.unique(np.concatenate(links), return_counts=True)
        return (*totals.tolist(), digest.hexdigest(), keys, times)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}
_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a array<int>, b array<int>, times array<int>"


def _list(values: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(values).astype(np.int32)))


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        text = _ALIGNERS[path_a, path_b].text
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                n_a, n_b, n_groups, digests, keys, times = zip(*map(text, part.column("text").to_pylist()), strict=True)
                longs = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *longs, pa.array(digests, pa.string()), _list([k & np.int64(0xFFFFFFFF) for k in keys]), _list([k >> SHIFT for k in keys]), _list(list(times))], [c.split()[0] for c in _ALIGNED.split(", ")])

    return run


def _flat(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of the rows' lists and their joined values."""
    lists = [batch.column(n) for n in names]
    at = lists[0].offsets.to_numpy().astype(np.int64)
    return at - at[0], [x.flatten().to_numpy().astype(np.int64) for x in lists]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of n of each."""
    found, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, n)
    return found, total


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, n, more, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    made = lambda k, v: pa.RecordBatch.from_arrays([pa.array(k), pa.array(v)], ["key", "n"])
    for batch in batches:
        _, (a, b, times) = _flat(batch, ["a", "b", "times"])
        more.append((b << SHIFT | a, times))
        size += len(a)
        if size >= PAIRS:
            keys, n = _summed(np.concatenate([keys, *[k for k, _ in more]]), np.concatenate([n, *[t for _, t in more]]))
            more, size = [], 0
            if len(keys) >= PAIRS:
                yield made(keys, n)
                keys, n = keys[:0], n[:0]
    keys, n = _summed(np.concatenate([keys, *[k for k, _ in more]]), np.concatenate([n, *[t for _, t in more]]))
    if len(keys):
        yield made(keys, n)


def _write_shard(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path, first, last, held, n = [], "", 0, 0, 0, 0

        def put(keys: np.ndarray, counts: np.ndarray) -> None:
            for f, x in zip(files, (keys, counts), strict=True):
                f.write(np.ascontiguousarray(x, "<i8").tobytes())

        for batch in batches:
            keys, counts = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            if not len(keys):
                continue
            if not files:  # names of their own for each attempt; only the shards of attempts that end well are listed
                path = f"{folder}/{uuid.uuid4().hex}"
                store, at = _open(path)
                store.create_dir(at.rpartition("/")[0], recursive=True)
                files = [store.open_output_stream(at + end) for end in (".keys", ".counts")]
                first = last = int(keys[0])
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, sums = keys[start], np.add.reduceat(counts, start)
            if keys[0] == last:  # the run that the batch before ended in goes on
                sums[0] += held
            else:
                put(np.array([last]), np.array([held]))
                n += 1
            put(keys[:-1], sums[:-1])
            n, last, held = n + len(keys) - 1, int(keys[-1]), int(sums[-1])
        if files:
            put(np.array([last]), np.array([held]))
            for f in files:
                f.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), *[pa.array([v], pa.int64()) for v in (first, last, n + 1)]], ["path", "first", "last", "n"])

    return run


@lru_cache(1024)
def _mapped(path: str) -> np.ndarray:
    """A file of longs: mapped into memory where the store is a file system, else read."""
    from pyarrow import fs

    store, at = _open(path)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(at, "<i8", "r")
    with store.open_input_file(at) as f:
        return np.frombuffer(f.read(), "<i8")


def _best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            b, counts = np.asarray(_mapped(f"{path}.keys")) >> SHIFT, np.asarray(_mapped(f"{path}.counts"))
            start = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(b[start]), pa.array(np.maximum.reduceat(counts, start))], ["b", "most"])


class Counts:
    """Counts of pairs, looked up in sorted shards: (path, first key, last key) in order; `best` is a file of the highest count of each b."""

    def __init__(self, shards: list[tuple[str, int, int]], best: str):
        self.shards, self.best = shards, best

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The count of each of sorted distinct keys; 0 where a pair never occurs."""
        out = np.zeros(len(keys), np.int64)
        for path, first, last in self.shards:
            lo, hi = np.searchsorted(keys, first), np.searchsorted(keys, last, "right")
            if lo < hi:
                known = _mapped(f"{path}.keys")
                at = np.minimum(np.searchsorted(known, keys[lo:hi]), len(known) - 1)
                out[lo:hi] = np.where(known[at] == keys[lo:hi], _mapped(f"{path}.counts")[at], 0)
        return out

    def best_of(self, b: np.ndarray) -> np.ndarray:
        return _mapped(self.best)[b]


def pair_counts(aligned: DataFrame, size_b: int) -> Counts:
    """Count the pairs of aligned texts over the whole corpus, as sorted shards in the shared folder.

    The driver has a row for each shard and, for the file of highest counts, one
    for each id of B (`size_b` of them at most).
    """
    spark = aligned.sparkSession
    partial = written(aligned.select("a", "b", "times").mapInArrow(_partial, "key long, n long"), "pairs")
    folder = new_path(spark, "shards")
    dealt = partial.repartitionByRange("key").sortWithinPartitions("key")
    shards = written(dealt.mapInArrow(_write_shard(folder), "path string, first long, last long, n long"), "shard_list")
    most = shards.select("path").repartition(max(1, shards.count())).mapInArrow(_best_of, "b long, most long").groupBy("b").agg(F.max("most").alias("most"))
    best = np.zeros(size_b, "<i8")
    for r in most.collect():
        best[r["b"]] = r["most"]
    store, at = _open(f"{folder}/best")
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(at) as f:
        f.write(best.tobytes())
    return Counts([(r["path"], r["first"], r["last"]) for r in shards.orderBy("first").collect()], f"{folder}/best")


def _look_up(counts: Counts):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ends, row = whole.column("a").offsets.to_numpy().astype(np.int64), 0
            while row < whole.num_rows:  # slices of about PAIRS pairs
                to = max(row + 1, int(np.searchsorted(ends, ends[row] + PAIRS, "right")) - 1)
                batch, row = whole.slice(row, to - row), to
                at, (a, b, times) = _flat(batch, ["a", "b", "times"])
                keys, place = np.unique(b << SHIFT | a, return_inverse=True)
                n = counts.of(keys)[place]
                top = n == counts.best_of(b) if len(b) else np.zeros(0, bool)
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times, times * top, times * n)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:4]], *[pa.array(s[at[1:]] - s[at[:-1]]) for s in sums], batch.column("groups_sha256")], names)

    return run


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, Counts]:
    """Per row of docs (doc_id, text): its groups and links under both vocabularies and what the corpus says of its links; and the counts.

    Result: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the
    most frequent, or as frequent, of its B token), count_sum, groups_sha256.
    Strings of special tokens are plain text.  Null and empty texts, and texts that
    tokens of one side do not give back, have zeros and an empty digest.  Rows that
    repeat a doc_id or have none count each for itself; other columns are not read.
    """
    import sentencepiece

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = written(src.mapInArrow(_align(path_a, path_b), _ALIGNED), "aligned")
    counts = pair_counts(aligned, sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size())
    longs = ", ".join(f"{c} long" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return aligned.mapInArrow(_look_up(counts), f"{longs}, groups_sha256 string"), counts


def op12(spark, sf_dir: str) -> DataFrame:
    """See align_tokenizers."""
    import public_tokenizers as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokenizers(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))[0]
