"""Token ids in binary files: Simple-8b coded blocks with an index for direct reads.

A file is MAGIC, blocks, an index and its length.  A block holds up to BLOCK
ids: its header (four unsigned 32-bit counts), a dictionary of the ids that
occur more than once, most frequent first, the escaped ids, and 64-bit words.
Ids are written as codes: 0 escapes to the next escaped id, c is entry c - 1 of
the dictionary.  A word packs as many codes as fit: its top four bits select
how many codes of which width its other 60 bits hold.  The index has the offset
and size of each block and the doc_id and number of ids of each document, so a
reader takes any block alone, and decodes all words of one selector at once.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.scratch import new_path, written
from lexiloom.llm.tokens import packed_texts

MAGIC = b"LXTOKEN1"
BLOCK = 1 << 17
#: Codes in a word and bits of each, by selector.
COUNT = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3])
WIDTH = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20])
_MOST = (1 << 16) - 1
_BITS = np.concatenate([[0], np.floor(np.log2(np.arange(1, _MOST + 1))) + 1]).astype(np.int8)


def pack(codes: np.ndarray) -> np.ndarray:
    """Simple-8b words of codes under 2 ** 16."""
    n = len(codes)
    padded = np.zeros(n + int(COUNT[0]), np.uint64)
    padded[:n] = codes
    bits = np.zeros(len(padded), np.int8)
    bits[:n] = _BITS[codes]
    chosen = np.full(n, len(COUNT) - 1, np.int8)
    for k in range(len(COUNT) - 2, -1, -1):
        wide = np.zeros(len(bits) + 1, np.int32)
        np.cumsum(bits > WIDTH[k], out=wide[1:])
        chosen[wide[COUNT[k] : COUNT[k] + n] == wide[:n]] = k
    step, at, starts = (np.arange(n) + COUNT[chosen]).tolist(), 0, []
    while at < n:
        starts.append(at)
        at = step[at]
    starts = np.array(starts, np.int64)
    picked = chosen[starts]
    out = picked.astype(np.uint64) << np.uint64(60)
    for k in np.unique(picked):
        if WIDTH[k]:
            rows = np.flatnonzero(picked == k)
            shift = np.arange(COUNT[k], dtype=np.uint64) * np.uint64(WIDTH[k])
            out[rows] |= np.bitwise_or.reduce(padded[starts[rows][:, None] + np.arange(COUNT[k])] << shift, axis=1)
    return out


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first n codes of Simple-8b words."""
    picked = (words >> np.uint64(60)).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(COUNT[picked])])
    out = np.zeros(int(start[-1]), np.uint64)
    for k in np.unique(picked):
        if WIDTH[k]:
            rows = np.flatnonzero(picked == k)
            shift = np.arange(COUNT[k], dtype=np.uint64) * np.uint64(WIDTH[k])
            out[start[rows][:, None] + np.arange(COUNT[k])] = (words[rows][:, None] >> shift) & np.uint64((1 << int(WIDTH[k])) - 1)
    return out[:n].astype(np.int64)


def encode_block(ids: np.ndarray) -> bytes:
    """One block of unsigned 32-bit ids."""
    if len(ids) and ids.max() < 1 << 20:
        n = np.bincount(ids)
        seen = np.flatnonzero(n > 1)
        seen = seen[np.argsort(-n[seen], kind="stable")][:_MOST]
        code_of = np.zeros(len(n), np.int64)
        code_of[seen] = np.arange(1, len(seen) + 1)
        codes = code_of[ids]
    else:
        values, place, n = np.unique(ids, return_inverse=True, return_counts=True)
        few = np.flatnonzero(n > 1)
        few = few[np.argsort(-n[few], kind="stable")][:_MOST]
        seen, code_of = values[few], np.zeros(len(values), np.int64)
        code_of[few] = np.arange(1, len(few) + 1)
        codes = code_of[place]
    escaped, words = ids[codes == 0], pack(codes)
    head = np.array([len(ids), len(words), len(seen), len(escaped)], "<u4")
    return head.tobytes() + seen.astype("<u4").tobytes() + escaped.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def decode_block(data: bytes) -> np.ndarray:
    n, n_words, n_seen, n_escaped = np.frombuffer(data, "<u4", 4).tolist()
    seen = np.frombuffer(data, "<u4", n_seen, 16)
    escaped = np.frombuffer(data, "<u4", n_escaped, 16 + 4 * n_seen)
    codes = unpack(np.frombuffer(data, "<u8", n_words, 16 + 4 * (n_seen + n_escaped)), n)
    out = np.empty(n, "<u4")
    out[codes == 0] = escaped
    out[codes > 0] = seen[codes[codes > 0] - 1]
    return out


# Names of stores that Hadoop and Arrow call differently.
STORES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfss": "abfss", "file": "file"}


def _open(path: str):
    """The file system of an address and the path there: Arrow's own, else that of fsspec for its scheme."""
    from pyarrow import fs

    scheme, mark, rest = path.partition(":")
    address = STORES.get(scheme, scheme) + mark + rest
    try:
        return fs.FileSystem.from_uri(address)
    except (ValueError, pa.ArrowInvalid, pa.ArrowNotImplementedError) as unknown:
        try:
            import fsspec

            store, at = fsspec.core.url_to_fs(path)
        except (ImportError, ValueError) as e:
            raise ValueError(f"token files need a store that Arrow or fsspec opens in every task, not {scheme}") from (e or unknown)
        return fs.PyFileSystem(fs.FSSpecHandler(store)), at


class Writer:
    """A token file under construction."""

    def __init__(self, path: str):
        self.path = path
        store, at = _open(path)
        store.create_dir(at.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(at)
        self.out.write(MAGIC)
        self.offset, self.blocks, self.docs, self.waiting, self.size = len(MAGIC), [], [], [], 0

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(packed) // 4))
        self.waiting.append(packed)
        self.size += len(packed)
        if self.size >= 4 * BLOCK:
            self._flush(4 * BLOCK)

    def _flush(self, least: int) -> None:
        data = b"".join(self.waiting)
        at = 0
        while len(data) - at >= least and at < len(data):
            ids = np.frombuffer(data[at : at + 4 * BLOCK], "<u4")
            block = encode_block(ids)
            self.out.write(block)
            self.blocks.append((self.offset, len(ids)))
            self.offset += len(block)
            at += 4 * len(ids)
        self.waiting, self.size = [data[at:]], len(data) - at

    def close(self) -> tuple[int, int]:
        """Write what waits and the index; the numbers of documents and ids."""
        self._flush(1)
        blocks, docs = np.array(self.blocks, "<i8").reshape(-1, 2), np.array(self.docs, "<i8").reshape(-1, 3)
        index = np.array([len(blocks), len(docs)], "<i8").tobytes() + blocks.tobytes() + docs.tobytes()
        self.out.write(index + np.array([self.offset], "<i8").tobytes() + MAGIC)
        self.out.close()
        return len(docs), int(docs[:, 2].sum())


def read_documents(path: str) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """Each document of a token file in order: its doc_id and the runs of its ids, one block in memory at a time."""
    store, at = _open(path)
    with store.open_input_file(at) as f:
        size = f.size()
        index_at = int(np.frombuffer(f.read_at(16, size - 16), "<i8", 1)[0])
        index = f.read_at(size - 16 - index_at, index_at)
        n_blocks, n_docs = np.frombuffer(index, "<i8", 2).tolist()
        blocks = np.frombuffer(index, "<i8", 2 * n_blocks, 16).reshape(-1, 2)
        docs = np.frombuffer(index, "<i8", 3 * n_docs, 16 + 16 * n_blocks).reshape(-1, 3)
        ends = [*blocks[1:, 0].tolist(), index_at]
        held, k = np.zeros(0, "<u4"), 0
        for doc_id, null, n in docs.tolist():
            runs, want = [], n
            while want:
                if not len(held):
                    held = decode_block(f.read_at(ends[k] - int(blocks[k, 0]), int(blocks[k, 0])))
                    k += 1
                runs.append(held[:want])
                held, want = held[want:], want - len(runs[-1])
            yield (None if null else doc_id), runs


def _write(folder: str, path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, first = None, None
        for part, packed in packed_texts(batches, path, end):
            for i, (doc_id, ids) in enumerate(zip(part.column("doc_id").to_pylist(), packed, strict=True)):
                if writer is None:  # a name of its own for each attempt; only the files of attempts that end well are listed
                    writer, first = Writer(f"{folder}/{uuid.uuid4().hex}.tokens"), (doc_id, part.column("h")[i].as_py(), part.column("m")[i].as_py())
                writer.add(doc_id, ids)
        if writer:
            n_docs, n_ids = writer.close()
            longs = {n: pa.array([v], pa.int64()) for n, v in zip(("first_id", "first_h", "first_m", "n_docs", "n_ids"), (*first, n_docs, n_ids), strict=True)}
            yield pa.RecordBatch.from_pydict({"path": [writer.path], **longs})

    return run


def write_token_files(docs: DataFrame, path: str, end: int = 0, folder: str | None = None) -> DataFrame:
    """Write the ids of each whole text, closed by `end`, in ascending doc_id order; return the list of files.

    Documents are dealt out by ranges of doc_id, a hash of the text and a number
    of the row, so each file holds a range, files in order of their first rows
    hold the corpus in order (nulls first; rows that repeat a doc_id follow each
    other by the hash), and rows of one doc_id are dealt over files as well.  Null
    and empty texts have the end id alone; an empty table gives no files.  Result,
    kept as a table: path, first_id, n_docs, n_ids, start (ids in earlier files).
    """
    folder = folder or new_path(docs.sparkSession, "tokens")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    src = src.withColumns({"h": F.xxhash64("text"), "m": F.monotonically_increasing_id()})
    dealt = src.repartitionByRange("doc_id", "h", "m").sortWithinPartitions("doc_id", "h", "m")
    files = written(dealt.mapInArrow(_write(folder, path, end), "path string, first_id long, first_h long, first_m long, n_docs long, n_ids long"), "files")
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_h", "first_m").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).drop("first_h", "first_m")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    made = lambda out: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
    for batch in batches:
        for row in batch.to_pylist():
            out, at = [], row["start"]
            for doc_id, runs in read_documents(row["path"]):
                crc, n = 0, 0
                for run in runs:
                    crc, n = zlib.crc32(run.tobytes(), crc), n + len(run)
                out.append((doc_id, at, n, crc))
                at += n
                if len(out) == 10_000:
                    yield made(out)
                    out = []
            if out:
                yield made(out)


def token_digests(files: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of little-endian ids)."""
    return files.select("path", "start").repartition(max(1, files.count())).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digests(write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0))
