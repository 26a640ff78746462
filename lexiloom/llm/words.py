"""Vectorised word splitting and hashing for whole Arrow batches of texts.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, so words of
UTF-8 texts are found without decoding.  Hashes are 64 bits wide: a random
polynomial over the bytes of a word (as differences of a running sum), then a
finaliser; runs of words are hashed by a random linear form over word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)) | U64(1)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_EXACT = seeds(256, 11)
_FOLDED = _EXACT.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]
_RADIX = 0x2545F4914F6CDD1D
_INVERSE = pow(_RADIX, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_RADIX, 2 * _BLOCK), _powers(_INVERSE, 2 * _BLOCK)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets of the texts in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def word_bounds(data: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the range of its words (n + 1 offsets)."""
    inside = ~space[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """A hash of each word; fold lower-cases A-Z."""
    table, out = (_FOLDED if fold else _EXACT), np.empty(len(start), U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _BLOCK, side="right")))
        lo, hi = int(start[i]), int(end[j - 1])
        up, down = (_UP, _DOWN) if hi - lo < len(_UP) else (_powers(_RADIX, hi - lo + 1), _powers(_INVERSE, hi - lo + 1))
        run = np.zeros(hi - lo + 1, U64)
        np.cumsum(table[data[lo:hi]] * up[: hi - lo], out=run[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix((run[e] - run[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out


def run_hashes(words: np.ndarray, k: int, salt: int) -> np.ndarray:
    """A hash of each run of k words of one array; the runs of an array of n words are n - k + 1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    c, total = seeds(k, salt), np.zeros(n, U64)
    for i in range(k):
        total += words[i : i + n] * c[i]
    return mix(total)


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about `most` bytes at most, so memory stays bounded."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def longs(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
