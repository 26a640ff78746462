"""Ids of whole texts under a byte-level vocabulary, with bounded caches of words.

Byte-level tokenizers without a normaliser pre-split a text into words.  They
cut before each space that follows a character other than white space, so the
stretches between such spaces can be encoded on their own; texts with a space
inside a longer run of white space are pre-split whole.  A worker keeps the ids
of stretches and words that it has met.

Columns of texts are pre-split at once by the kinds of their characters, and
their words are looked up together in a table of arrays; words that are not in
it are encoded one by one.
"""

from __future__ import annotations

import functools
import json
import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lexiloom.llm.words import flat, pieces

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The pre-split pattern and white space of byte-level vocabularies.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a vocabulary file: itself, or the next sign from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> dict:
    """The parsed vocabulary file; a ValueError if it is not a plain byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    if spec["model"]["type"] != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError("only byte-level BPE without a normaliser, a prefix space or stripping tokens")
    return spec


class Cache(dict):
    """Values by key in two generations: at `most` entries the older one goes, so memory is bounded."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class Coder:
    """Packed little-endian unsigned 32-bit ids of texts, given the ids of a pre-split word."""

    def __init__(self, word: Callable[[str], list[int]], added: dict[str, int], most: int = 800_000):
        import regex

        self.added = added
        self.split = regex.compile(PATTERN).findall
        self.letters = regex.compile(r"\p{L}+").match
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        self.odd = [(c, c + " ") for c in map(chr, range(0x3001)) if regex.match(f"[{SPACES}]", c)]  # of these some, with white space after it, is no cut
        self.word = lambda w: array("I", word(w)).tobytes()
        self.words = Cache(self.word, most // 4)
        self.spaced = Cache(self._spaced, most)

    def _spaced(self, part: str) -> bytes:
        """The ids of a stretch after its space; the letters that it begins with are a word by the pattern, whatever follows."""
        if part.isalpha():
            return self.word(" " + part)
        head = part[:-1]
        if not (part[-1:] in (".", ",") and head.isalpha()):
            begin = self.letters(part)
            if not begin:
                return b"".join([self.words[w] for w in self.split(" " + part)])
            head = begin[0]
        rest = part[len(head) :]
        known = self.spaced.get(head) or self.spaced.old.get(head)
        return (known or self.word(" " + head)) + (self.words[rest] if len(rest) == 1 else b"".join([self.words[w] for w in self.split(rest)]))

    def packed(self, text: str | None) -> bytes:
        """The ids of a text, strings of added tokens as those tokens; none for null."""
        if not text:
            return b""
        if any(a in text for a in self.added):
            parts: list[bytes] = []
            for k, run in enumerate(self.cut(text)):
                parts.append(self.added[run].to_bytes(4, "little") if k % 2 else self._plain(run))
            return b"".join(parts)
        return self._plain(text)

    def _plain(self, run: str) -> bytes:
        if not run:
            return b""
        if any(c in run and x in run for c, x in self.odd):
            out = b"".join(map(self.words.__getitem__, self.split(run)))
        else:
            head, *rest = run.split(" ")
            out = b"".join(map(self.words.__getitem__, self.split(head))) + b"".join(map(self.spaced.__getitem__, rest))
        self.words.turn()
        self.spaced.turn()
        return out


def library_coder(path: str) -> Coder:
    """A coder whose words are encoded by the tokenizers library's model of the file."""
    from tokenizers import Tokenizer

    spec = vocabulary(path)
    tokenizer = Tokenizer.from_file(path)
    tokenize, sign = tokenizer.model.tokenize, {b: s for s, b in byte_signs().items()}
    added, space = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}, sign[0x20]

    def word(w: str) -> list[int]:
        plain = w.isascii() and w.isprintable()  # all signs but the space stand for themselves
        return [t.id for t in tokenize(w.replace(" ", space) if plain else w.encode().decode("latin-1").translate(sign))]

    return Coder(word, added)


@functools.cache
def kinds() -> np.ndarray:
    """What the pattern takes each code point for: 0 white space, 1 a letter, 2 a number, 3 anything else."""
    import regex

    out, signs = np.full(0x110000, 3, np.uint8), "".join(map(chr, range(0x110000)))
    for kind, pattern in enumerate((f"[{SPACES}]+", r"\p{L}+", r"\p{N}+")):
        for run in regex.finditer(pattern, signs):
            out[run.start() : run.end()] = kind
    return out


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    out, lead = kinds()[:256][data], np.flatnonzero(data >= 0xC0)
    more = 1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0).astype(np.int64)
    parts = [(more >= k, k) for k in (1, 2, 3)]
    point = data[lead] & (0x3F >> more)
    for has, k in parts:
        point[has] = point[has] << 6 | data[lead[has] + k] & 0x3F
    kind = out[lead] = kinds()[point]
    for has, k in parts:
        out[lead[has] + k] = kind[has]
    return out


def word_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first byte of each word into which the pattern cuts texts, whose n + 1 offsets are `at`."""
    n, kind = len(data), byte_kinds(data)
    first = np.zeros(n + 1, bool)
    first[at] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    after = np.flatnonzero(start & ~first)
    after = after[kind[after - 1] == 0]
    last = after - 1  # of white space before something else the last character is apart, and a space goes with what follows
    while (inner := data[last] & 0xC0 == 0x80).any():
        last = last - inner
    start[last] = True
    start[after[data[last] == 0x20]] = False
    quote = np.flatnonzero(start[:n] & (data == 0x27))
    for ending in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
        met = quote[quote + len(ending) < n]
        for k, byte in enumerate(ending, 1):
            met = met[(data[met + k] == byte) & ~first[met + k]]
        start[met + 1], start[met + 1 + len(ending)] = False, True
    return np.flatnonzero(start[:n])


class WordTable:
    """Ids of words by their bytes; a word has one place, which the last one of that place holds, so memory is bounded.

    A place holds the bytes of a word of under KEY bytes with their number, and where its ids are and how many.
    """

    KEY, BLOCK = 16, 1 << 16

    def __init__(self, coder: Coder, places: int = 1 << 22, most: int = 1 << 24):
        self.coder, self.most, self.shift = coder, most, np.uint64(65 - places.bit_length())
        self.words = Cache(lambda w: coder.word(w.decode()), 100_000)
        self.places = np.zeros((places, 3), np.uint64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.below = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

    def _kept(self, ids: np.ndarray) -> int:
        """Keep ids; where the first of them is."""
        at = self.used
        if at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)])
        self.ids[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def looked_up(self, text: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has; KEY bytes follow the last word."""
        if self.used > self.most:
            self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
            self.places[:] = 0
        eights = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
        one = eights[start] & self.below[np.minimum(size, 8)]
        two = eights[start + 8] & self.below[np.clip(size - 8, 0, 7)] | size.astype(np.uint64) << np.uint64(56)
        place = (one ^ two * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        place = ((place ^ place >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        held, fits = self.places.take(place, axis=0), size < self.KEY
        at, n = (held[:, 2] // self.KEY).astype(np.int64), (held[:, 2] % self.KEY).astype(np.int64)
        new = np.flatnonzero((held[:, 0] != one) | (held[:, 1] != two) | ~fits)
        if len(new):
            made = [self.words[text[a:b]] for a, b in zip(start[new].tolist(), (start[new] + size[new]).tolist(), strict=True)]
            n[new] = np.fromiter(map(len, made), np.int64, len(made)) // 4
            at[new] = np.cumsum(n[new]) - n[new] + self._kept(np.frombuffer(b"".join(made), "<u4"))
            put = new[fits[new]]
            self.places[place[put]] = np.stack([one[put], two[put], (at[put] * self.KEY + n[put]).astype(np.uint64)], axis=1)
            self.words.turn()
        return self.ids[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())], n

    def packed(self, texts: pa.Array) -> list[bytes]:
        """As `Coder.packed` for each text of a column."""
        data, at = flat(texts)
        start, text = word_starts(data, at), data.tobytes() + bytes(self.KEY)
        size = np.diff(start, append=at[-1])
        ids, ends = [], np.zeros(len(start) + 1, np.int64)
        for a in range(0, len(start), self.BLOCK):
            some, ends[a + 1 : a + 1 + self.BLOCK] = self.looked_up(text, start[a : a + self.BLOCK], size[a : a + self.BLOCK])
            ids.append(some.astype("<u4").tobytes())
        ids, ends = b"".join(ids), (4 * np.cumsum(ends)[np.searchsorted(start, at)]).tolist()
        out = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for token in self.coder.added:
            for i in np.flatnonzero(pc.fill_null(pc.match_substring(texts, token), False)):
                out[i] = self.coder.packed(texts[int(i)].as_py())
        return out


_TABLES: dict[str, WordTable] = {}


def packed_texts(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with the packed ids of their texts, each closed by the id `end`."""
    if path not in _TABLES:
        _TABLES[path] = WordTable(library_coder(path))
    packed, tail = _TABLES[path].packed, end.to_bytes(4, "little")
    for batch in batches:
        for part in pieces(batch, "text", 1 << 20):
            yield part, [ids + tail for ids in packed(part.column("text"))]
