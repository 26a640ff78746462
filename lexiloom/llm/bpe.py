"""BPE encoding and decoding by a tokenization automaton.

The automaton accepts exactly the token sequences that the merges give.  It
starts with one state that every byte token leads back to.  For each merge
a b -> c in order, a gadget is put in: the state q that a leads to is copied
without its arc b, a now leads to the copy, and c leads from wherever a could
be read to where b led from q.  So a state is its parent without one arc, all
arcs of one token lead to one state, and there is one state for each merge.

For encoding, the arcs are spelled out in bytes along a trie of the tokens and
the result is made deterministic by subset construction: a state of the coder is
the set of (state of the automaton, bytes read of the next token) that the bytes
so far lead to, and its output is the last token of the one sequence that spells
them.  Its transition table is filled as transitions are met, and emptied when
it holds MOST of them.  A pre-split word is one run over the table, byte by
byte; its tokens are read off the outputs from the end.  Decoding emits the
bytes on the arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.tokens import Coder, byte_signs, vocabulary
from lexiloom.llm.words import pieces


#: Transitions that a worker keeps.
MOST = 600_000


class Automaton:
    """States, arcs and labels compiled from a vocabulary file, and the table of the coder."""

    def __init__(self, path: str, most: int = MOST):
        spec, signs = vocabulary(path), byte_signs()
        model = spec["model"]
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        n = 1 + max([*vocab.values(), *self.added.values()])
        self.label: list[bytes] = [b""] * n
        for sign, i in vocab.items():
            self.label[i] = bytes(signs[c] for c in sign) if sign not in self.added else sign.encode()
        for sign, i in self.added.items():
            self.label[i] = sign.encode()
        self.to, self.left, self.made = [0] * n, [-1] * n, [0] * n
        self.parent, self.without, self.born = [-1], [-1], [0]
        for i, rule in enumerate(model["merges"], 1):
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            self._gadget(vocab[a], vocab[b], vocab[a + b], i)
        self.child: dict[int, int] = {}  # node << 8 | byte to node
        self.ends, self.inner = [-1], [False]
        for sign, i in vocab.items():
            if sign not in self.added and (self.made[i] or len(self.label[i]) == 1):
                self._spell(self.label[i], i)
        self.most = most
        self.number: dict[tuple, int] = {}
        self.sets: list[list[tuple[int, int]]] = []
        self.out: list[int] = []
        self.table: dict[int, int] = {}
        self._empty()

    def _gadget(self, a: int, b: int, c: int, i: int) -> None:
        if self.made[c]:
            raise ValueError("two merges make one token")
        self.left[c], self.made[c], self.to[c] = a, i, self.to[b]
        self.parent.append(self.to[a])
        self.without.append(b)
        self.born.append(i)
        self.to[a] = len(self.parent) - 1

    def _spell(self, label: bytes, token: int) -> None:
        node = 0
        for byte in label:
            self.inner[node] = True
            at = node << 8 | byte
            if at not in self.child:
                self.child[at] = len(self.ends)
                self.ends.append(-1)
                self.inner.append(False)
            node = self.child[at]
        self.ends[node] = token

    def _arc(self, state: int, token: int) -> bool:
        """Whether the token's arc leaves the state."""
        while state:
            if self.born[state] >= self.made[token]:
                if self.without[state] == token:
                    return False
                if self.born[state] > self.made[token]:
                    state = self.parent[state]
                    continue
            token = self.left[token]
        return True

    def _empty(self) -> None:
        """A table with the first state alone: in the first state of the automaton, at the root of the trie."""
        for kept in (self.number, self.sets, self.out, self.table):
            kept.clear()
        self._state(-1, [(0, 0)])

    def _state(self, last: int, found: list[tuple[int, int]]) -> int:
        """The number of a state of the coder, from its output and its set."""
        number = self.number.setdefault((last, *found), len(self.sets))
        if number == len(self.sets):
            self.sets.append(found)
            self.out.append(last)
        return number

    def _step(self, state: int, byte: int) -> int:
        """The transition from a state by a byte, put into the table."""
        if len(self.table) >= self.most:
            last, found = self.out[state], self.sets[state]
            self._empty()
            state = self._state(last, found)
        found, last = [], -1
        for q, node in self.sets[state]:
            node = self.child.get(node << 8 | byte)
            if node is not None:
                token = self.ends[node]
                if token >= 0 and self._arc(q, token):
                    last = token
                if self.inner[node]:
                    found.append((q, node))
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        found.append((self.to[last], 0))
        to = self.table[state << 8 | byte] = self._state(last, found)
        return to

    def word(self, word: bytes) -> list[int]:
        """The token sequence of one pre-split word."""
        state, table, out, last = 0, self.table, self.out, []
        for byte in word:
            to = table.get(state << 8 | byte)
            state = self._step(state, byte) if to is None else to
            last.append(out[state])
        path, at = [], len(word)
        while at:
            path.append(last[at - 1])
            at -= len(self.label[path[-1]])
        return path[::-1]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


_MACHINES: dict[str, tuple[Automaton, Coder, list[str]]] = {}


def machine(path: str) -> tuple[Automaton, Coder, list[str]]:
    """The worker's automaton for a vocabulary file, its coder and the decimal form of each id."""
    if path not in _MACHINES:
        a = Automaton(path)
        _MACHINES[path] = a, Coder(lambda w: a.word(w.encode()), a.added), [str(i) for i in range(len(a.label))]
    return _MACHINES[path]


def _round_trip(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, coder, decimal = machine(path)
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                n, ids_out, text_out = [], [], []
                for text in part.column("text").to_pylist():
                    ids = np.frombuffer(coder.packed(text), "<u4").tolist()
                    back = automaton.decode(ids)
                    n.append(len(ids))
                    ids_out.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest() if digests else ids)
                    text_out.append(hashlib.sha256(back.encode()).hexdigest() if digests else back)
                kind = pa.string() if digests else pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_out, kind), pa.array(text_out, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """Ids of each whole text and the text that they decode to: doc_id, n_tokens, ids, decoded.

    `path` is a byte-level BPE vocabulary file that every executor can open.
    With `digests`, ids and decoded are SHA-256 in hex, of the decimal ids
    joined by commas and of the decoded text in UTF-8.  Null and empty texts
    give no ids and an empty text; repeated rows and null ids are rows like
    others; an empty table gives no rows; other columns are ignored.
    """
    kind = "string" if digests else "array<long>"
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids {kind}, decoded string"
    return src.mapInArrow(_round_trip(path, digests), schema)


def op6(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), digests=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
