"""Cross-tokenizer alignment against the libraries and a count over all links."""

import bisect
import functools
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiloom.llm import alignment
from lexiloom.llm.tokens import byte_signs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), byte_signs()


@functools.cache
def aligner():
    return alignment.Aligner(A, B)


def brute(text):
    """n_a, n_b, groups and links from whole encodings; None where a side does not give the text back."""
    a, b, sign = libraries()
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(sign[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in (bytes_a, bytes_b)]
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        to_i, to_j = (bisect.bisect_right(e, end) for e in ends)
        groups.append(",".join(map(str, ids_a[i:to_i])) + "|" + ",".join(map(str, ids_b[j:to_j])))
        links += [(x, y) for x, e in zip(ids_a[i:to_i], ends[0][i:to_i]) if e == end for y, f in zip(ids_b[j:to_j], ends[1][j:to_j]) if f == end]
        i, j = to_i, to_j
    return len(ids_a), len(ids_b), groups, links


def rows_of(texts):
    found = {t: brute(t) for t in set(texts)}
    count = Counter(x for t in texts if found[t] for x in found[t][3])
    best = Counter()
    for (a, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for t in texts:
        if not found[t]:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found[t]
        out.append((n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


PIECES = ["a", " ", "  ", "\n", " \n", "\t ", " ", "　", "'s", "don't", "é", "中文", "▁", "<s>", "<0x41>", "<|endoftext|>", "12", "🙂", "\x00", "word", "Hello", ".", ",", "%%%", "\x1c", "​", "ﬁ"]


@given(st.lists(st.sampled_from(PIECES) | st.text(max_size=3), max_size=14).map("".join))
@settings(max_examples=500, deadline=None)
def test_texts_against_the_libraries(text):
    want, got = brute(text), aligner().text(text)
    if want is None:
        assert got[:4] == (0, 0, 0, "") and not len(got[4])
    else:
        n_a, n_b, groups, links = want
        assert got[:4] == (n_a, n_b, len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
        assert dict(zip(got[4].tolist(), got[5].tolist(), strict=True)) == Counter(b << 32 | a for a, b in links)


def test_long_texts_and_small_caches(monkeypatch):
    for name, value in (("KEPT", 20), ("AT_ONCE", 7), ("TOGETHER", 3), ("LONGEST", 5)):
        monkeypatch.setattr(alignment, name, value)
    text = " ".join(f"Wörter{i % 91}. und\n{i}  x" for i in range(400)) + "z" * 3000 + " end\n "
    n_a, n_b, groups, links = brute(text)
    one = alignment.Aligner(A, B)
    for _ in range(2):
        got = one.text(text)
        assert got[:4] == (n_a, n_b, len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()) and got[5].sum() == len(links)
    assert len(one.met) <= 20 + 7 and not any(len(s) > 5 for s in one.met)


TEXTS = [None, "", " ", "a", "Hello  world,\n\n it's 12345 ümläut 日本語 🙂", "has ▁ in it", "<|endoftext|> <s>", "the same words", "the same words", "the other words", "y" * 5000, "tail \n"] + [f"some words of text {i} and the same words" for i in range(60)]


def test_operator_against_a_count_of_all_links(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "a", "x"), (None, "the same words", "x"), (None, "the same words", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, a string").repartition(4)
    got, counts = alignment.align_tokenizers(df, A, B)
    want = [(r[0], *x) for r, x in zip(rows, rows_of([r[1] for r in rows]), strict=True)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    links = Counter(b << 32 | a for _, t, _ in rows if brute(t) for a, b in brute(t)[3])
    keys = np.array(sorted([*links, 5, 1 << 50]), np.int64)
    assert counts.of(keys).tolist() == [links.get(int(k), 0) for k in keys]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    got, counts = alignment.align_tokenizers(none, A, B)
    assert got.count() == 0 and counts.of(np.array([1], np.int64)).tolist() == [0]
    nulls = alignment.align_tokenizers(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B)[0]
    assert sorted(tuple(r) for r in nulls.collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("size", [1, 2, 5, 100])
def test_runs_go_on_over_batches(tmp_path, size):
    """A shard written from batches of any size has each key once with the sum of its run."""
    rng = np.random.default_rng(size)
    keys, n = np.sort(rng.integers(0, 12, 60)), rng.integers(1, 9, 60)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size]), pa.array(n[i : i + size])], ["key", "n"]) for i in range(0, 60, size)]
    (row,) = [b.to_pylist()[0] for b in alignment._write_shard(f"file://{tmp_path}/s")(iter(batches))]
    want = Counter()
    for k, x in zip(keys.tolist(), n.tolist(), strict=True):
        want[k] += x
    got = [np.fromfile(row["path"].removeprefix("file://") + end, "<i8").tolist() for end in (".keys", ".counts")]
    assert dict(zip(*got, strict=True)) == want and got[0] == sorted(want) and (row["first"], row["last"], row["n"]) == (min(want), max(want), len(want))
    assert list(alignment._write_shard(f"file://{tmp_path}/none")(iter([]))) == []


def test_partial_counts(monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS", 10)
    rng = np.random.default_rng(1)
    lists = [[rng.integers(0, 6, k).tolist() for k in (rng.integers(0, 5),) * 3] for _ in range(80)]
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in range(3)], ["a", "b", "times"])
    got, want = Counter(), Counter()
    for batch in alignment._partial(iter([made(lists[:30]), made(lists[30:]), made([])])):
        for r in batch.to_pylist():
            got[r["key"]] += r["n"]
    for a, b, times in lists:
        for x, y, t in zip(a, b, times, strict=True):
            want[y << 32 | x] += t
    assert got == want
