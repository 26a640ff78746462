"""Exact dedup by recipes against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import recipes

SPACE = re.compile(r"[\x20\x09-\x0D]+")
ROWS = "doc_id long, text string, row_key string, chunks string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ROWS).repartition(4)


def brute(rows):
    plain = [SPACE.sub(" ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, plain, strict=True):
        ids = [j for (j, _), u in zip(rows, plain, strict=True) if u == t]
        known = [j for j in ids if j is not None]
        out.append((i, min(known) if known else None, len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def many(rng):
    word = lambda: rng.choice(["alpha", "beta", "ünder", "日本語", "x", "🙂"]) + str(rng.randrange(50))
    texts = [" ".join(word() for _ in range(rng.choice([0, 1, 5, 300, 4000]))) for _ in range(40)]
    texts += ["z" * 30_000, "z" * 30_001, "a" * 255, "a" * 256, "a" * 8192, "a" * 8193]
    rows = [(i, rng.choice(texts)) for i in range(200)]
    rows += [(300 + i, t.replace(" ", rng.choice(["  ", "\n", "\t \x0b"]))) for i, t in enumerate(texts)]
    return rows + [(400, None), (401, ""), (402, " "), (403, "\n\t"), (404, " a"), (405, "a "), (406, "a b"), (None, "twice"), (None, "twice"), (None, "x"), (5, "x"), (5, "x"), (5, texts[3])]


@pytest.mark.parametrize("name", ["hash", "clash"])
def test_against_brute_force(spark, name):
    """With names that clash for a third of all chunks the result is the same: chunks are told apart by themselves."""
    rows = many(random.Random(4))
    named = F.xxhash64 if name == "hash" else (lambda c: F.length(c).cast("long") % 3)
    got = recipes.exact_duplicates(frame(spark, rows), named).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == brute(rows)
    kept = {}
    for r in got:
        kept.setdefault(r["text_sha256"], []).append(r)
    for group in kept.values():
        stay = [r for r in group if r["kept"]]
        assert len(stay) == 1 and stay[0]["doc_id"] == stay[0]["keep_id"]


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(3, "a  b"), (1, "a b"), (1, "a b"), (None, "a\tb"), (2, None), (9, ""), (7, "other")]
    got = recipes.without_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "row_key", "chunks"] and sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, "a b"), (2, None), (7, "other")]
    empty = spark.createDataFrame([], ROWS)
    assert recipes.exact_duplicates(empty).count() == 0 and recipes.without_duplicates(empty).count() == 0


def test_chunks_are_cut_by_content(spark):
    rng = random.Random(8)
    text = " ".join(rng.choice(["the", "of", "größer", "house", "日本"]) + str(rng.randrange(900)) for _ in range(20_000))
    texts = [text, "Something new stands before it. " + text, text[:50_000] + " and in the middle " + text[50_000:], "é" * 20_000, ""]
    cut = [r["c"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(recipes.chunks(F.col("t")).alias("c")).collect()]
    for t, c in zip(texts, cut, strict=True):
        assert "".join(c).encode("latin-1").decode() == t and all(len(x) <= recipes.MOST for x in c) and all(len(x) >= recipes.LEAST for x in c[:-1])
    assert len(cut[0]) > 50
    for other in cut[1:3]:
        assert len(set(cut[0]) - set(other)) <= 4  # after a change the cuts are the same again
