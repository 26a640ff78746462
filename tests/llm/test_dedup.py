"""Dedup operators against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from lexiloom.llm import minhash, neighbours, skew, substrings
from lexiloom.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, th string, `text ` string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS).repartition(3)


def edge_rows():
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (None, "a b c d e f"), (None, "a b c d e f"), (6, long), (7, long), (8, "x y"), (8, "x y"), (9, "ü　ü")]


def families(rng, vocabulary=4000):
    word = lambda: f"w{rng.randrange(vocabulary)}"

    def edit(w, k, cut):
        w = list(w)
        for _ in range(k):
            i, what = rng.randrange(len(w)), rng.random()
            if what < 0.5:
                w[i] = word()
            elif what < 0.7:
                del w[i]
            else:
                w.insert(i, word())
        return w[: len(w) - rng.randrange(1, 25)] if cut and rng.random() < 0.4 else w

    docs = []
    for g in range(2):
        base = [word() for _ in range(130)]
        one = [edit(base, rng.randrange(1, 8), g) for _ in range(110)]
        docs += one + [edit(rng.choice(one), rng.randrange(5), g) for _ in range(110)]
    passage = [word() for _ in range(110)]
    docs += [[word() for _ in range(50)] + passage + [word() for _ in range(50)] for _ in range(90)]
    docs += [list(rng.choice(docs)) for _ in range(60)]
    rng.shuffle(docs)
    return [" ".join(d) for d in docs]


def brute_components(texts, k, percent):
    def shingles(t):
        w = WORD.findall("" if t is None else re.sub("[A-Z]+", lambda m: m[0].lower(), t))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if a and 100 * c >= percent * (len(a) + len(sets[j]) - c):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    rng = random.Random(1)
    texts = ["".join(rng.choice(" \t\n\x0b\x0cabü　\x1c") for _ in range(rng.randrange(40))) for _ in range(300)] + [None, ""]
    data, at = W.flat(pa.array(texts))
    start, end, of = W.word_bounds(data, at)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        got = [raw[s:e].decode() for s, e in zip(start[of[i] : of[i + 1]], end[of[i] : of[i + 1]], strict=True)]
        assert got == WORD.findall(t or "")
    hashes, names = W.word_hashes(data, start, end, fold=False), [raw[s:e] for s, e in zip(start, end, strict=True)]
    assert len(set(hashes.tolist())) == len(set(names)) == len({(h, n) for h, n in zip(hashes.tolist(), names, strict=True)})


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 5000):
        s = minhash.sketch(rng.integers(0, 1 << 63, n).astype(np.uint64))
        assert s.max() < np.iinfo(np.uint64).max
    agree = []
    for _ in range(60):
        common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
        agree.append((minhash.sketch(np.concatenate([common, a])) == minhash.sketch(np.concatenate([common, b]))).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02


@pytest.mark.parametrize("seed", [5, 11, 12, 13])
def test_near_duplicates_against_brute_force(spark, seed):
    texts = families(random.Random(seed))
    want, sizes = brute_components(texts, 4, 80)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, list(enumerate(texts))), 4, 80).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_near_duplicates_edges(spark):
    rows = edge_rows()
    got = minhash.near_duplicates(frame(spark, rows), 5, 80).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None}
    assert by == {1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (4, False), 6: (6, True), 7: (6, False), 8: (8, True), 9: (9, True)}
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert minhash.near_duplicates(frame(spark, []), 5, 80).count() == 0


def brute_passages(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_passages_against_brute_force(spark):
    rng = random.Random(7)
    texts = families(rng, 300) + [" ".join(["la"] * 90), " ".join(f"v{i}" for i in range(34)), " ".join(f"v{i}" for i in range(35)), "p " + " ".join(f"v{i}" for i in range(35)) + " q"]
    want = brute_passages(texts, 35)
    got = {r["doc_id"]: r for r in substrings.repeated_passages(frame(spark, list(enumerate(texts)))).collect()}
    assert [(got[i]["n_words"], got[i]["n_removed"]) for i in range(len(texts))] == [x[:2] for x in want]
    assert [got[i]["left"] for i in range(len(texts))] == [hashlib.sha256(x[2].encode()).hexdigest() for x in want]
    spans = {i: [(s["start"], s["end"]) for s in r["repeats"] or []] for i, r in got.items()}
    for i, t in enumerate(texts):
        words, bounds = WORD.findall(t), [0, *(x for s in spans[i] for x in s), len(WORD.findall(t))]
        assert " ".join(w for a, b in zip(bounds[::2], bounds[1::2], strict=True) for w in words[a:b]) == want[i][2]
        assert all(b - a >= 35 for a, b in spans[i]) and all(b < a for (_, b), (a, _) in zip(spans[i], spans[i][1:], strict=False))
    made = substrings.without_repeats(frame(spark, list(enumerate(texts))))
    assert made.columns == ["doc_id", "text", "th", "text ", "n_removed"]
    assert {r["doc_id"]: r["text"] for r in made.collect()} == {i: x[2] if x[1] else texts[i] for i, x in enumerate(want)}


def test_passages_edges(spark):
    rows = edge_rows()
    got = substrings.repeated_passages(frame(spark, rows)).collect()
    want = brute_passages([t for _, t in rows], 35)
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got) == sorted((i or 0, *w[:2]) for (i, _), w in zip(rows, want, strict=True))
    assert substrings.repeated_passages(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substrings.repeated_passages(frame(spark, []), length=5)


def test_passages_of_many_equal_rows(spark):
    """A third of all rows are copies without an id, others share one passage; one text differs in one word alone."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(4000)}"
    hot, passage = " ".join(word() for _ in range(80)), " ".join(word() for _ in range(45))
    rows = [(None, hot)] * 1000 + [(None, hot.replace(hot.split()[40], "other"))] + [(i, " ".join([word() for _ in range(20)] + [passage] + [word() for _ in range(20)])) for i in range(1000)]
    rows += [(3000 + i, " ".join(word() for _ in range(60))) for i in range(1000)]
    want = brute_passages([t for _, t in rows], 35)
    got = substrings.repeated_passages(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["left"]) for r in got) == sorted((i or -1, w[0], w[1], hashlib.sha256(w[2].encode()).hexdigest()) for (i, _), w in zip(rows, want, strict=True))


def test_lopsided_keys_are_spread(spark):
    many = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    few = many.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k % 2 = 0").withColumn("x", F.col("k") + 1)
    heavy = skew.heavy_keys(few, ["k"])
    assert list(heavy.values()) == [-(-3334 * skew.SHARE // few.agg(F.sum("n")).first()[0])]
    for how in ("inner", "left"):
        got = sorted(tuple(r) for r in skew.spread_join(many, few, ["k"], heavy, F.col("v"), how).select("k", "v", "x").fillna(-1).collect())
        assert got == sorted(tuple(r) for r in many.join(few, "k", how).select("k", "v", "x").fillna(-1).collect())
    assert skew.heavy_keys(few.limit(0), ["k"]) == {}


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 24))
    x = np.concatenate([centre[rng.integers(0, 40, 500)] + rng.normal(size=(500, 24)) * 0.25, rng.normal(size=(300, 24))]).astype(np.float32)
    x[100:140] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {r["vec_id"]: r for r in neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = sum(r["n_links"] for r in got.values())
    assert 0.97 * near.sum() <= found <= near.sum()
    root = neighbours._roots(len(x), *np.nonzero(near))
    assert np.mean([got[i]["component_id"] == root[i] for i in range(len(x))]) > 0.98
    assert all(got[i]["n_links"] <= near[i].sum() for i in range(len(x)))


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (11, [1e-30, 2e-30]), (12, [-1.0, 5.0])]
    got = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert len(got) == len(rows)
    assert {i: by[i] for i in (7, 8, 9, 11)} == {7: (3, 7, True), 8: (3, 7, False), 9: (3, 7, False), 11: (3, 7, False)}
    assert all(by[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 12)) and by[None] == (0, None, True)
    assert neighbours.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_components_rounds(spark, monkeypatch):
    """Stars need no round, and none is run to see that nothing changes; components are right on chains, stars and loops."""
    from lexiloom.llm import components as C

    cuts, rng = [], np.random.default_rng(7)
    monkeypatch.setattr(C, "cut", lambda df, f=C.cut: cuts.append(1) or f(df))

    def found(links):
        cuts.clear()
        got = [tuple(r) for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()]
        root = {x: x for ab in links if None not in ab and ab[0] != ab[1] for x in ab}
        for _ in root:
            for a, b in links:
                if a in root and b in root and a != b:
                    root[a] = root[b] = min(root[a], root[b])
        assert len(got) == len(root) and dict(got) == root
        return len(cuts)

    star = [(i, 3) for i in range(4, 40)] + [(3, 9), (50, 51), (51, 50), (7, 7), (None, 8), (8, None)]
    assert found(star) == 1
    assert found([]) == 1
    assert found([*star, (45, 44), (44, 46), (46, 12)]) <= 4
    assert found([(i, i + 1) for i in range(30)]) <= 7
    found([tuple(map(int, rng.integers(0, 60, 2))) for _ in range(45)])
