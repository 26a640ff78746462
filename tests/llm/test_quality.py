"""The classifier against brute force: its gradient, a plain fit, and every score of the query."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import quality
from lexiloom.llm import words as W

SF = "/root/testdata/sf0.001"


def small(seed=1, n=120):
    """Feature sets of few features, some of which tell the grade."""
    rng = np.random.default_rng(seed)
    grades = rng.integers(0, 3, n)
    sets = [np.unique(np.concatenate([rng.integers(0, 40, 6), [50 + g] if rng.random() < 0.7 else []])).astype(np.int32) for g in grades]
    return sets, grades


def flat(sets, chosen):
    place = {int(c): i for i, c in enumerate(chosen)}
    pairs = [(r, place[int(f)]) for r, s in enumerate(sets) for f in s if int(f) in place]
    return np.array([r for r, _ in pairs]), np.array([c for _, c in pairs])


def likelihood(x, sets, grades, chosen):
    """The mean negative log-likelihood with the prior, document by document."""
    w, t = dict(zip(chosen.tolist(), x[:-2], strict=True)), (x[-2], x[-2] + np.exp(x[-1]))
    over = lambda f, j: 1 / (1 + np.exp(-(f - t[j])))
    total = 0.0
    for s, g in zip(sets, grades, strict=True):
        f = sum(w.get(int(i), 0.0) for i in s)
        total -= np.log([1 - over(f, 0), over(f, 0) - over(f, 1), over(f, 1)][g])
    return total / len(sets) + quality.PRIOR / (2 * len(sets)) * (x[:-2] @ x[:-2])


def test_gradient_by_differences():
    sets, grades = small()
    chosen = quality.screened(sets, grades)
    row, column = flat(sets, chosen)
    x = np.random.default_rng(2).normal(size=len(chosen) + 2) / 3
    value, g = quality.loss(x, row, column, grades)
    assert value == pytest.approx(likelihood(x, sets, grades, chosen), rel=1e-9)
    for i in range(len(x)):
        e = np.zeros_like(x)
        e[i] = 1e-5
        assert g[i] == pytest.approx((likelihood(x + e, sets, grades, chosen) - likelihood(x - e, sets, grades, chosen)) / 2e-5, abs=1e-7)


def test_fit_is_that_of_plain_descent():
    sets, grades = small(3)
    chosen, weights, cuts, slope = quality.fit_and_slope(sets, grades)
    assert slope < quality.FLAT and cuts[0] < cuts[1]
    row, column = flat(sets, chosen)
    x = np.zeros(len(chosen) + 2)
    for _ in range(30_000):
        x -= 0.5 * quality.loss(x, row, column, grades)[1]
    assert np.abs(x[:-2] - weights).max() < 1e-3 and np.abs([x[-2] - cuts[0], x[-2] + np.exp(x[-1]) - cuts[1]]).max() < 1e-3


def test_a_stopped_fit_says_so():
    sets, grades = small(3)
    chosen = quality.screened(sets, grades)
    row, column = flat(sets, chosen)
    assert quality.minimise(lambda x: quality.loss(x, row, column, grades), np.zeros(len(chosen) + 2), steps=2)[1] > quality.FLAT


def plain_features(text):
    """The features of a text, one word at a time."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    one = lambda a, b, fold: int(W.word_hashes(data, np.array([a]), np.array([b]), fold)[0])
    space, out = quality.SPACE, set()
    raw = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data.tobytes())]
    ascii_sign = rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]"
    for a, b in (m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", data.tobytes())):
        out |= {one(a, b, True) % space, (one(a, min(b, a + 4), True) ^ int(quality._KIND[4])) % space, (one(a, min(b, a + 5), True) ^ int(quality._KIND[5])) % space}
    words = [data.tobytes()[a:b] for a, b in raw]
    out |= {(one(max(a, b - 3), b, True) ^ int(quality._KIND[0])) % space for a, b in raw}
    loud = sum(len(re.findall(rb"[A-Z]", w)) > 1 and not re.search(rb"[a-z]", w) for w in words)
    marked = sum(len(w) > 2 and bool(re.fullmatch(ascii_sign + rb"{2}", w[-2:])) for w in words)
    same = sum(x == y for x, y in zip(words, words[1:]))
    tiny = sum(bool(re.fullmatch(ascii_sign, w)) for w in words)
    for k, n in enumerate((loud, marked, same, tiny), 1):
        share = int(np.ceil(10 * n / max(len(words), 1)))
        out.add(int(W.mix(np.array([share + int(quality._KIND[k]) * 16 & (1 << 64) - 1], np.uint64))[0]) % space)
    return sorted(out)


def test_features_one_by_one():
    texts = ["", None, "One TWO two, two two!! % x 9a", "ünder Äö 日本\tA.B.C ###", "SHOUT!!! SHOUT!!! ok ok ok - -", "a" * 300]
    got = quality.features(pa.array(texts))
    assert [x.tolist() for x in got] == [plain_features(t) for t in texts]


def test_query_against_brute_force(spark):
    """Scores of all documents from the fitted weights, one document at a time; the fit on the labelled ones."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    assert model["slope"] < quality.FLAT
    grade = {}
    for r in labels.collect():
        if None not in (r["quality"], r["toxic"], r["doc_id"]):
            g = 0 if r["toxic"] > 0 else 2 if r["quality"] > 0 else 1
            grade[r["doc_id"]] = min(g, grade.get(r["doc_id"], 2))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rated = [d for d in grade if d in texts]
    chosen, weights, cuts = quality.fit([np.array(plain_features(texts[d]), np.int32) for d in rated], np.array([grade[d] for d in rated]))
    assert chosen.tolist() == model["features"] and np.abs(weights - model["weights"]).max() < 1e-3 and np.abs(cuts - model["cuts"]).max() < 1e-3
    weight = dict(zip(model["features"], model["weights"], strict=True))
    for r in quality.op10(spark, SF).collect():
        f = sum(weight.get(i, 0.0) for i in plain_features(texts[r["doc_id"]]))
        over = [1 / (1 + np.exp(-(f - t))) for t in model["cuts"]]
        assert r["expected_grade"] == pytest.approx(sum(over), abs=1e-9) and r["tail_probability"] == pytest.approx(over[1], abs=1e-9)
        assert r["kept"] == (r["tail_probability"] >= quality.TAIL)


def test_ties_and_repeated_ids(spark):
    """A row at exactly the bound stays; rows that repeat a doc_id are scored by their own texts; their least text is what a label is about."""
    docs = spark.createDataFrame([(1, "b good"), (1, "a bad"), (1, "a bad"), (2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in quality.labelled(docs, labels).collect()] == [("a bad", 0)]
    even = {"features": [], "weights": [], "cuts": [-1.0, 0.0]}
    got = quality.score(docs, even).collect()
    assert len(got) == 4 and all(r["tail_probability"] == 0.5 for r in got)
    assert quality.score(docs, even).where(F.col("tail_probability") >= quality.TAIL).count() == 4 and quality.select(docs, labels.limit(0)).count() == 4
