"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 low quality, 2 good.  P(grade > j) is the
logistic function of w.x - t_j, with one weight vector w over hashed text
features for all grades and ordered thresholds t_0 < t_1.  Features are
presences of hashed words (A-Z lower-cased, split at ASCII signs), their first
four and five bytes, the last three bytes of raw words, and the shape of the
text in tenths: shares of upper-case, sign-ended, repeated and very short words.

The model is fitted in one task on a bounded sample of labelled documents; all
documents are scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.llm import words as W
from lexiloom.llm.scratch import written

#: Most labelled documents that a fit uses: the first by a hash of their ids.
SAMPLE = 12_000
#: Features kept after screening, of SPACE hashed ones.
SPACE, FEATURES = 1 << 20, 6_000
#: PRIOR is the precision of the weights, so a small sample is held more closely to none.
STEPS, PRIOR = 200, 2.4
#: A gradient whose parts are all smaller is none.
FLAT = 1e-6
#: Documents with at least this probability of the highest grade are kept.
TAIL = 0.5

_BREAK = W.SPACE.copy()
_BREAK[[c for c in range(128) if not chr(c).isalnum()]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
_KIND = W.seeds(8, 1001)


def _shares(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each text the tenth that each share of its words falls in."""
    ups, lows = np.concatenate([[0], np.cumsum(_UPPER[data])]), np.concatenate([[0], np.cumsum(_LOWER[data])])
    loud = (ups[end] - ups[start] > 1) & (lows[end] == lows[start])
    last, before = data[end - 1], data[np.maximum(end - 2, start)]
    marked = _BREAK[last] & _BREAK[before] & (end - start > 2)
    same = np.zeros(len(start), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[of[:-1][of[:-1] < len(start)]] = False
    tiny = _BREAK[data[start]] & (end - start == 1)
    out = []
    for flag in (loud, marked, same, tiny):
        total = np.concatenate([[0], np.cumsum(flag)])
        n = np.maximum(of[1:] - of[:-1], 1)
        out.append(np.ceil(10 * (total[of[1:]] - total[of[:-1]]) / n).astype(np.uint64))
    return np.stack(out, axis=1)


def features(texts: pa.Array) -> list[np.ndarray]:
    """The distinct hashed features of each text."""
    data, at = W.flat(texts)
    start, end, of = W.word_bounds(data, at)
    raw = W.word_hashes(data, start, end, fold=False)
    shares = _shares(data, start, end, raw, of)
    tails = W.word_hashes(data, np.maximum(start, end - 3), end, fold=True) ^ _KIND[0]
    s2, e2, of2 = W.word_bounds(data, at, _BREAK)
    inner = [W.word_hashes(data, s2, e2, fold=True)] + [W.word_hashes(data, s2, np.minimum(e2, s2 + k), fold=True) ^ _KIND[k] for k in (4, 5)]
    names = W.mix(shares + _KIND[None, 1:5] * W.U64(16))
    space = W.U64(SPACE)
    inner, tails, names = [(x % space).astype(np.int32) for x in inner], (tails % space).astype(np.int32), (names % space).astype(np.int32)
    return [np.unique(np.concatenate([*(x[of2[i] : of2[i + 1]] for x in inner), tails[of[i] : of[i + 1]], names[i]])) for i in range(len(at) - 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def screened(sets: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """The FEATURES hashed features whose presence departs most from chance in any grade, of those in three documents or more."""
    n, column = len(sets), np.concatenate(sets)
    of = np.repeat(grades, [len(s) for s in sets])
    seen, chance = np.bincount(column, minlength=SPACE).astype(float), np.zeros(SPACE)
    for g in np.unique(grades):
        share = (grades == g).sum() / n
        hits = np.bincount(column[of == g], minlength=SPACE)
        chance = np.maximum(chance, (hits - seen * share) ** 2 / np.maximum(seen * share * (1 - share), 1e-9))
    chance[seen < 3] = 0
    chosen = np.sort(np.argsort(-chance, kind="stable")[:FEATURES])
    return chosen[chance[chosen] > 0].astype(np.int32)


def loss(x: np.ndarray, row: np.ndarray, column: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with the prior, and its gradient.

    x holds the weights, the lower threshold and the logarithm of the gap to the
    upper one, so that thresholds stay ordered.  `row` and `column` list the
    features of each document.
    """
    n, w = len(grades), x[:-2]
    gap = np.exp(x[-1])
    f = np.bincount(row, w[column], n)
    p0, p1 = _sigmoid(x[-2] - f), _sigmoid(x[-2] + gap - f)  # P(grade <= 0), P(grade <= 1)
    low, mid = grades == 0, grades == 1
    between = np.maximum(p1 - p0, 1e-300)
    value = -np.log(np.maximum(np.where(low, p0, np.where(mid, between, 1 - p1)), 1e-300)).mean() + PRIOR / (2 * n) * (w @ w)
    d0, d1 = p0 * (1 - p0), p1 * (1 - p1)
    by_t0 = np.where(low, -(1 - p0), np.where(mid, d0 / between, 0))
    by_t1 = np.where(grades == 2, p1, np.where(mid, -d1 / between, 0))
    g = np.empty_like(x)
    g[:-2] = np.bincount(column, -(by_t0 + by_t1)[row], len(w)) / n + PRIOR / n * w
    g[-2], g[-1] = (by_t0 + by_t1).mean(), by_t1.mean() * gap
    return value, g


def minimise(f, x: np.ndarray, steps: int = STEPS, memory: int = 8) -> tuple[np.ndarray, float]:
    """A minimum of f, which gives value and gradient, and the largest part of the gradient there: under FLAT it is one.

    Quasi-Newton steps from the last `memory` changes, halved until f falls.
    """
    value, g = f(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(g).max() < FLAT:
            break
        d, used = g.copy(), []
        for s, y in reversed(moves):
            a = (s @ d) / (s @ y)
            d -= a * y
            used.append(a)
        d *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, np.abs(g).max())
        for (s, y), a in zip(moves, reversed(used), strict=True):
            d += s * (a - (y @ d) / (s @ y))
        slope, size = g @ d, 1.0
        while size > 1e-10:
            there, h = f(x - size * d)
            if there <= value - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = -size * d, h - g
        x, value, g = x + s, there, h
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
    return x, float(np.abs(g).max())


def fit(sets: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, their weights and the two thresholds, from feature sets and grades 0 to 2."""
    return fit_and_slope(sets, grades)[:3]


def fit_and_slope(sets: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """What `fit` gives, and the largest part of the gradient at the end: it has converged under FLAT."""
    if not len(sets):
        return np.zeros(0, np.int32), np.zeros(0), np.array([-1.0, 0.0]), 0.0
    chosen = screened(sets, grades)
    place = np.full(SPACE, -1)
    place[chosen] = np.arange(len(chosen))
    column = place[np.concatenate(sets)]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[column >= 0]
    column = column[column >= 0]
    shares = [np.clip((grades > j).mean(), 0.01, 0.99) for j in (0, 1)]
    cut = [-np.log(p / (1 - p)) for p in shares]
    begin = np.concatenate([np.zeros(len(chosen)), [cut[0], np.log(max(cut[1] - cut[0], 0.1))]])
    x, slope = minimise(lambda x: loss(x, row, column, grades), begin)
    return chosen, x[:-2], np.array([x[-2], x[-2] + np.exp(x[-1])]), slope


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets, grades = [], []
    for batch in batches:
        for part in W.pieces(batch, "text", 1 << 20):
            sets.extend(features(part.column("text")))
            grades.extend(part.column("grade").to_pylist())
    chosen, weights, cuts, slope = fit_and_slope(sets, np.array(grades, np.int64))
    yield pa.RecordBatch.from_pydict({"features": pa.array([chosen.tolist()], pa.list_(pa.int32())), "weights": pa.array([weights.tolist()], pa.list_(pa.float64())), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64())), "slope": [slope]})


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, grade) of at most SAMPLE labelled documents, the first by a hash of their ids, each doc_id once.

    The labels of one doc_id count as the lowest of their grades; of rows that
    repeat a doc_id the least text counts.  Labels without a document use no place.
    """
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    rated = labels.where("quality IS NOT NULL AND toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(grade).alias("grade"))
    there = rated.join(docs.select("doc_id").hint("merge"), "doc_id", "left_semi")  # both sides grow
    chosen = written(there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "chosen")  # stored, so that only these rows meet the driver
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # SAMPLE rows at most
    return texts.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("text", "grade")


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Fit on labelled documents, at most SAMPLE of them: dict of features, weights, cuts and slope (see fit_and_slope).

    `labels` has doc_id, quality (0 or 1) and toxic (0 or 1); rows with a null
    there or a doc_id that `docs` lacks are left out.  Without any usable label the
    model has no weights and keeps every document.
    """
    rows = labelled(docs, labels).sort(F.xxhash64("text"), "text", "grade").coalesce(1)
    got = rows.mapInArrow(_fit_task, "features array<int>, weights array<double>, cuts array<double>, slope double").first()
    if got:
        return got.asDict()
    return dict(zip(("features", "weights", "cuts", "slope"), (np.asarray(x).tolist() for x in fit_and_slope([], np.zeros(0, np.int64))), strict=True))


def _scores(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(SPACE)
        weight[np.array(model["features"], np.int64)] = model["weights"]
        for batch in batches:
            for part in W.pieces(batch, "text", 1 << 20):
                f = np.array([weight[x].sum() for x in features(part.column("text"))])
                over = [_sigmoid(f - t) for t in model["cuts"]]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(over[0] + over[1]), pa.array(over[1])], [*part.schema.names, "expected_grade", "tail_probability"])

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """All rows and columns of `docs` with expected_grade (0 to 2) and tail_probability (of grade 2).

    Null and empty texts are scored by their empty set of words.  Repeated rows
    and null ids are rows like others; an empty table gives no rows.  Columns
    already named expected_grade or tail_probability are replaced.
    """
    docs = docs.drop("expected_grade", "tail_probability")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # so that no name of another column matters
    src = plain.withColumn("text", F.col(f"c{names.index('text')}").cast("string"))
    schema = T.StructType([*src.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())])
    return src.mapInArrow(_scores(model), schema).drop("text").toDF(*names, "expected_grade", "tail_probability")


def select(docs: DataFrame, labels: DataFrame, tail: float = TAIL) -> DataFrame:
    """The documents, with all their columns, whose probability of the highest grade is `tail` or more; rows are treated as by `score`."""
    names = docs.columns
    plain = docs.toDF(*[f"d{i}" for i in range(len(names))])
    scored = score(plain.withColumn("text", F.col(f"d{names.index('text')}")), train(docs, labels))
    return scored.where(F.col("tail_probability") >= tail).select(*plain.columns).toDF(*names)


def op10(spark, sf_dir: str) -> DataFrame:
    """Both scores of every document, and whether it is kept."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs.select("doc_id", "text"), train(docs, labels)).select("doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= TAIL).alias("kept"))
