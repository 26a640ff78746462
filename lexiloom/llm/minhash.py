"""MinHash near-dedup with fast similarity sketches.

A sketch has BANDS * ROWS coordinates.  In round i each shingle of a set is
hashed into one coordinate with the value i + a fraction; after as many rounds
as coordinates, coordinate j gets the least value of the whole set, so every
coordinate fills.  Rounds stop when all are full, so a set of n shingles costs
about n + t log t hashes for t coordinates, and coordinates agree with the
probability of the Jaccard similarity.

With 44 bands of 6 rows a pair at 0.8 is in a common bucket but for 2 cases in a
million.  Documents with equal sets are one node.  In each bucket all nodes are
verified on full sets against one pivot p, which is linear in the bucket.  For
the pairs left, let the difference of x be its symmetric difference with p.  If
x does not link with p, it can link with y only if they share elements that p
lacks, or if y lacks more of p than it has besides, and x lacks some of the same
(else y is no nearer to x than p is).  How many follows from the sizes, so only
nodes that share one of their rarest such elements are verified.  Each node has
a home: of its pivots near it the one that most nodes are near; nodes are also
verified with the homes of their homes.  Nodes of one home are paired by their
differences with that one alone, so near copies meet only at a text near them
all, where what they share is no difference; a bucket of thousands of near
copies gives no pairs of all with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm import words as W
from lexiloom.llm.components import components
from lexiloom.llm.scratch import written
from lexiloom.llm.skew import heavy_keys, spread_join

BANDS, ROWS = 44, 6
_ROUND = W.seeds(2 * BANDS * ROWS, 901)
_BAND = W.seeds(ROWS, 902)
_NAMES = W.seeds(BANDS, 903)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of k words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    if len(words) < k:
        return W.run_hashes(words, len(words), 910 + len(words))
    return np.unique(W.run_hashes(words, k, 900))


def sketch(items: np.ndarray) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of hashes."""
    t = BANDS * ROWS
    out, step, i = np.full(t, np.iinfo(np.uint64).max), max(1, int(1.2 * t * np.log(t) / len(items))), 0
    while i < 2 * t:
        j = min(i + step, 2 * t) if i >= t else min(i + step, t)
        x = W.mix(items[None, :] ^ _ROUND[i:j, None])
        number = np.arange(i, j, dtype=np.uint64)[:, None]
        value = (number << W.U64(48)) | (x & W.U64((1 << 48) - 1))
        if i < t:
            np.minimum.at(out, ((x >> W.U64(48)) % W.U64(t)).ravel(), value.ravel())
        else:
            np.minimum(out[i - t : j - t], value.min(axis=1), out=out[i - t : j - t])
        if out.max() < np.iinfo(np.uint64).max:
            break
        i = j
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    return W.mix((s.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) ^ _NAMES)


def _sets(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    data, at = W.flat(batch.column("text"))
    start, end, of = W.word_bounds(data, at)
    hashes = W.word_hashes(data, start, end, fold=True)
    return [shingle_set(hashes[of[i] : of[i + 1]], k) for i in range(batch.num_rows)]


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text"):
                sets = _sets(part, k)
                sums = np.array([[W.mix(s ^ _NAMES[j]).sum(dtype=np.uint64) for j in (0, 1)] for s in sets], np.uint64).reshape(-1, 2)
                keys = [band_keys(sketch(s)) for s in sets if len(s)]
                offsets = np.cumsum([0, *(BANDS * (len(s) > 0) for s in sets)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), W.longs(sums[:, 0]), W.longs(sums[:, 1]), W.lists(W.longs(np.concatenate([np.zeros(0, W.U64), *keys])), offsets)],
                    ["doc_id", "n_shingles", "s0", "s1", "bands"],
                )

    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text"):
                sets = _sets(part, k)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), W.lists(W.longs(np.concatenate([np.zeros(0, W.U64), *sets])), np.cumsum([0, *map(len, sets)]))], ["doc_id", "items"])

    return run


def _by_pivot(pairs: DataFrame) -> dict[int, int]:
    """Pivots that many of the (a, b) pairs have."""
    return heavy_keys(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), ["b"], pairs.count())


def _with_sets(pairs: DataFrame, sets: DataFrame, heavy: dict[int, int]) -> DataFrame:
    """(a, b) pairs with their sets x and y."""
    one = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
    return spread_join(one, sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), ["b"], heavy, F.xxhash64("a"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored (a, b) pairs with the sizes of both sets and of their intersection."""
    pairs = written(pairs, "pairs")
    common = F.size(F.array_intersect("x", "y"))
    return written(_with_sets(pairs, sets, _by_pivot(pairs)).select("a", "b", common.alias("common"), F.size("x").alias("n_a"), F.size("y").alias("n_b")), "verified")


def _homes(checked: DataFrame, near: float, heavy: dict[int, int]) -> DataFrame:
    """For each a its home: of the pivots near it the one with most near nodes, else the likest."""
    like = F.expr("common / (n_a + n_b - common)")
    of = checked.select("a", "b", like.alias("like"))
    many = of.where(F.col("like") >= near).groupBy("b").agg(F.count(F.lit(1)).alias("many"))
    size = F.when(F.col("like") >= near, F.col("many")).otherwise(F.lit(0))
    return spread_join(of, many, ["b"], heavy, F.xxhash64("a"), "left").groupBy("a").agg(F.max_by("b", F.struct(size, "like", -F.col("b"))).alias("b"))


def _moved(checked: DataFrame, near: float) -> DataFrame:
    """Pairs of nodes with the home of their home, where that is another: one for each node at most."""
    heavy = _by_pivot(checked)
    home = _homes(checked, near, heavy)
    up = home.select(F.col("a").alias("b"), F.col("b").alias("up"))
    return spread_join(home, up, ["b"], heavy, F.xxhash64("a")).where("up <> a").select("a", F.col("up").alias("b")).join(checked.select("a", "b"), ["a", "b"], "left_anti")


def _unmet(checked: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of one pivot b, in different components, that can link: those that share a rare element of their differences."""
    t = percent / 100
    share = t / (1 + t)
    near = 2 * t - 1  # a node less like the pivot than this links with none that links with the pivot
    heavy = _by_pivot(checked)
    home = _homes(checked, near, heavy).withColumnRenamed("b", "home")
    label = home.join(label.withColumnRenamed("id", "a"), "a", "left").select("a", "home", F.coalesce("component", "a").alias("label"))
    g = checked.join(written(label, "labels"), "a")
    g = g.withColumn("stray", F.expr(f"100 * common < {percent} * (n_a + n_b - common)")).withColumn("like", F.expr("common / (n_a + n_b - common)"))
    g = g.withColumn("differ", F.expr("n_a + n_b - 2 * common")).withColumn("far", F.expr(f"{share} * n_a + n_b - common - n_b / 2.0"))
    base = f"n_b * {(1 - t) / (2 * (1 + t))}"
    g = g.withColumn("need", F.expr(f"CAST(greatest(1, ceil(IF(stray, {1 + t} * (far - {base}), far + {base}) - 1e-6)) AS int)"))
    mixed = g.groupBy("b").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count_if("stray").alias("strays"), F.max(F.when(F.col("stray"), F.col("like"))).alias("nearest"), F.count_if(F.col("like") >= near).alias("close"))
    mixed = mixed.where((F.col("lo") != F.col("hi")) & ((F.col("strays") > 1) | (F.col("nearest") >= near))).select("b", "nearest", "close")
    g = spread_join(g, mixed, ["b"], heavy, F.xxhash64("a")).where((F.col("need") <= F.col("differ")) & (F.col("stray") | (F.col("nearest") >= near)))
    g = _with_sets(g, sets, heavy).withColumns({"more": F.array_except("x", "y"), "less": F.array_except("y", "x")}).drop("x", "y")
    g = written(g.select("a", "b", "home", "label", "stray", "like", "close", "differ", "far", "more", "less", (F.col("far") - F.expr(base) - share * F.size("less")).alias("beyond")), "differences")
    often = g.where(F.col("like") >= near).select("b", "close", F.explode(F.concat("more", "less")).alias("e")).groupBy("b", "e").agg(F.count(F.lit(1)).alias("n"), F.first("close").alias("close"))
    often = often.where("n > 1 AND n * 100 >= close").groupBy("b").agg(F.collect_list("e").alias("often"))
    g = spread_join(g, often, ["b"], _by_pivot(g), F.xxhash64("a"), "left").withColumn("often", F.coalesce("often", F.array().cast("array<long>")))
    rare_first = lambda c: F.concat(F.array_except(c, "often"), F.array_intersect(c, "often"))
    g = g.withColumns({f"{c}_{k}": _marks(c, k) for c in ("more", "less") for k in range(MARKS)}).withColumns({"n_more": F.size("more"), "n_less": F.size("less")})
    who = ["a", "b", "home", "label", "stray", "far", "differ", "n_more", "n_less", *[f"{c}_{k}" for c in ("more", "less") for k in range(MARKS)]]

    # Shared elements that p lacks: one at least, or as many more as the sizes ask for.
    some = F.expr(f"CAST(size(more) - greatest(1, ceil({1 + t} * beyond - 1e-6)) + 1 AS int)")
    g = written(g.withColumns({"first_more": F.slice(rare_first("more"), F.lit(1), F.greatest(some, F.lit(0))), "first_less": F.slice(rare_first("less"), F.lit(1), F.greatest(F.size("less") - F.size("more"), F.lit(0)))}).drop("more", "often"), "rare")
    more = g.select(*who, F.explode("first_more").alias("e"))
    met = _meet(more.where("stray"), more, "(NOT t_stray OR a < t_a)")
    # Without one, y must lack more of p than it has besides, and x lack some of the same.
    lacking = g.select(*who, F.explode("first_less").alias("e"))
    there = g.where("stray").join(lacking.select("b").distinct(), "b", "left_semi").select(*who, F.explode("less").alias("e"))
    return met.union(_meet(there, lacking, f"{_most('less')} > t_n_more")).distinct()


#: Words of 64 bits in which the elements of a set are marked.
MARKS = 4


def _marks(column: str, k: int) -> Column:
    """Bits of the elements of a set that fall in word k."""
    mine = F.filter(column, lambda e: F.shiftrightunsigned(e, 6).bitwiseAND(MARKS - 1) == k)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda bits, e: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(63).cast("int"))))


def _most(c: str) -> str:
    """A bound of the elements that the sets `c` of two nodes share: each bit that one lacks is an element that it lacks."""
    gone = lambda x, y: " + ".join(f"bit_count({x}{c}_{k} & ~{y}{c}_{k})" for k in range(MARKS))
    return f"least(n_{c} - ({gone('', 't_')}), t_n_{c} - ({gone('t_', '')}))"


def _meet(one: DataFrame, two: DataFrame, rule: str) -> DataFrame:
    """Pairs of nodes of one pivot with a common element, that are in different components, have no other home in common, and can share enough."""
    two = two.select(*[F.col(c).alias(f"t_{c}") for c in two.columns])
    on = (F.col("b") == F.col("t_b")) & (F.col("e") == F.col("t_e"))
    can = F.expr(f"label <> t_label AND (home <> t_home OR home = b) AND far + t_far <= {_most('more')} + {_most('less')} + 1e-6 AND {rule}")
    return one.join(two, on & can).select(F.greatest("a", "t_a").alias("a"), F.least("a", "t_a").alias("b"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by 100 * |A & B| >= percent * |A | B| of their sets of k-word shingles.

    `docs` has doc_id (integer) and text; other columns are ignored.  Words are
    runs of characters other than ASCII white space, with A-Z lower-cased; a
    text of fewer than k words has its whole sequence as its one shingle.
    Result: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach), kept (doc_id = component_id).

    Null, empty and blank texts have empty sets, link with nothing and are
    kept.  A row with a null doc_id links with nothing and is kept.  Rows that
    repeat a doc_id are one document that holds the sets of all of them.
    An empty table gives no rows.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = written(src.mapInArrow(_sketches(k), "doc_id long, n_shingles long, s0 long, s1 long, bands array<long>"), "sketches")
    full = drawn.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(full.groupBy("s0", "s1").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")), "classes")
    members = spread_join(full.select("doc_id", "s0", "s1"), classes.drop("n"), ["s0", "s1"], heavy_keys(classes, ["s0", "s1"]), F.xxhash64("doc_id"))
    members = written(members.select("doc_id", "node"), "members")
    nodes = full.join(members.where("doc_id = node").select("doc_id").distinct(), "doc_id").select(F.col("doc_id").alias("a"), F.explode("bands").alias("bucket"))

    shared = nodes.groupBy("bucket").agg(F.min("a").alias("b"), F.max("a").alias("last"), F.count(F.lit(1)).alias("n")).where("b <> last")
    shared = written(shared.select("bucket", "b", "n"), "shared")
    inside = written(spread_join(nodes, shared.drop("n"), ["bucket"], heavy_keys(shared, ["bucket"]), F.xxhash64("a")).select("bucket", "a", "b"), "buckets")
    wanted = inside.select(F.col("a").alias("doc_id")).distinct()
    sets = written(src.join(wanted, "doc_id", "left_semi").mapInArrow(_full_sets(k), "doc_id long, items array<long>"), "sets")

    checked = _verified(inside.where("a <> b").select("a", "b").distinct(), sets)
    linked = F.expr(f"100 * common >= {percent} * (n_a + n_b - common)")
    for _ in range(2):
        checked = checked.union(_verified(_moved(checked, percent / 50 - 1), sets))
    links = checked.where(linked).select("a", "b")
    reached = components(links)
    unmet = _unmet(checked, reached, sets, percent).join(checked.select("a", "b"), ["a", "b"], "left_anti")
    label = components(reached.toDF("a", "b").union(_verified(unmet, sets).where(linked).select("a", "b")))
    found = members.join(label.withColumnRenamed("id", "node"), "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    sizes = drawn.select("doc_id", "n_shingles")
    named = sizes.where("doc_id IS NOT NULL").join(found, "doc_id", "left")
    out = named.unionByName(sizes.where("doc_id IS NULL").withColumn("component_id", F.lit(None).cast("long")))
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=80)


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, array_to_string(w[i:i+3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
u AS (SELECT DISTINCT doc_id, md5(g) AS g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, o) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.o FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(o) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
