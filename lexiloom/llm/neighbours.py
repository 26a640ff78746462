"""Near-duplicate embeddings by a pivot-permutation index.

Reference vectors (pivots) are a hash sample of the data, about 4 sqrt(n) of
them.  A vector is described by its PREFIX nearest pivots in order, and stands
in the inverted lists of the first HEAD of them.  Two vectors are candidates if
one list holds both and their prefixes share SHARED pivots or more; the count is
taken in the list of the least pivot among the first HEAD of both, so each pair
is met once.  Candidates are verified by cosine in double precision.

Lists are cut into blocks of about BLOCK rows by hash, and a task gets two
blocks, so neither memory nor a task grows with a list.  A task returns how
many vectors each of its vectors links with and a spanning forest of the links,
never the links themselves.  Equal vectors are one node with a weight.

Every task holds the pivots, so MOST_PIVOTS bounds them; lists of 4 sqrt(n)
pivots hold about 2 sqrt(n) vectors each.  Beyond (MOST_PIVOTS / 4) ** 2
vectors, 268 million, lists grow with n and a vector is sent once for each
block of its lists; nothing is dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.components import components
from lexiloom.llm.scratch import written
from lexiloom.llm.skew import heavy_keys, spread_join

PREFIX, HEAD, SHARED, BLOCK = 16, 12, 2, 1024
#: Bounds of the number of pivots, which every task holds in single precision.
LEAST_PIVOTS, MOST_PIVOTS = 32, 65_536


def usable(vector: Column, zero: bool) -> Column:
    """Whether a vector has components, all finite; with `zero`, not all zero too."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = vector.isNotNull() & (F.size(vector) > 0) & finite
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0) if zero else ok, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _prefixes(pivots: dict[int, tuple[np.ndarray, np.ndarray]], prefix: int):
    def run(batches):
        for batch in batches:
            size = np.array([len(v) for v in batch.column("vector")])
            out = [None] * batch.num_rows
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                if int(d) not in pivots:
                    for i in rows:
                        out[i] = [-1 - int(d)]
                    continue
                names, p = pivots[int(d)]
                step = max(64, (1 << 22) // len(names))  # so that a table of products stays small
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    near = _unit(_matrix(batch.column("vector").take(pa.array(some)))).astype(np.float32) @ p.T
                    k = min(prefix, len(names))
                    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    order = np.argsort(-np.take_along_axis(near, best, axis=1), axis=1, kind="stable")
                    for i, row in zip(some, names[np.take_along_axis(best, order, axis=1)].tolist(), strict=True):
                        out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, "prefix"])

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that links reach from each of n numbers."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _linked(cosine: float, shared: int, head: int):
    def run(key, table):
        pivot, i, j = (k.as_py() for k in key)
        block = table.column("block").to_numpy()
        ids, weight, x = table.column("id").to_numpy(), table.column("weight").to_numpy(), _unit(_matrix(table.column("vector")))
        prefix = table.column("prefix").combine_chunks()
        which, row = np.unique(prefix.flatten().to_numpy(), return_inverse=True)
        begin = prefix.offsets.to_numpy()
        of, rank = np.repeat(np.arange(len(ids)), np.diff(begin)), np.arange(len(row)) - np.repeat(begin[:-1] - begin[0], np.diff(begin))
        has, first = np.zeros((len(ids), len(which)), np.float32), np.zeros((len(ids), len(which)), np.float32)
        has[of, row] = 1
        first[of[rank < head], row[rank < head]] = 1
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links, a_out, b_out = np.zeros(len(ids), np.int64), [], []
        few, lower = min(shared, int(np.diff(begin).min(initial=shared))), which < pivot
        for at in range(0, len(one), 256):
            some = one[at : at + 256]
            near = (has[some] @ has[two].T >= few) & (first[some][:, lower] @ first[two][:, lower].T == 0)
            if i == j:
                near &= ids[some][:, None] < ids[two][None, :]
            a, b = np.nonzero(near)
            if len(a) * 8 > near.size:
                ok = (x[some] @ x[two].T)[a, b] >= cosine
            else:
                ok = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", x[some[a[s : s + 65536]]], x[two[b[s : s + 65536]]]) >= cosine for s in range(0, len(a), 65536))])
            a, b = some[a[ok]], two[b[ok]]
            links += np.bincount(a, weight[b], len(ids)).astype(np.int64) + np.bincount(b, weight[a], len(ids)).astype(np.int64)
            root = _roots(len(ids), a, b)
            tied = np.flatnonzero(root != np.arange(len(ids)))
            a_out.append(ids[tied])
            b_out.append(ids[root[tied]])
        some = np.flatnonzero(links)
        a, b = np.concatenate([np.zeros(0, np.int64), *a_out]), np.concatenate([np.zeros(0, np.int64), *b_out])
        return pa.table({"id": pa.array(np.concatenate([ids[some], a])), "links": pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)])), "other": pa.array(np.concatenate([ids[some], b]))})

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, prefix: int = PREFIX, head: int = HEAD, shared: int = SHARED) -> DataFrame:
    """Components of vectors linked by a cosine of `cosine` or more: vec_id, n_links, component_id, kept.

    `vectors` has vec_id (integer) and embedding (array of numbers); other
    columns are ignored.  n_links counts the other vectors linked directly,
    component_id is the smallest vec_id that links reach, kept is vec_id =
    component_id.  Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing; vectors of different lengths do
    not link.  A null vec_id links with nothing and is kept; rows that repeat a
    vec_id are vectors of their own with one id.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    fit = usable(F.col("vector"), zero=True) & F.col("vec_id").isNotNull()
    good = src.where(fit)
    nodes = written(good.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "nodes")
    many = nodes.count()
    m = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, 4 * many**0.5)))
    pivots: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    sample = nodes.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(m).toArrow()  # at most MOST_PIVOTS vectors
    if sample.num_rows:
        size = np.array([len(v) for v in sample.column("vector")])
        for d in np.unique(size):
            rows = np.flatnonzero(size == d)
            pivots[int(d)] = rows.astype(np.int32), _unit(_matrix(sample.column("vector").take(pa.array(rows)))).astype(np.float32)
    described = written(nodes.mapInArrow(_prefixes(pivots, prefix), "vector array<double>, id long, weight long, prefix array<int>"), "prefixes")

    first = F.explode(F.slice("prefix", 1, head)).alias("pivot")
    lists = described.select("id", "weight", "vector", "prefix", first)
    sizes = described.select(first).groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    lists = lists.join(F.broadcast(sizes), "pivot")  # at most one row for each pivot
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    lists = lists.withColumn("block", block).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = lists.select("pivot", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "id", "weight", "vector", "prefix")
    found = written(lists.groupBy("pivot", "i", "j").applyInArrow(_linked(cosine, shared, head), "id long, links long, other long"), "links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    component = components(found.where("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    found = nodes.join(links, "id", "left").join(component, "id", "left")
    found = written(found.select("vector", F.col("weight").alias("n"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "id").alias("component")), "found")
    of = spread_join(good, found, ["vector"], heavy_keys(found, ["vector"]), F.monotonically_increasing_id()).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = src.where(~F.coalesce(fit, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.9)


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r(vec_id, o) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.o FROM r JOIN l ON l.a = r.vec_id),
m AS (SELECT vec_id, min(o) AS component_id FROM r GROUP BY vec_id),
c AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN m USING (vec_id) LEFT JOIN c USING (vec_id)
"""
