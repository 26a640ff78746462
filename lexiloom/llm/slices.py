"""Exact top-k inner products by a bit-sliced index.

Rows are cut into blocks.  Each attribute of a block is quantised to a few bits
and stored as slices: bitmaps of one bit over the rows.  The index is a table of
one row for each block, written once.  For a query the
attribute slices are multiplied by the query's weights (an added, shifted copy
for each digit) and summed with carry-save adders, whole bitmaps at a time, to
the slices of an approximate score.  Top rows are selected from the most
significant slice downward.  The quantisation error has a bound for each query;
rows within it of the boundary are resolved by their exact scores.

Queries are a stated set and are scored against all rows in blocks: each pair of
a row block and a query block is a task of bounded size, and gives at most k
rows for each query, whose order is total (score, then id).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.neighbours import usable
from lexiloom.llm.scratch import written

#: Most rows and components of an index block, queries of a query block, bits of a quantised attribute with sign.
ROWS, CELLS, QUERIES, BITS = 16384, 1 << 20, 1024, 7
#: Scores beyond a long count as the largest or smallest one.
LONG = (1 << 63) - 1


def digits(x: int) -> list[tuple[int, int]]:
    """x as a sum of signed powers of two, no two adjacent: (sign, exponent)."""
    out, at = [], 0
    while x:
        if x & 1:
            d = 2 - (x & 3)
            out.append((d, at))
            x -= d
        x >>= 1
        at += 1
    return out


def _most(x: np.ndarray) -> int:
    """The largest size of a component."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


class Block:
    """The bit-sliced index of one block of integer rows; `slices` of a stored block are taken as they are."""

    def __init__(self, rows: np.ndarray, slices: bytes | None = None):
        self.n, self.rows, self.most = len(rows), rows, _most(rows)
        self.shift = max(0, self.most.bit_length() + 1 - BITS)
        self.offset = 1 << (BITS - 1)
        self.width = -(-self.n // 64)
        if slices is None:
            coarse = (rows >> self.shift) + self.offset  # 0 to 2 ** BITS - 1
            padded = np.zeros((self.width * 64, rows.shape[1]), np.uint8)
            padded[: self.n] = coarse
            bits = ((padded[:, :, None] >> np.arange(BITS, dtype=np.uint8)) & 1).transpose(1, 2, 0)
            self.slices = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)  # attribute, bit, word
        else:
            self.slices = np.frombuffer(slices, np.uint64).reshape(rows.shape[1], BITS, self.width)
        self.live = np.packbits(np.arange(self.width * 64) < self.n, bitorder="little").view(np.uint64)

    def approximate(self, query: np.ndarray) -> np.ndarray:
        """Slices of sum_d q_d * coarse_d, shifted to be no less than 0 by a constant."""
        terms: list[tuple[int, np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            for sign, at in digits(q):
                # -c is the complement of c less a constant, so every term is an addition
                terms.append((at, self.slices[d] if sign > 0 else ~self.slices[d]))
        top = BITS + max((at for at, _ in terms), default=0) + len(terms).bit_length() + 1
        total, carry = np.zeros((top, self.width), np.uint64), np.zeros((top, self.width), np.uint64)
        for at, s in terms:  # carry-save: a + b + c = (a ^ b ^ c) + 2 * majority(a, b, c)
            part, held = total[at : at + BITS], carry[at : at + BITS]
            both = part ^ held
            up = (part & held) | (both & s)
            np.bitwise_xor(both, s, out=part)
            held[0] = 0
            held[1:] = up[:-1]
            k, add = at + BITS, up[-1]
            while add.any():  # where two carries of one weight meet, they are one of the next
                meet = carry[k] & add
                carry[k] ^= add
                k, add = k + 1, meet
        while carry.any():
            meet = total & carry
            total ^= carry
            carry[1:] = meet[:-1]
            carry[0] = 0
        return total

    def packed(self, some: np.ndarray) -> np.ndarray:
        """A bitmap of some of the rows."""
        return np.packbits(np.pad(some, (0, self.width * 64 - self.n)), bitorder="little").view(np.uint64)

    def select(self, slices: np.ndarray, k: int, live: np.ndarray) -> int:
        """The k-th largest value (k at most the number of live rows) that slices hold for them, from the most significant downward."""
        alive, value, left = live, 0, k
        for at in range(len(slices) - 1, -1, -1):
            ones = alive & slices[at]
            n = int(np.bitwise_count(ones).sum())
            if n >= left:
                alive, value = ones, value | (1 << at)
            else:
                left -= n
                alive = alive & ~slices[at]
        return value

    def at_least(self, slices: np.ndarray, value: int) -> np.ndarray:
        """Rows whose value is `value` or more."""
        if value <= 0:
            return np.arange(self.n)
        same, over = self.live.copy(), np.zeros(self.width, np.uint64)
        for at in range(len(slices) - 1, -1, -1):
            if value >> at & 1:
                same = same & slices[at]
            else:
                over |= same & slices[at]
                same = same & ~slices[at]
        if value >> len(slices):
            return np.zeros(0, np.int64)
        return np.flatnonzero(np.unpackbits((same | over).view(np.uint8), bitorder="little")[: self.n])

    def top(self, query: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can be among the k best of those that are not the query's own, and their exact scores."""
        others = np.ones(self.n, bool)
        others[[] if own is None else own] = False
        total = sum(abs(x) for x in query.tolist())
        if self.most * total > LONG:  # sums may pass a long: every row is resolved, in integers of any size
            keep = np.flatnonzero(others)
            big = [sum(x * y for x, y in zip(row, query.tolist(), strict=True)) for row in self.rows[keep].tolist()]
            return keep, np.array([min(max(x, -LONG - 1), LONG) for x in big], np.int64)
        if others.sum() <= 4 * k:
            keep = np.flatnonzero(others)
        else:
            # a row is 2 ** shift * coarse + rest with 0 <= rest < 2 ** shift
            least = -int(np.abs(query[query < 0]).sum()) * ((1 << self.shift) - 1)
            most = int(query[query > 0].sum()) * ((1 << self.shift) - 1)
            slices = self.approximate(query)
            edge = self.select(slices, k, self.packed(others))
            keep = self.at_least(slices, edge - -(-(most - least) >> self.shift) - 1)
            keep = keep[others[keep]]
        return keep, self.rows[keep] @ query


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _ints(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of longs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


_INDEX = "r int, d int, ids binary, rows binary, slices binary"


def _build(key, table):
    """The index rows of a block: one for each length of vectors."""
    size, out = np.array([len(v) for v in table.column("ints")]), []
    for d in np.unique(size):
        some = pa.array(np.flatnonzero(size == d))
        rows = _ints(table.column("ints").take(some))
        out.append((key[0].as_py(), int(d), table.column("vec_id").take(some).to_numpy().tobytes(), rows.tobytes(), Block(rows).slices.tobytes()))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("r", "d", "ids", "rows", "slices"), zip(*out, strict=True), kinds, strict=True)})


def _score(k: int):
    """The best rows of one index block for each query of one query block."""

    def run(key, table):
        asked = table.filter(pc.is_valid(table.column("vec_id")))
        sizes = np.array([len(v) for v in asked.column("ints")])
        names, ranks, scores = [], [], []
        for index in table.filter(pc.is_valid(table.column("ids"))).select(["d", "ids", "rows", "slices"]).to_pylist():
            of = np.flatnonzero(sizes == index["d"])
            if not len(of):
                continue
            ids = np.frombuffer(index["ids"], np.int64)
            block = Block(np.frombuffer(index["rows"], np.int64).reshape(len(ids), -1), index["slices"])
            queries, asking = _ints(asked.column("ints").take(pa.array(of))), asked.column("vec_id").to_numpy()[of]
            by_id = np.argsort(ids, kind="stable")
            first, last = (np.searchsorted(ids, asking, side, sorter=by_id) for side in ("left", "right"))
            for name, query, lo, hi in zip(asking, queries, first, last, strict=True):
                keep, score = block.top(query, k, by_id[lo:hi])
                order = np.lexsort((-1 - ids[keep], score))[::-1][:k]  # scores descending without a change of sign, then ids ascending
                names.append(np.full(len(order), name))
                ranks.append(ids[keep][order])
                scores.append(score[order])
        join = lambda x: pa.array(np.concatenate([np.zeros(0, np.int64), *x]))
        return pa.table({"query_id": join(names), "vec_id": join(ranks), "score": join(scores)})

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """The k rows of highest inner product for each query: query_id, rank (from 1), vec_id, score.

    `vectors` has vec_id (integer) and embedding (array of numbers); other
    columns are ignored.  Components x count as floor(scale * x), or as the
    nearest long.  `queries` is a condition on vec_id; candidates are all rows but
    those with the query's id.  Ties go to the smaller vec_id.  Vectors that are
    null or empty, or hold null or non-finite components, and rows with a null
    vec_id take no part; vectors of different lengths do not meet.  Rows that
    repeat a vec_id are candidates of their own, and one query if they are equal.
    Scores are exact; beyond a long they are the largest or smallest one.  An
    empty table gives no rows.
    """
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    good = src.where(usable(F.col("vector"), zero=False) & F.col("vec_id").isNotNull()).select("vec_id", quantised(F.col("vector"), scale).alias("ints"))
    n_rows, widest = good.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("ints")), F.lit(1))).first()
    asked = written(good.where(queries).distinct(), "queries")
    size = max(64, min(ROWS, CELLS // widest))
    row_blocks, query_blocks = max(1, -(-n_rows // size)), max(1, -(-asked.count() // QUERIES))
    block = lambda n, *salt: F.pmod(F.xxhash64("vec_id", "ints", *salt), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Of equal rows no query can have more than k, and their blocks differ.
    rows = good.groupBy("vec_id", "ints").count().select("vec_id", "ints", F.explode(F.sequence(F.lit(1), F.least("count", F.lit(k)).cast("int"))).alias("copy"))
    index = written(rows.select("vec_id", "ints", block(row_blocks, "copy").alias("r")).groupBy("r").applyInArrow(_build, _INDEX), "index").withColumn("q", each(query_blocks))
    some = asked.select("vec_id", "ints", each(row_blocks).alias("r"), block(query_blocks).alias("q"))
    found = index.unionByName(some, allowMissingColumns=True).groupBy("r", "q").applyInArrow(_score(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


OP2_SQL = """
WITH g AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM g q JOIN g c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
