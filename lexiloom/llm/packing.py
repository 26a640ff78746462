"""Best-fit packing by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut; pieces that fill a sequence alone are
done.  The others are dealt by a hash of a key of their own, so equal pieces
too, into shards of about SHARD pieces, whose size does not grow with the
corpus.  Each shard has ISLANDS populations of SIZE individuals, an individual
being a set of bins.  Populations begin with best fit in random orders.
Crossover injects well-filled bins of one parent whole into the other, removes
the bins that hold duplicates of their pieces, and puts the displaced pieces
back: in place of one or two smaller pieces of a bin where that fills it better,
then by best fit, longest first.  Mutation empties the least filled bins and
some others and puts their pieces back in the same way.  A shard is finished when
an island meets the lower bound; the islands of the others go on for another
epoch, for which each sends its elite to the next one of its shard, where it takes
the places of the worst.  At the end the best individual of a shard gives its
sequences, or best fit decreasing if that has fewer.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import written
from lexiloom.llm.tokens import packed_texts

SHARD, ISLANDS, EPOCHS = 4096, 2, 3
#: Individuals of a population, children of an epoch, guests that an island sends on.
SIZE, CHILDREN, ELITE = 10, 40, 2
#: Bins whose free space is under one in so many of the capacity count as well filled.
FULL = 64
#: Shares of bins that are injected and that mutation empties; chance of a mutation.
INJECT, EMPTIED, MUTATION = 0.5, 0.05, 0.5
#: Bins of more pieces take part in best fit alone.
SWAPPED = 6


class Bins:
    """Bins of piece numbers with best-fit placement by free space; sizes are in descending order."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.rooms: list[int] = []  # in ascending order, those that some bin has

    def open(self, items: list[int], room: int | None = None) -> None:
        if room is None:
            room = self.capacity - sum(map(self.sizes.__getitem__, items))
        if same := self.by_room.get(room):
            same.append(len(self.bins))
        else:
            self.by_room[room] = [len(self.bins)]
            insort(self.rooms, room)
        self.bins.append(items)
        self.room.append(room)

    def fill(self, bins: list[list[int]], room: list[int]) -> None:
        """Take all bins with their free spaces at once; there are none yet."""
        by_room = self.by_room
        for b, r in enumerate(room):
            if r in by_room:
                by_room[r].append(b)
            else:
                by_room[r] = [b]
        self.bins, self.room, self.rooms = bins, room, sorted(by_room)

    def place(self, items: list[int]) -> None:
        """Put each piece in the bin that it leaves least room in, or in a new one."""
        sizes, by_room, room, bins, rooms = self.sizes, self.by_room, self.room, self.bins, self.rooms
        for i in items:
            size = sizes[i]
            at = bisect_left(rooms, size)
            if at == len(rooms):
                self.open([i], self.capacity - size)
                continue
            r = rooms[at]
            same = by_room[r]
            b = same.pop()
            if not same:
                del rooms[at], by_room[r]
            bins[b].append(i)
            room[b] = r = r - size
            if r in by_room:
                by_room[r].append(b)
            else:
                by_room[r] = [b]
                insort(rooms, r)

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then the sum of squared fills."""
        return -len(self.bins), sum((self.capacity - r) ** 2 for r in self.room)


def best_fit(sizes: list[int], order: list[int], capacity: int) -> Bins:
    out = Bins(sizes, capacity)
    out.place(order)
    return out


def lower_bound(sizes: list[int], capacity: int) -> int:
    """No packing has fewer bins.

    Pieces over half a bin stand apart, and for each least size what does not fit
    beside them needs more; of pieces over a (k + 1)th of a bin no bin has more than k.
    """
    if not sizes:
        return 0
    s = np.array(sizes, np.int64)
    total = np.concatenate([[0], np.cumsum(s)])
    after = lambda x: int(np.searchsorted(-s, -x, side="left"))  # noqa: E731  how many pieces are larger than x
    half, best = after(capacity // 2), max(-(-after(capacity // (k + 1)) // k) for k in range(1, 10))
    least = np.concatenate([[0], np.unique(s[s <= capacity // 2])])
    lone, small = np.searchsorted(-s, least - capacity), np.searchsorted(-s, 1 - least)
    rest = total[small] - total[half] - ((half - lone) * capacity - (total[half] - total[lone]))
    return max(best, half + max(0, int((-(-rest // capacity)).max())))


def put_back(made: list[tuple[list[int], int]], displaced: list[int], sizes: list[int], capacity: int) -> Bins:
    """Bins, given with their free space, with the displaced pieces: first in exchange for smaller ones of bins of few pieces, then by best fit."""
    base = len(sizes) + 1
    free = sorted([sizes[i] * base + i for i in displaced])  # by size, then by number
    bins, rooms = [], []
    for items, room in made:
        if room and free and len(items) <= SWAPPED:
            n, most, at, gone = len(items), 0, 0, ()
            own = [sizes[i] for i in items]
            for x in range(n):
                for y in range(x, n):  # one piece if y is x
                    less = own[x] + own[y] if y > x else own[x]
                    k = bisect_left(free, (less + room + 1) * base) - 1
                    if k >= 0 and free[k] // base - less > most:
                        most, at, gone = free[k] // base - less, k, (x, y)
                if most == room:  # full
                    break
            if most:
                new = [i for k, i in enumerate(items) if k not in gone] + [free.pop(at) % base]
                for k in sorted({*gone}):
                    insort(free, own[k] * base + items[k])
                items, room = new, room - most
        bins.append(items[:] if room else items)  # full ones never change
        rooms.append(room)
    out = Bins(sizes, capacity)
    out.fill(bins, rooms)
    out.place([x % base for x in reversed(free)])
    return out


def crossover(one: Bins, two: Bins, rng: random.Random) -> Bins:
    """Inject well-filled bins of `two` into `one`."""
    sizes, capacity = one.sizes, one.capacity
    good = [x for x in zip(two.bins, two.room, strict=True) if x[1] * FULL < capacity]
    made = [x for x in good if rng.random() < INJECT] or [min(zip(two.bins, two.room, strict=True), key=lambda x: x[1])]
    taken, displaced = {i for b, _ in made for i in b}, []
    for b, room in zip(one.bins, one.room, strict=True):
        if taken.isdisjoint(b):
            made.append((b, room))
        else:
            displaced.extend(i for i in b if i not in taken)
    return put_back(made, displaced, sizes, capacity)


def mutated(one: Bins, rng: random.Random) -> Bins:
    """Empty the least filled bins and as many others."""
    n = len(one.bins)
    few = max(1, int(n * EMPTIED / 2))
    out = set(sorted(range(n), key=one.room.__getitem__, reverse=True)[:few]) | set(rng.sample(range(n), few))
    return put_back([(b, one.room[k]) for k, b in enumerate(one.bins) if k not in out], [i for k in out for i in one.bins[k]], one.sizes, one.capacity)


def _numbers(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _from_numbers(numbers: list[int], sizes: list[int], capacity: int) -> Bins:
    out: list[list[int]] = [[] for _ in range(max(numbers, default=-1) + 1)]
    for i, k in enumerate(numbers):
        out[k].append(i)
    made = Bins(sizes, capacity)
    for b in out:
        made.open(b)
    return made


def evolve(sizes: list[int], population: list[Bins], capacity: int, rng: random.Random, least: int, children: int = CHILDREN) -> list[Bins]:
    """One epoch of an island; sizes are in descending order.  The population comes back best first."""
    n, ranked = len(sizes), [(p.fitness(), k, p) for k, p in enumerate(population)]
    while len(ranked) < SIZE:
        order = list(range(n))
        rng.shuffle(order)
        p = best_fit(sizes, order, capacity)
        ranked.append((p.fitness(), len(ranked), p))
    ranked = sorted(ranked, reverse=True)[:SIZE]
    for born in range(children):
        if -ranked[0][0][0] <= least:
            break
        one, two = (min(rng.sample(range(SIZE), 2)) for _ in range(2))  # the better of two, twice
        child = crossover(ranked[one][2], ranked[two][2], rng) if one != two else ranked[one][2]
        if one == two or rng.random() < MUTATION:
            child = mutated(child, rng)
        score = child.fitness()
        if score > ranked[-1][0] and all(score != r[0] for r in ranked):
            ranked[-1] = (score, len(population) + SIZE + born, child)
            ranked.sort(reverse=True)
    return [p for _, _, p in ranked]


def _epoch(capacity: int, epoch: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                sizes = np.asarray(r.sizes).tolist()
                came = [] if r.individuals is None else [_from_numbers(np.asarray(one).tolist(), sizes, capacity) for one in r.individuals]
                rng, least = random.Random(zlib.crc32(f"{r.shard}/{r.island}/{epoch}".encode())), lower_bound(sizes, capacity)
                ranked = evolve(sizes, came, capacity, rng, least)
                few, full = ranked[0].fitness()
                done = -few <= least
                rows.append((r.shard, r.island, few, full, done, [_numbers(p.bins, len(sizes)) for p in (ranked[:1] if done else ranked)]))
            yield pd.DataFrame(rows, columns=["shard", "island", "few", "full", "done", "individuals"])

    return run


def _places(capacity: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bins, offsets = [], []
            for sizes, numbers in zip(frame["sizes"], frame["numbers"], strict=True):
                sizes, numbers = np.asarray(sizes).tolist(), np.asarray(numbers).tolist()
                plain = best_fit(sizes, list(range(len(sizes))), capacity)
                if len(plain.bins) <= max(numbers):
                    numbers = _numbers(plain.bins, len(sizes))
                used, out = [0] * (max(numbers) + 1), []
                for size, k in zip(sizes, numbers, strict=True):
                    out.append(used[k])
                    used[k] += size
                bins.append(numbers)
                offsets.append(out)
            yield frame[["shard"]].assign(numbers=bins, offsets=offsets)

    return run


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces, whose column `length` (1 to capacity) is packed; `key` columns need not be unique."""
    columns = pieces.columns
    pieces = written(pieces.withColumn("piece_key", F.monotonically_increasing_id()), "pieces")  # differs for equal pieces, so that no shard holds them all
    whole = pieces.where(F.col("length") == capacity).select(*columns, (F.lit(-1) - F.col("piece_key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-part.count() // SHARD))
    names = [c for c in columns if c != "length"]
    dealt = part.withColumn("shard", F.pmod(F.xxhash64("piece_key"), F.lit(shards)))
    packed = written(dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "piece_key", *names)), asc=False).alias("items")), "shards")
    sizes = packed.select("shard", F.col("items.length").alias("sizes"))
    many = max(2, min(ISLANDS * shards, spark_width(pieces)))
    islands = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))
    waiting = sizes.withColumn("island", islands).withColumn("individuals", F.lit(None).cast("array<array<int>>"))
    ended = None
    for epoch in range(EPOCHS):
        now = waiting.select("shard", "island", "sizes", "individuals").repartition(many, "shard", "island")
        state = written(now.mapInPandas(_epoch(capacity, epoch), "shard long, island int, few long, full long, done boolean, individuals array<array<int>>"), "islands")
        open_shards = state.groupBy("shard").agg(F.max("done").alias("met")).where("NOT met").select("shard")
        last = epoch + 1 == EPOCHS or open_shards.isEmpty()
        over = state if last else state.join(open_shards, "shard", "left_anti")
        ended = over if ended is None else ended.unionByName(over)
        if last:
            break
        state = state.join(open_shards, "shard")
        own = state.select("shard", "island", F.slice("individuals", 1, SIZE - ELITE).alias("own"))
        guests = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.slice("individuals", 1, ELITE).alias("guests"))
        places = open_shards.withColumn("island", islands)
        none = F.array().cast("array<array<int>>")
        came = places.join(own, ["shard", "island"], "left").join(guests, ["shard", "island"], "left")
        waiting = sizes.join(came.select("shard", "island", F.concat(F.coalesce("guests", none), F.coalesce("own", none)).alias("individuals")), "shard")
    best = ended.groupBy("shard").agg(F.max_by(F.element_at("individuals", 1), F.struct("few", "full", -F.col("island"))).alias("numbers"))
    placed = sizes.join(best, "shard").mapInPandas(_places(capacity), "shard long, numbers array<int>, offsets array<int>")
    out = packed.join(placed, "shard").select("shard", F.explode(F.arrays_zip("items", "numbers", "offsets")).alias("p"))
    sequence = (F.col("shard") * F.lit(1 << 20) + F.col("p.numbers")).cast("long")
    return out.select(*[F.col(f"p.items.{c}").alias(c) for c in columns], sequence.alias("sequence_id"), F.col("p.offsets").cast("long").alias("offset")).unionByName(whole)


def spark_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _cut(path: str, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, packed in packed_texts(batches, path, end):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(packed):
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, (a, b) in enumerate(zip([0, *range(first, n, capacity)], [*range(first, n + 1, capacity)], strict=True)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            kind = lambda x: pa.array(np.array(x, np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row, pa.int64())), *map(kind, (piece, start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pack_documents(docs: DataFrame, path: str, end: int = 0, capacity: int = 2048) -> DataFrame:
    """Pack the ids of all texts, each closed by `end`, into sequences of at most `capacity` ids.

    Only longer documents are cut, into pieces of `capacity` ids of which the
    first may be shorter.  Result, a row for each piece: doc_id, piece (from 0),
    start (its document's ids before it), length, ids_crc32, sequence_id,
    offset (its place there, without gaps from 0).

    Null and empty texts have the end id alone.  Rows with a null or repeated
    doc_id are documents of their own.  An empty table gives no rows; other
    columns are ignored.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pack(src.mapInArrow(_cut(path, end, capacity), "doc_id long, piece long, start long, length long, ids_crc32 long"), capacity)


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
