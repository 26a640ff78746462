"""Model steps: pluggable backends, validated retries, fallback phases, answers that are paid for once.

A backend maps an iterator of pandas frames with key, prompt and attempt to
frames with key, text, error and token counts; errors are rows, never raised.

Every answer is kept in a log under the digest of what was asked: the key, the
prompt, the model and its settings, and the number of the attempt.  A run asks
what the log lacks and nothing else, whatever ran before it: with a limit, other
rows, another prompt or model, or stopped half way.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.operators.batches import FileJobs
from lexiloom.operators.calls import Calls
from lexiloom.sources.readers import exists
from lexiloom.sources.shared import stored

Backend = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
RESULT = "key string, text string, error string, input_tokens long, output_tokens long, reasoning_tokens long, total_tokens long"
COUNTS = ("input_tokens", "output_tokens", "reasoning_tokens", "total_tokens")
#: Bits that tell which hashes of keys there are: 8 MB, whatever their number.
BITS = 1 << 26
#: Bytes of requests in a batch that goes to a backend; a task holds about ten times as many, as strings, answers and results.
BATCH = 1 << 21
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ANSWER = ["request", *[c.split()[0] for c in RESULT.split(", ")], "attempt", "phase", "mode", "model", "failure", "ok"]


@dataclass(frozen=True)
class Phase:
    """So many attempts with one backend, model and settings.

    The backend is an iterator function, `Calls` of single requests, `FileJobs` of
    many, or anything with a method configured(model, settings) that gives one.
    """

    name: str
    mode: str
    model: str
    attempts: int
    backend: Backend | Calls | FileJobs
    settings: dict = field(default_factory=dict)
    #: What an answer does not depend on, such as the number of workers.
    transport: dict = field(default_factory=dict)


def phases(primary: Phase, fallback: Phase | None = None) -> list[Phase]:
    return [primary] + ([fallback] if fallback and fallback.attempts > 0 else [])


def request_id(phase: Phase, attempt: int) -> Column:
    """The digest of a request (key, prompt) in an attempt of a phase."""
    asked = json.dumps([phase.mode, phase.model, phase.settings, attempt], sort_keys=True, default=str)
    return F.unhex(F.sha2(F.concat_ws("\x00", F.col("key"), F.sha2("prompt", 256), F.lit(asked)), 256))


def _attached(backend: Backend):
    """The backend over Arrow batches of requests with all their columns: each result goes back to its own request within the task.

    A batch is held until its requests have results; the first result of a request counts.
    """
    kinds = {"text": pa.string(), "error": pa.string(), **dict.fromkeys(COUNTS, pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, pa.RecordBatch] = {}
        places: dict[int, dict[str, int]] = {}
        batch_of: dict[str, int] = {}

        def frames() -> Iterator[pd.DataFrame]:
            for i, batch in enumerate(batches):
                if batch.num_rows:
                    held[i], places[i] = batch, {str(k): r for r, k in enumerate(batch.column("key").to_pylist())}
                    batch_of.update(dict.fromkeys(places[i], i))
                    yield batch.select(["key", "prompt", "attempt"]).to_pandas()

        def rows(i: int, at: list[int], got: dict[str, pa.Array]) -> pa.RecordBatch:
            part = held[i].take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays([*part.columns, *got.values()], schema=pa.schema([*part.schema, *[pa.field(c, k) for c, k in kinds.items()]]))

        for frame in backend(frames()):
            of: dict[int, tuple[list[int], list[int]]] = {}
            for k, key in enumerate(map(str, frame["key"])):
                i = batch_of.pop(key, None)
                if i is not None:
                    at, mine = of.setdefault(i, ([], []))
                    at.append(places[i].pop(key))
                    mine.append(k)
            for i, (at, mine) in of.items():
                one = frame.iloc[mine]
                yield rows(i, at, {c: pa.Array.from_pandas(one[c], type=k) for c, k in kinds.items()})
                if not places[i]:
                    del held[i], places[i]
        for i, left in places.items():
            yield rows(i, list(left.values()), {c: pa.nulls(len(left), k) for c, k in kinds.items()})

    return run


_bounded: dict[str, list] = {}  # by session: how many ask just now, and its own setting
_lock = threading.Lock()


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands rows to Python in batches of BATCH bytes, so that memory of tasks depends on one request's size at most, not on the number in a batch."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        held = _bounded.setdefault(session, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(BATCH_BYTES, None)
            spark.conf.set(BATCH_BYTES, str(BATCH))
        held[0] += 1
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.unset(BATCH_BYTES) if held[1] is None else spark.conf.set(BATCH_BYTES, held[1])
                del _bounded[session]


def infer(requests: DataFrame, phase: Phase, attempt: int) -> DataFrame:
    """One attempt: requests (key, prompt, ...) with text, error, token counts, attempt, phase, mode and model.

    Single calls come from as many tasks as there are workers, at most the
    parallelism of the cluster; their windows add up to the number of workers.
    """
    backend = phase.backend.configured(phase.model, phase.settings | phase.transport) if hasattr(phase.backend, "configured") else phase.backend
    asked = requests.withColumn("attempt", F.lit(attempt))
    if isinstance(backend, FileJobs):
        out = asked.join(backend.results(asked.select("key", "prompt", "attempt")), "key", "left")
    else:
        if isinstance(backend, Calls):
            tasks = max(1, min(backend.workers, requests.sparkSession.sparkContext.defaultParallelism))
            asked, backend = asked.repartition(tasks, "key"), backend.share(tasks).run
        out = asked.mapInArrow(_attached(backend), T.StructType([*asked.schema.fields, *T._parse_datatype_string(RESULT).fields[1:]]))
    return out.withColumns({"phase": F.lit(phase.name), "mode": F.lit(phase.mode), "model": F.lit(phase.model)})


def _bitmap(keys: DataFrame, place: Column) -> DataFrame:
    """Which places the keys take, as bits in buckets: BITS in all, whatever their number."""
    return keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))


def _marked(rows: DataFrame, maps: DataFrame, place: Column, name: str) -> DataFrame:
    """The rows and whether the bitmap has their place."""
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    found = rows.withColumn("_place", place).join(F.broadcast(maps), F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    return found.withColumn(name, F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("_place", "_bucket", "_bits")


def of_keys(requests: DataFrame, keys: DataFrame) -> DataFrame:
    """The requests with one of the keys.

    A bitmap of hashes of the keys leaves out most others, and a second one of those
    others that the first lets pass tells which of the rest are surely wanted: these
    stay where they are.  Only rows that both have are moved to meet their keys.
    """
    one, two = (F.pmod(F.xxhash64("key", *more), F.lit(BITS)) + 1 for more in ([], [F.lit(1)]))
    wanted = _bitmap(keys, one)
    maybe = lambda rows: _marked(rows, wanted, one, "_maybe").where("_maybe").drop("_maybe")
    others = maybe(requests.select("key")).join(keys.select("key"), "key", "left_anti")
    told = _marked(maybe(requests), _bitmap(others, two), two, "_unsure")
    unsure = told.where("_unsure").select(*requests.columns).join(keys.select("key").distinct(), "key").select(*requests.columns)  # a semi-join would be moved below the bitmap
    return told.where("NOT _unsure").select(*requests.columns).unionByName(unsure)


class Answers:
    """The log of answers in a folder, by attempt; `keep` names columns of requests that go with them.

    Tasks add their files as they end, so what is answered before a run is killed
    stays; rows that a repeated task adds twice count once.
    """

    def __init__(self, path: str, keep: list[str] | None = None):
        self.path, self.keep = path, keep or []

    def read(self, spark: SparkSession, attempt: int, schema: T.StructType) -> DataFrame | None:
        """The answers that are there now.

        Each read has an option of its own: Spark takes reads of one folder for the
        same, whatever files they found, and would give a plan that unites reads from
        before and after an answer the files of one of them twice.
        """
        folder = f"{self.path}/attempt={attempt}"
        return spark.read.schema(schema).option("lexiloom.read", uuid.uuid4().hex).parquet(folder) if exists(spark, folder) else None

    def ask(self, due: DataFrame, phase: Phase, attempt: int, error_of: Callable[[Column], Column]) -> T.StructType:
        """Ask what is due and add the answers, each with what its validation says."""
        got = infer(due, phase, attempt)
        blank = F.coalesce(F.trim("text") == "", F.lit(True))
        failed = F.coalesce(F.col("error"), F.when(F.col("input_tokens").isNull() & F.col("text").isNull(), "no result returned by backend"), F.when(blank, "empty response"), error_of(F.col("text")))
        rows = got.withColumn("failure", failed).withColumn("ok", F.col("failure").isNull()).select(*ANSWER, *self.keep, F.expr("uuid()").alias("answer"))
        with bounded_batches(due.sparkSession):
            rows.write.mode("append").option("compression", "zstd").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{self.path}/attempt={attempt}")
        return rows.schema

    def turn(self, due: DataFrame, phase: Phase, attempt: int, error_of: Callable[[Column], Column]) -> tuple[DataFrame, bool]:
        """One answer for each request that is due, asked now where there is none; and whether all were asked now."""
        spark, request = due.sparkSession, request_id(phase, attempt)
        due = due.withColumn("request", request)
        schema = infer_schema(due, self.keep)
        known = self.read(spark, attempt, schema)
        if known is None:
            self.ask(due, phase, attempt, error_of)
            rows = self.read(spark, attempt, schema)
        else:
            mine = stored(due.select("key", "request"), f"due{attempt}")
            lacking = mine.join(known.select("request"), "request", "left_anti")
            if not lacking.isEmpty():
                self.ask(of_keys(due, lacking.select("key")), phase, attempt, error_of)
            rows = self.read(spark, attempt, schema).join(mine.select("request"), "request", "left_semi")
        several = rows.groupBy("request").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("ok", "answer")).alias("best")).where("n > 1")
        if several.isEmpty():
            return rows.drop("answer"), known is None
        other = several.select("request", F.col("best.answer").alias("chosen"))
        return rows.join(other, "request", "left").where("chosen IS NULL OR chosen = answer").drop("answer", "chosen"), known is None


def infer_schema(due: DataFrame, keep: list[str]) -> T.StructType:
    """The columns of the log."""
    types = {"request": "binary", **dict(x.split() for x in RESULT.split(", ")), "attempt": "int", "phase": "string", "mode": "string", "model": "string", "failure": "string", "ok": "boolean"}
    kept = [T.StructField(c, due.schema[c].dataType) for c in keep]
    return T.StructType([*T._parse_datatype_string(", ".join(f"{c} {types[c]}" for c in ANSWER)).fields, *kept, T.StructField("answer", T.StringType())])


def check_unique(requests: DataFrame) -> None:
    """An error if two requests have one key: their answers could not be told apart."""
    twice = requests.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR key IS NULL").first()
    if twice:
        raise ValueError(f"{twice['n']} requests have the key {twice['key']!r}")


def run_with_retries(requests: DataFrame, plan: list[Phase], error_of: Callable[[Column], Column], log: Answers, prompts: bool = True) -> tuple[DataFrame, DataFrame]:
    """All attempts (the log's columns), and each request with the last of its own.

    `error_of` gives the validation error of a text column, null if it is fine.
    Attempts are numbered on through the phases; what is right is not asked again.
    Requests at the end are without their prompts if these are not wanted: where the
    log keeps all other columns and had no answers, nothing is joined then.
    """
    check_unique(requests)
    turns, pending, fresh = [], requests, True
    for phase in plan:
        for _ in range(phase.attempts):
            rows, asked = log.turn(pending, phase, len(turns) + 1, error_of)
            turns.append(rows)
            fresh = fresh and asked
            left = rows.where("NOT ok")
            if left.isEmpty():
                return _ended(requests if prompts else requests.drop("prompt"), turns, log.keep if fresh else [])
            pending = of_keys(requests, left.select("key"))
    return _ended(requests if prompts else requests.drop("prompt"), turns, log.keep if fresh else [])


def _ended(requests: DataFrame, turns: list[DataFrame], kept: list[str]) -> tuple[DataFrame, DataFrame]:
    both = lambda dfs: reduce(DataFrame.unionByName, dfs)
    last = both([*[t.where("ok") for t in turns[:-1]], turns[-1]])  # what failed before the last turn was asked again
    if set(requests.columns) <= {"key", *kept}:
        return both(turns), last.select(*requests.columns, *[c for c in last.columns if c not in requests.columns])
    return both(turns), requests.join(last.drop(*[c for c in last.columns if c in requests.columns and c != "key"]), "key")


def distinct_prompts(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One request for each distinct prompt, and the map from each key to that request's key.

    Opt in where the model is deterministic: shared prompts are asked once and the
    answers joined back by `asked`.
    """
    first = requests.groupBy("prompt").agg(F.min("key").alias("asked"))
    return first.select(F.col("asked").alias("key"), "prompt"), requests.join(first, "prompt").select("key", "asked")
