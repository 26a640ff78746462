"""Batch inference by files: request lines in chunks, one job for each, prediction lines matched back.

A provider's job reads a folder of lines and writes a folder of lines, in any
order, with the request repeated in each.  So answers find their requests by the
prompt, the n-th line of a prompt its n-th request.  A job that fails leaves its
requests without a result, and they are asked again by the next attempt.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.hashing import prompt_hash
from lexiloom.operators import routing
from lexiloom.operators.identity import row_index
from lexiloom.operators.preparation import chunk_of
from lexiloom.sources.readers import exists, folders
from lexiloom.sources.shared import new_path, stored
from lexiloom.sources.writers import write_chunks


@dataclass(frozen=True)
class FileJobs:
    """A backend of batch jobs: submit(model, input folder, output folder, settings) returns when the job has ended.

    At most `size` requests go into a job, and `at_once` calls of submit run at a
    time.  What submit raises is the error of the job's requests.

    With `wave` a call hands over so many jobs: submit(model, input folder, output
    folder, names, settings) has the jobs' folders by these names in the input
    folder, writes those of the answers under the same names in the output folder,
    and returns the errors of the jobs that failed by name.
    """

    submit: Callable[..., dict[str, str] | None]
    size: int = 50_000
    at_once: int = 8
    model: str = ""
    settings: dict = field(default_factory=dict)
    wave: int | None = None

    def configured(self, model: str, settings: dict) -> FileJobs:
        """The same jobs under a stage's settings."""
        return replace(self, model=model, settings=settings, size=settings.get("max_requests_per_batch") or self.size)

    def _call(self, folder: str, number: int, names: list[str]) -> dict[str, str]:
        """Hand over the jobs of these names; the errors of those that failed."""
        source, target = f"{folder}/input", f"{folder}/output/call={number}"
        try:
            if self.wave:
                return self.submit(self.model, source, target, names, self.settings) or {}
            self.submit(self.model, f"{source}/{names[0]}", f"{target}/{names[0]}", self.settings)
        except Exception as e:  # noqa: BLE001  one failed call must not lose the others
            return dict.fromkeys(names, f"batch error: {type(e).__name__}: {e}"[:500])
        return {}

    def results(self, requests: DataFrame) -> DataFrame:
        """key, text, error and token counts of requests (key, prompt); requests without a line are left out."""
        spark, folder = requests.sparkSession, new_path(requests.sparkSession, "batch")
        placed = row_index(requests.select("key", "prompt", prompt_hash(F.col("prompt")).alias("_h")), [], name="ordinal")
        given = {k: self.settings[k] for k in ("temperature", "max_output_tokens", "json_mode", "thinking_budget") if k in self.settings}
        write_chunks(placed.select("ordinal", routing.encode_request(F.col("prompt"), **given).alias("line")), f"{folder}/input", self.size, near=True)
        chunks = sorted((c for c in folders(spark, f"{folder}/input") if c.startswith("chunk=")), key=_number)
        calls = [chunks[i : i + (self.wave or 1)] for i in range(0, len(chunks), self.wave or 1)]
        with ThreadPoolExecutor(max(1, self.at_once)) as pool:
            failed = {c: e for found in pool.map(lambda call: self._call(folder, *call), enumerate(calls)) for c, e in found.items()}
        errors = spark.createDataFrame([(_number(c), e) for c, e in failed.items()], "chunk long, error string")  # a row for each failed job
        asked = placed.select("key", "ordinal", "_h", chunk_of(F.col("ordinal"), self.size).alias("chunk"))
        counts = [F.lit(0).cast("long").alias(t) for t in ("input_tokens", "output_tokens", "reasoning_tokens", "total_tokens")]
        lost = asked.join(F.broadcast(errors), "chunk").select("key", F.lit(None).cast("string").alias("text"), "error", *counts)
        done = []
        for number, names in enumerate(calls):
            target = f"{folder}/output/call={number}"
            done += [f"{target}/{c}" for c in names if c not in failed] if failed.keys() & set(names) else [target]
        done = [d for d in done if exists(spark, d)]
        if not done:
            return lost
        read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(done).where(F.trim("value") != "")
        position = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
        lines = read.select(prompt_hash(routing.echoed_prompt(F.col("value"))).alias("_h"), position.alias("position"), "value", routing.response_object(F.col("value")).alias("response"))
        decoded = lines.where("_h IS NOT NULL").select("_h", "position", routing.decode_line(F.col("value"), F.col("response")).alias("r"))
        answers = stored(decoded.select("_h", "position", "r.text", "r.error", "r.usage.*"), "batch_answers")  # lines are parsed once, and go on without their requests
        mine = asked.join(F.broadcast(errors), "chunk", "left_anti") if failed else asked
        matched, _ = routing.match_by_hash(mine, answers)
        return matched.select("key", "text", "error", *[t for t in answers.columns if t.endswith("_tokens")]).unionByName(lost)


def _number(chunk: str) -> int:
    return int(chunk.partition("=")[2])
