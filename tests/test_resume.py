"""Second runs: nothing is lost, nothing is asked twice, provenance is true."""

import json
from pathlib import Path

import echo
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_sources import raw

from lexiloom import cli
from lexiloom.operators import inference
from lexiloom.operators.calls import Calls
from lexiloom.plans import stages
from lexiloom.sources import config, versions


def setup(spark, tmp_path, **more):
    for split in ("test", "val"):
        (tmp_path / f"{split}.jsonl").write_text("".join(json.dumps({"id": f"{split}{i}", "q": f"question {i}", "c": ["a"]}) + "\n" for i in range(6)))
    given = raw(tmp_path, **more) | {"source": {"type": "local", "files": {"test": "test.jsonl", "val": "val.jsonl"}}}
    return stages.Run(spark, config.parse(given, tmp_path), {m: echo.backend for m in config.MODES})


def asked(run, stage):
    """How many answers the log of a stage holds."""
    logs = {str(p.parent) for p in Path(f"{run.root}/{stage}").rglob("attempt=*")}
    return sum(run.spark.read.option("recursiveFileLookup", True).parquet(p).count() for p in logs)


def test_limit_then_all_then_a_new_prompt_then_new_rows(spark, tmp_path):
    run = setup(spark, tmp_path, languages={"Hindi": "hi"})
    run.only = [("default", "test")]
    assert stages.translate(run, limit=2).count() == 2
    first = asked(run, "translate")
    assert stages.translate(run).count() == 6
    second = asked(run, "translate")
    assert second > first and stages.translate(run).count() == 6 and asked(run, "translate") == second
    assert stages.translate(run, limit=2).count() == 6  # a part leaves the others

    old = {r["prompt_sha256"] for r in run.table("translate").collect()}
    prompt = tmp_path / "p.md"
    prompt.write_text("Now: " + prompt.read_text())
    records = stages.translate(run).collect()
    new = {r["prompt_sha256"] for r in records}
    assert len(records) == 6 and len(new) == 1 and not new & old and asked(run, "translate") >= second + 6

    before = asked(run, "translate")
    with open(tmp_path / "test.jsonl", "a") as f:
        f.write(json.dumps({"id": "more", "q": "one more", "c": ["z"]}) + "\n")
    assert stages.translate(run).count() == 7 and asked(run, "translate") - before <= 2


def test_one_unit_after_the_other(spark, tmp_path):
    run = setup(spark, tmp_path)
    run.only = [("default", "test")]
    assert stages.translate(run).count() == 12
    run.only = [("default", "val")]
    assert stages.translate(run).count() == 24
    judged = stages.judge(run, run.table("translate"))
    assert {r["split"] for r in judged.select("split").distinct().collect()} == {"val"}  # judge keeps to the units as well
    run.only = None
    both = stages.judge(run, run.table("translate"))
    assert both.count() == 24 and asked(run, "judge_r1") == 24
    some = both.where("record_id LIKE '%val0%'")
    assert stages.judge(run, run.table("translate").where("record_id LIKE '%val0%'"), part=True).count() == 24 and some.count() == 2
    usage = versions.read(spark, f"{run.path('judge', 1)}/usage")
    assert usage.count() == 24


def test_killed_run_keeps_what_it_was_told(spark, tmp_path):
    """Tasks that ended before a run was killed have paid for their answers; the next run asks the rest."""
    requests = spark.range(0, 40, 1, 4).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("p"), "id").alias("prompt"))

    def dies(frames):
        import time

        for f in frames:
            if "k39" in set(f["key"]):
                time.sleep(3)
                raise RuntimeError("killed")
            yield from echo_text(iter([f]))

    def echo_text(frames):
        for f in frames:
            yield f[["key"]].assign(text=f["prompt"], error=None, input_tokens=1, output_tokens=1, reasoning_tokens=0, total_tokens=2)

    log, none = inference.Answers(str(tmp_path / "log")), lambda t: F.lit(None).cast("string")
    plan = lambda b: [inference.Phase("primary", "parallel", "m", 1, b)]
    with pytest.raises(PySparkException):
        inference.run_with_retries(requests, plan(dies), none, log)
    kept = log.read(spark, 1, inference.infer_schema(requests, []))
    n = kept.count() if kept is not None else 0
    _, final = inference.run_with_retries(requests, plan(echo_text), none, log)
    assert sorted(r["key"] for r in final.collect()) == sorted(f"k{i}" for i in range(40))
    assert log.read(spark, 1, inference.infer_schema(requests, [])).count() == 40 and 0 <= n < 40
    inference.run_with_retries(requests, plan(dies), none, log)  # all is there: the model is not called


def test_answers_written_twice_count_once(spark, tmp_path):
    requests = spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit("p").alias("prompt"))
    log, none = inference.Answers(str(tmp_path / "log")), lambda t: F.lit(None).cast("string")
    plan = [inference.Phase("primary", "parallel", "m", 1, Calls(lambda prompt, settings: {"text": "x"}))]
    inference.run_with_retries(requests, plan, none, log)
    again = spark.createDataFrame(spark.read.parquet(f"{log.path}/attempt=1").collect(), inference.infer_schema(requests, []))
    again.withColumn("answer", F.expr("uuid()")).write.mode("append").parquet(f"{log.path}/attempt=1")
    attempts, final = inference.run_with_retries(requests, plan, none, log)
    assert attempts.count() == final.count() == 5


def test_runs_over_one_log_in_one_plan(spark, tmp_path):
    """Answers of two runs are united: each has the answers that the log held when it ran, also where joins shuffle."""
    log, none = inference.Answers(str(tmp_path / "log"), ["part"]), lambda t: F.lit(None).cast("string")
    plan = [inference.Phase("primary", "parallel", "m", 1, Calls(lambda prompt, settings: {"text": prompt}))]
    rows = lambda word: spark.range(9).select(F.col("id").cast("string").alias("key"), (F.col("id") % 3).alias("part"), F.when(F.col("id") % 3 == 0, word).otherwise("same").alias("prompt"))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inference.run_with_retries(rows("first").where("part = 1"), plan, none, log)  # so that both runs below find a log
        both = [inference.run_with_retries(rows(w), plan, none, log)[1].groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("text")).withColumn("run", F.lit(w)) for w in ("first", "then")]
        got = {(r["run"], r["part"], r["n"], r["text"]) for r in both[0].unionByName(both[1]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert got == {(w, p, 3, w if p == 0 else "same") for w in ("first", "then") for p in range(3)}


def test_requests_meet_answers_within_tasks(spark, tmp_path):
    """A first run moves no request but those that failed, and these past a bitmap; each answer is its own request's, in any order, or none."""
    requests = spark.range(0, 60, 1, 3).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("p"), "id").alias("prompt"), F.struct("id", F.array("id").alias("a")).alias("more"))

    def backwards(frames):
        for f in frames:
            f = f[(f["attempt"] > 1) | (f["key"].str[-1] != "3")].iloc[::-1]  # no result for some
            yield f[["key"]].assign(text=f["prompt"].where((f["attempt"] > 1) | (f["key"].str[-1] != "5"), ""), error=None, input_tokens=1, output_tokens=1, reasoning_tokens=0, total_tokens=2)

    phase = inference.Phase("primary", "batch", "m", 2, backwards)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(inference.infer(requests, phase, 1))
    log = inference.Answers(str(tmp_path / "log"), ["more"])
    attempts, final = inference.run_with_retries(requests, [phase], lambda t: F.when(F.col("more.id") < 0, "never"), log, prompts=False)
    assert "Join" not in plan(final) and attempts.count() == 72
    assert {(r["key"], r["text"], r["more"]["a"][0], r["attempt"]) for r in final.collect()} == {(f"k{i}", f"p{i}", i, 2 if i % 10 in (3, 5) else 1) for i in range(60)}
    some = inference.of_keys(requests, requests.where("more.id % 7 = 0").select("key"))
    assert sorted(r["more"]["id"] for r in some.collect()) == list(range(0, 60, 7)) and "bitmap" in plan(some)


def test_batches_of_requests_are_bounded_by_bytes(spark, tmp_path):
    """However many requests a partition has, a backend gets few bytes of them at once; the session's setting is as before, also after an error."""
    requests = spark.range(0, 600, 1, 1).select(F.concat(F.lit("k"), "id").alias("key"), F.repeat(F.lit("x"), 20_000).alias("prompt"))

    def sizes(frames):
        for f in frames:
            n = int(f["prompt"].str.len().sum())
            yield f[["key"]].assign(text=f["prompt"], error=None, input_tokens=n, output_tokens=1, reasoning_tokens=0, total_tokens=n)

    def dies(frames):
        raise RuntimeError("down")
        yield from frames

    none, plan = lambda t: F.lit(None).cast("string"), lambda b: [inference.Phase("primary", "batch", "m", 1, b)]
    before = spark.conf.get(inference.BATCH_BYTES, None)
    _, final = inference.run_with_retries(requests, plan(sizes), none, inference.Answers(str(tmp_path / "log")))
    got = final.agg(F.count(F.lit(1)), F.sum(F.length("text")), F.max("input_tokens")).first()
    assert tuple(got[:2]) == (600, 12_000_000) and 20_000 <= got[2] <= 2 * inference.BATCH
    with pytest.raises(PySparkException):
        inference.run_with_retries(requests, plan(dies), none, inference.Answers(str(tmp_path / "other")))
    assert spark.conf.get(inference.BATCH_BYTES, None) == before


def test_wanted_requests_stay_in_place(spark, monkeypatch):
    """Where joins shuffle, only requests move that both bitmaps have; the rows are the wanted ones, also where bitmaps are full."""
    requests = spark.range(0, 3000, 1, 3).select("id", F.concat(F.lit("k"), "id").alias("key"), F.spark_partition_id().alias("part"))
    keys = requests.where("id % 7 = 0").select("key")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = inference.of_keys(requests, keys).withColumn("at", F.spark_partition_id()).collect()
        assert sorted(r["id"] for r in got) == list(range(0, 3000, 7)) and sum(r["at"] == r["part"] for r in got) > 0.98 * len(got)
        for bits in (1, 900):
            monkeypatch.setattr(inference, "BITS", bits)
            assert sorted(r["id"] for r in inference.of_keys(requests, keys).collect()) == list(range(0, 3000, 7))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_repeated_keys_are_an_error(spark, tmp_path):
    requests = spark.createDataFrame([("a", "p"), ("a", "q")], "key string, prompt string")
    plan = [inference.Phase("primary", "parallel", "m", 1, echo.backend)]
    with pytest.raises(ValueError, match="2 requests have the key 'a'"):
        inference.run_with_retries(requests, plan, lambda t: F.lit(None).cast("string"), inference.Answers(str(tmp_path / "log")))


def test_settings_reach_the_model(spark, tmp_path):
    def call(prompt, settings):
        import json

        import echo

        if settings["temperature"] != 0.9 or settings["extra_params"] != {"top_k": 3} or settings["num_workers"] != 3:
            raise ValueError(str(settings))
        kind, body = prompt.rpartition("TASK ")[2].split(" ", 1)
        return {"text": json.dumps(echo._marked(json.loads(body)))}

    run = setup(spark, tmp_path, languages={"Hindi": "hi"}, stage_defaults={})
    run.only = [("default", "val")]
    run.backends = {m: Calls(call, pause=0.001) for m in config.MODES}
    stage = run.config.stage("translate")
    stage.inference.temperature, stage.inference.extra_params, stage.inference.num_workers = 0.9, {"top_k": 3}, 3
    assert stages.translate(run).where("valid").count() == 6
    n = asked(run, "translate")
    stage.inference.num_retries = 1  # how it is sent changes no answer
    stages.translate(run)
    assert asked(run, "translate") == n
    stage.inference.temperature = 0.1  # what is asked does; the model refuses
    assert stages.translate(run).where("valid").count() == 0 and asked(run, "translate") > n
    assert run.table("translate", part="failures").count() == 6


def test_flags(spark, tmp_path):
    import yaml

    setup(spark, tmp_path)
    given = raw(tmp_path, languages={"Hindi": "hi"}) | {"source": {"type": "local", "files": {"test": "test.jsonl", "val": "val.jsonl"}}}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(given))
    flags = ["--config", str(tmp_path / "c.yaml"), "--backend", "echo:backend"]
    splits = lambda stage: {r["split"] for r in versions.read(spark, f"{tmp_path}/out/toy/{stage}/records").collect()}
    for split in ("test", "val"):
        assert cli.main(["translate", *flags, "--split", split]) == 0
    assert splits("translate") == {"test", "val"}
    assert cli.main(["judge", *flags, "--split", "val"]) == 0 and splits("judge_r1") == {"val"}
    assert cli.main(["correct", *flags, "--split", "val"]) == 0 and (tmp_path / "out/toy/correct_r1/records/_versions").exists()
    assert cli.main(["judge", *flags, "--split", "test"]) == 0 and splits("judge_r1") == {"test", "val"}
    assert cli.main(["recorrect", *flags, "--split", "test", "--threshold", "101"]) == 0
    assert "test" in splits("correct_r1") and splits("judge_r2") == {"test"}  # the next rounds of that unit
