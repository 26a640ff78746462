"""Readers, snapshots, batch jobs and streams that other tests do not reach."""

import json

import pytest
from pyspark.sql import functions as F
from test_resume import setup

from lexiloom.operators import identity, inference, routing
from lexiloom.operators.batches import FileJobs
from lexiloom.plans import stages
from lexiloom.sources import readers, versions, writers
from lexiloom.streaming import incremental


def test_records_of_all_folders(spark, tmp_path):
    for folder, n in (("translate", 2), ("judge_r1", 1), ("judge_r120", 3)):
        (tmp_path / folder / "default").mkdir(parents=True)
        (tmp_path / folder / "default" / "records.jsonl").write_text("".join(json.dumps({"id": f"{folder}{i}"}) + "\n" for i in range(n)))
        (tmp_path / folder / "other.jsonl").write_text("{}\n")
    got = readers.collect_records(spark, str(tmp_path))
    assert sorted((r["stage_dir"], r["round_dir"]) for r in got.collect()) == [("judge", 1), *[("judge", 120)] * 3, *[("translate", 0)] * 2]
    assert readers.collect_records(spark, str(tmp_path), "none.jsonl", "id string", required=False).isEmpty()
    with pytest.raises(FileNotFoundError):
        readers.collect_records(spark, str(tmp_path), "none.jsonl", "id string")


def test_documents_columns_and_heads(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"a": 1, "b": {"c": [1, 2]}}, {"a": 2, "b": None}], indent=2))
    assert sorted(r["a"] for r in readers.json_document(spark, str(tmp_path / "one.json")).collect()) == [1, 2]
    spark.range(5).select("id", F.lit("x").alias("big x"), F.lit("y").alias("y")).write.parquet(str(tmp_path / "p"))
    some = readers.parquet_columns(spark, str(tmp_path / "p"), ["id", "big x"])
    assert some.columns == ["id", "big x"] and "ReadSchema: struct<id:bigint,big x:string>" in some._jdf.queryExecution().toString()
    assert [r["id"] for r in readers.head(some, ["id"], 2).collect()] == [0, 1] and readers.head(some, ["id"], 0).count() == 5
    units = identity.with_unit(spark.createDataFrame([(None, None), ("c", "s")], "dataset_config string, split string"))
    assert {tuple(r) for r in units.collect()} == {("default", "train"), ("c", "s")}


def test_names_of_sheets():
    assert writers.sheet_prefix("data/mmlu/review/default/test.queue.csv") == "mmlu_test.queue"
    assert writers.sheet_prefix("data/mmlu/review/other set/test.csv") == "mmlu_other_set_test"
    assert writers.sheet_prefix("folder/test.csv") == "folder_test" and writers.sheet_prefix("test.csv") == "test"


def test_rows_are_kept_as_translated(spark, tmp_path):
    run = setup(spark, tmp_path, languages={"Hindi": "hi"})
    run.only = [("default", "test")]
    stages.translate(run)
    (tmp_path / "test.jsonl").write_text(json.dumps({"id": "test0", "q": "another question", "c": ["b"]}) + "\n")
    wide, _ = stages.assemble(run, run.config.units[0])
    assert sorted(r["q"] for r in wide.collect()) == [f"question {i}" for i in range(6)]
    stages.translate(run)
    assert [r["q"] for r in stages.assemble(run, run.config.units[0])[0].collect()] == ["another question"]


def test_jobs_that_fail_are_asked_again(spark, tmp_path):
    """The second job of three fails at first; a line is lost in another; both come back by the next attempt."""
    calls = []

    def job(model, source, target, settings):
        calls.append((model, source.rpartition("/")[2], settings["temperature"]))
        lines = spark.read.text(source)
        if len(calls) < 4 and source.endswith("chunk=1"):
            raise RuntimeError("quota")
        if len(calls) < 4 and source.endswith("chunk=0"):
            lines = lines.orderBy("value").limit(3)
        answered = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.lit(', "response": {"candidates": [{"content": {"parts": [{"text": "fine"}]}}]}}'))
        lines.select(answered).repartition(3).write.text(target)

    requests = spark.range(10).select(F.format_string("k%02d", "id").alias("key"), F.concat(F.lit("p"), F.col("id") % 4).alias("prompt"))  # prompts repeat
    plan = [inference.Phase("primary", "batch", "m", 2, FileJobs(job, at_once=1), {"temperature": 0.5}, {"max_requests_per_batch": 4})]
    attempts, final = inference.run_with_retries(requests, plan, lambda t: F.lit(None).cast("string"), inference.Answers(str(tmp_path / "log")))
    assert final.where("ok").count() == 10 and sorted(c for _, c, _ in calls) == ["chunk=0", "chunk=0", "chunk=1", "chunk=1", "chunk=2"] and {(m, t) for m, _, t in calls} == {("m", 0.5)}
    failed = {r["failure"] for r in attempts.where("NOT ok").collect()}
    assert failed == {"batch error: RuntimeError: quota", "no result returned by backend"} and attempts.where("attempt = 2").count() == 5


def test_jobs_are_handed_over_in_waves(spark):
    """Five jobs of two requests go out in three calls; one that fails loses its own requests only, also where prompts repeat."""
    calls = []

    def jobs(model, source, target, names, settings):
        calls.append(sorted(names))
        lines = spark.read.option("basePath", source).text([f"{source}/{n}" for n in names])
        assert lines.groupBy("chunk").count().where("count > 2").isEmpty()
        answered = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.lit(', "response": {"candidates": [{"content": {"parts": [{"text": "fine"}]}}]}}'))
        lines.where("chunk <> 1").select("chunk", answered).write.partitionBy("chunk").text(target)
        return {n: "quota" for n in names if n == "chunk=1"}

    requests = spark.range(10).coalesce(1).select(F.format_string("k%02d", "id").alias("key"), F.concat(F.lit("p"), F.col("id") % 2).alias("prompt"))
    got = {r["key"]: (r["text"], r["error"]) for r in FileJobs(jobs, size=2, wave=2, at_once=1).results(requests).collect()}
    assert calls == [["chunk=0", "chunk=1"], ["chunk=2", "chunk=3"], ["chunk=4"]]
    assert got == {f"k{i:02d}": (None, "quota") if i in (2, 3) else ("fine", None) for i in range(10)}

    def job(model, source, target, settings):
        if source.endswith("chunk=1"):
            raise RuntimeError("quota")
        jobs(model, source.rpartition("/")[0], target.rpartition("/")[0], [source.rpartition("/")[2]], settings)

    keys = [r["key"] for r in FileJobs(job, size=2, at_once=1).results(requests).collect()]
    assert sorted(keys) == [f"k{i:02d}" for i in range(10)]  # no request has both an error and the line of another


def test_response_is_read_on_its_own(spark):
    """Values that are read from the response alone are those read from the line, whatever the response is."""
    odd = ['{"response": {"candidates": [{"content": {"parts": [{"text": "a\\u00e9\\n"}]}, "finishReason": "STOP"}], "usageMetadata": {"promptTokenCount": 3}}}', '{"response": "{\\"candidates\\": []}"}', '{"response": "x", "request": {"response": {"a": 1}}}']
    odd += ['{"response": {}}', '{"response": null}', '{"response": []}', "{}", "", "no json", '{"response": {"candidates": [', '{"error": {"code": 7}, "response": {"candidates": []}}', '{"response":{"usage_metadata":{"candidates_token_count":"5"}},"status":"x"}']
    lines = spark.createDataFrame([(x,) for x in odd], "value string").withColumn("response", routing.response_object(F.col("value")))
    both = lines.select(routing.decode_line(F.col("value")).alias("a"), routing.decode_line(F.col("value"), F.col("response")).alias("b"), "response").collect()
    assert all(r["a"] == r["b"] for r in both) and [i for i, r in enumerate(both) if r["response"]] == [0, 3, 10, 11]


def test_old_versions_of_stages_go(spark, tmp_path):
    run = setup(spark, tmp_path, languages={"Hindi": "hi"})
    run.only = [("default", "val")]
    for _ in range(3):
        stages.translate(run)
    table = f"{run.path('translate')}/records"
    assert len(versions.numbers(spark, table)) == 3 and versions.expire(spark, table, keep=1) == 2 and run.table("translate").count() == 6


def test_streams_with_watermarks(spark, tmp_path):
    schema = "k string, at timestamp, n long"
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", "2024-01-01 00:01:00", 1), ("a", "2024-01-01 00:02:00", 2), ("b", "2024-01-01 00:12:00", 4), ("c", "2024-01-01 05:00:00", 8)], "k string, at string, n long").select("k", F.col("at").cast("timestamp").alias("at"), "n").write.parquet(source)
    for name, stream in (("first", lambda s: incremental.first_of_each(s, "k", "at")), ("windows", lambda s: incremental.usage_windows(s, "at", ["k"], "n"))):
        read = spark.readStream.schema(schema).parquet(source)
        query = stream(read).writeStream.format("memory").queryName(f"made_{name}").outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r["k"] for r in spark.table("made_first").collect()) == ["a", "b", "c"]
    assert sorted((r["k"], r["n"], r["total"]) for r in spark.table("made_windows").collect()) == [("a", 2, 3), ("b", 1, 4)]
