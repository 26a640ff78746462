"""Readers, writers, configuration, streaming, and a whole run with the stand-in model."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import echo
from lexiloom import cli
from lexiloom.plans import stages
from lexiloom.sources import config, readers, writers
from lexiloom.streaming import incremental


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "i long, t string")
    writers.write_jsonl(df, str(tmp_path / "x"))
    assert '"t":null' in "".join(p.read_text() for p in (tmp_path / "x").glob("part-*"))
    assert sorted(readers.jsonl(spark, str(tmp_path / "x"), df.schema).collect()) == sorted(df.collect())


def test_bad_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert [(r["line_number"], r["line"]) for r in readers.bad_lines(spark, str(tmp_path / "x.jsonl")).collect()] == [(3, "not json")]
    good, bad = readers.jsonl_permissive(spark, str(tmp_path / "x.jsonl"), T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and [r["line"] for r in bad.collect()] == ["not json"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "hi",\nthere'), ("2", "")], "i string, t string")
    writers.write_csv(df, str(tmp_path / "x"), 1)
    assert sorted(tuple(r) for r in readers.csv_with_quotes(spark, str(tmp_path / "x")).fillna("").collect()) == [("1", 'say "hi",\nthere'), ("2", "")]


def test_split_and_verify(spark, tmp_path):
    df = spark.createDataFrame([(str(i), "ab"[i % 2], "x" if i < 3 else "") for i in range(10)], "i string, lang string, review_reason string")
    index = {r["value"]: (r["rows"], r["queued"]) for r in writers.split_by(df, "lang", str(tmp_path / "s")).collect()}
    assert index == {"a": (5, 2), "b": (5, 1)}
    back = readers.csv_with_quotes(spark, str(tmp_path / "s")).drop("part").fillna("")
    assert writers.verify_split(df, back, "lang", df.columns).isEmpty()
    assert not writers.verify_split(df, back.limit(9), "lang", df.columns).isEmpty()


def raw(tmp_path, **more):
    (tmp_path / "p.md").write_text("{output_schema_json} {field_names} {language} {language_code} {target_script} {q}\nTASK translate {source_json}")
    (tmp_path / "j.md").write_text("{source_json} {target_script} {q} {q_translation} {pass_threshold} {score_scale}\nTASK judge {translation_json}")
    (tmp_path / "c.md").write_text("{audit_json} {error_analysis_json} {judge_score} {judge_verdict} {judge_feedback} {previous_translation_json} {output_schema_json} {c_translation}\nTASK correct {translation_json}")
    (tmp_path / "rows.jsonl").write_text("".join(json.dumps({"id": f"r{i}", "q": f"question {i}", "c": ["a", "b"]}) + "\n" for i in range(6)))
    stage = lambda p: {"prompt": p, "model": "gemini-2.5-flash-001", "inference": {"mode": "parallel"}}
    return {
        "benchmark": "toy", "source": {"type": "local", "files": {"test": "rows.jsonl"}}, "languages": {"Hindi": "hi", "Tamil": "ta"}, "fields": [["q", "c"]],
        "stages": {"translate": stage("p.md"), "judge": stage("j.md") | {"score_scale": 100, "pass_threshold": 60}, "correct": stage("c.md")}, "output": {"root": str(tmp_path / "out")}, **more,
    }


@pytest.mark.parametrize("change", [{"languages": []}, {"fields": None}, {"vertex": {}}, {"review": {"sample_rate": 2}}, {"stage_defaults": {}, "stages": {"translate": {"model": "m", "prompt": "p.md", "inference": {"odd": 1}}}}])
def test_bad_configuration(tmp_path, change):
    with pytest.raises(config.ConfigError):
        config.parse(raw(tmp_path) | change, tmp_path)


def test_run(spark, tmp_path):
    c = config.parse(raw(tmp_path), tmp_path)
    run = stages.Run(spark, c, {m: echo.backend for m in config.MODES})
    text, unfilled = stages.preview(run, c.units[0])
    assert "question 0" in text and unfilled == []
    last = stages.chain(run)
    translated = spark.read.parquet(f"{run.path('translate')}/records")
    assert translated.count() == 12 and translated.where("valid").count() == 12
    assert {json.loads(r["translation"])["q"] for r in translated.select("translation").collect()} == {f"[t] question {i}" for i in range(6)}
    failed = spark.read.parquet(f"{run.path('judge', 1)}/records").where("NOT passed").count()
    assert last.count() == failed == spark.read.parquet(f"{run.path('correct', 1)}/records").count()
    wide, lost = stages.assemble(run, c.units[0])
    assert wide.count() == 6 and lost.isEmpty() and {"q_Hindi", "c_Tamil"} <= set(wide.columns)
    rows = stages.review_run(run)
    assert rows.count() == 12 and rows.where("was_corrected").count() == failed
    levels = {(r["level"], r["key"]): r["requests"] for r in stages.costs(run).collect()}
    assert levels["stage", "judge_r1"] == 12 and levels["run", "run"] == sum(n for (level, _), n in levels.items() if level == "stage")
    for name in config.STAGES:
        shown, unfilled = stages.preview(run, c.units[0], name)
        assert unfilled == [] and "question 0" in shown
    record = spark.read.parquet(f"{run.path('judge', 1)}/records").first()
    assert {"prompt_path", "prompt_sha256", "timestamp", "judge_parsed", "pass_threshold", "score_scale", "request_key"} <= set(record.asDict()) and json.loads(record["judge_parsed"])["score"] == record["score"]
    summary = stages.write_review(run)
    assert summary["units"][0]["instances"] == 12 and summary["correction_rounds_seen"] == [1] and json.loads((tmp_path / "out/toy/review/summary.json").read_text())["units"] == json.loads(json.dumps(summary["units"], default=str))
    sheet = readers.csv_with_quotes(spark, f"{run.root}/review/queue_csv/{c.units[0].label}")
    assert sheet.count() == summary["units"][0]["queued"] and {"source_q", "translation_c", "human_verdict"} <= set(sheet.columns)
    seen = {r["record_id"]: r for r in rows.collect()}
    assert all(len(r["judge_views"]) == 1 + r["was_corrected"] and r["translate_view"]["prompt_path"].endswith("p.md") and r["judge_views"][0]["parsed"] for r in seen.values())
    assert {r["attempt"]: (r["ok"], r["failed"]) for r in stages.attempt_totals(run).where("stage = 'translate'").collect()}[1][0] <= 12
    free = stages.costs(run, "force").where("level = 'run'").first()["cost_usd"]
    assert free == pytest.approx(stages.costs(run, "off").where("level = 'run'").first()["cost_usd"], rel=1e-6)
    plan = stages.recorrect(run, 101.0, dry=True)
    assert plan["correct_round"] == 2 and plan["judge_round"] == 3 and plan["selected"] == 12 - failed and plan["skipped"] == ({"already_corrected": failed} if failed else {})


def test_streaming(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    source = str(tmp_path / "in")
    for part in (0, 1):
        spark.createDataFrame([(str(i), i) for i in range(part * 5, part * 5 + 5)], schema).write.mode("append").parquet(source)
        stream = incremental.arriving(spark, source, schema)
        incremental.run_available(stream, lambda df: df.withColumn("m", F.col("n") * 2), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("m")).first()[0] == sum(2 * i for i in range(part * 5 + 5))


def test_rounds_beyond_a_hundred(spark, tmp_path):
    run = stages.Run(spark, config.parse(raw(tmp_path), tmp_path), {})
    for name in ("translate", "correct_r120", "judge_r121", "other"):
        spark.createDataFrame([("x", name)], "record_id string, stage string").write.parquet(f"{run.root}/{name}/records")
    assert [x[2] for x in stages.stage_folders(run, "records")] == ["translate", "correct_r120", "judge_r121"]
    assert stages.records_of(run).count() == 3


def test_command_line(spark, tmp_path, capsys):
    import yaml

    (tmp_path / "c.yaml").write_text(yaml.safe_dump(raw(tmp_path)))
    given = ["--config", str(tmp_path / "c.yaml")]
    with pytest.raises(SystemExit):
        cli.main(["run", *given])  # a model is needed
    assert cli.main(["run", *given, "--backend", "echo:backend"]) == 0
    assert cli.main(["review", *given, "--queue-only"]) == 0 and cli.main(["costs", *given, "--reprice"]) == 0
    out = capsys.readouterr().out
    assert "judge_r2" in out and '"units"' in out and (tmp_path / "out/toy/final/default/test/_SUCCESS").exists()
    assert cli.main(["preview", *given, "--stage", "correct"]) == 0 and "unfilled: []" in capsys.readouterr().out
