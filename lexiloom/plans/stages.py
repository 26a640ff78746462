"""The stages of a benchmark run, each reading tables and writing tables.

A stage adds its answers to a log, attempt by attempt, and commits its records,
failures and usage at the end, unit by unit, under <root>/<benchmark>/<stage>[_rN].
A second run asks only what the log lacks, and replaces only the units it was
about; one over a part of a unit replaces the records of that part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions import judgement, parse, template, validate
from lexiloom.functions.text import let
from lexiloom.operators import assembly, cost, fanout, identity, inference, review, selection
from lexiloom.sources import readers, versions, writers
from lexiloom.sources.config import Config, Inference, Stage, Unit

STAGE = re.compile(r"(translate|judge|correct)(?:_r(\d+))?")
ORDER = {"translate": 0, "correct": 1, "judge": 2}
IDENTITY = ["record_id", "benchmark", "dataset_config", "split", "row_id", "row_index", "language", "language_code", "group_index", "fields"]


@dataclass
class Run:
    """A configured benchmark and the model behind each mode."""

    spark: SparkSession
    config: Config
    backends: dict[str, inference.Backend]
    load: Callable[[Unit], DataFrame] | None = None
    #: The units that a run is about; None means all.
    only: list[versions.UnitKey] | None = None

    @property
    def root(self) -> str:
        return f"{self.config.output.root}/{self.config.benchmark}"

    def path(self, stage: str, round_: int = 0) -> str:
        return f"{self.root}/{stage}{f'_r{round_}' if round_ else ''}"


    def table(self, stage: str, round_: int = 0, part: str = "records") -> DataFrame:
        """The committed records, failures or usage of a stage."""
        return versions.read(self.spark, f"{self.path(stage, round_)}/{part}")

    def chosen(self, df: DataFrame) -> DataFrame:
        """The rows of the units that the run is about."""
        return df if self.only is None else df.where(versions.in_units(self.only))


#: Settings of a stage that an answer depends on, and those that it does not.
ASKED = ("temperature", "max_output_tokens", "json_mode", "thinking_budget", "api_base", "extra_params")
TRANSPORT = ("num_workers", "num_retries", "request_timeout", "max_requests_per_batch", "api_key_env", "poll_interval_seconds", "poll_timeout_hours", "delete_uploaded_files")
#: Columns of requests that go into the log first, for the usage of units and languages; the others but the prompt follow.
LOGGED = ["dataset_config", "split", "language"]


def _phases(run: Run, stage: Stage) -> list[inference.Phase]:
    def one(name: str, i: Inference, model: str, n: int) -> inference.Phase:
        asked = {k: getattr(i, k) for k in ASKED} | {"provider_model": i.provider_model(model)}
        return inference.Phase(name, i.mode, model, n, run.backends[i.mode], asked, {k: getattr(i, k) for k in TRANSPORT})

    back = stage.fallback
    later = one("fallback", back.inference, back.model or stage.model, back.max_attempts) if back.enabled else None
    return inference.phases(one("primary", stage.inference, stage.model, stage.max_attempts), later)


def _answered(run: Run, stage: Stage, requests: DataFrame, error_of: Callable[[Column], Column], where: str) -> tuple[DataFrame, DataFrame]:
    """All attempts, and the final one of each request, without the prompt but with its hash; every attempt stays in the log, with its request."""
    asked = requests.withColumn("prompt_hash", F.substring(F.sha2("prompt", 256), 1, 16))
    kept = [*LOGGED, *[c for c in asked.columns if c not in ("key", "prompt", *LOGGED)]]
    return inference.run_with_retries(asked, _phases(run, stage), error_of, inference.Answers(f"{where}/attempts", kept), prompts=False)


def _usage(run: Run, attempts: DataFrame) -> DataFrame:
    """A priced usage row for each attempt sent."""
    counted = attempts.select("key", "dataset_config", "split", "language", "attempt", "phase", "mode", "ok", "model", *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in cost.TOKENS])
    return cost.estimate(counted, cost.price_table(run.spark, run.config.pricing), F.col("mode") == "batch")


def _object(stage: Stage, text: Column) -> Column:
    """struct(value, error) of a response in the stage's format, as a JSON object."""
    if stage.output_format == "json":
        return parse.json_object(text)
    found = parse.sections(text)
    return F.struct(F.when(F.size(found) > 0, F.to_json(found)).alias("value"), F.when(F.size(found) == 0, "no '### key' sections found in response").alias("error"))


def snapshot(run: Run, unit: Unit) -> str:
    """Where the rows of a unit are kept as they were translated."""
    return f"{run.root}/source/{unit.label}"


def rows_of(run: Run, unit: Unit, limit: int = 0) -> DataFrame:
    """The unit's rows with row_index and row_id, in file order."""
    rows = run.load(unit) if run.load else readers.jsonl(run.spark, unit.path)
    placed = readers.placed(rows)
    with_ids = identity.attach_row_ids(placed, run.config.benchmark, unit.config, unit.split, ["__file", "__block", "__at"], run.config.id_field).drop("__file", "__block", "__at")
    return with_ids.where(F.col("row_index") < limit) if limit else with_ids


def _items(run: Run, unit: Unit, number: int, group: list[str], limit: int, rows: DataFrame | None = None) -> tuple[DataFrame, T.StructType]:
    c = run.config
    rows = rows_of(run, unit, limit) if rows is None else rows
    lost = identity.missing_fields(rows.schema, group)
    if lost:
        raise ValueError(f"{unit.label}: no fields {lost}; there are {[x for x in rows.columns if not x.startswith('__')]}")
    rows = rows.select("row_id", "row_index", F.lit(c.benchmark).alias("benchmark"), F.lit(unit.config).alias("dataset_config"), F.lit(unit.split).alias("split"), identity.group_struct(rows.schema, group).alias("source"))
    items = fanout.fan_out(rows, c.languages, 1, c.codes).withColumn("group_index", F.lit(number)).withColumn("fields", F.array(*[F.lit(f) for f in group]))
    return fanout.with_record_id(items, c.benchmark).withColumn("script", fanout.language_script(F.col("language"), c.scripts)), rows.schema["source"].dataType


def translate(run: Run, units: list[Unit] | None = None, limit: int = 0) -> DataFrame:
    """Translate the rows of the units; with a limit the first so many of each, and what is there of the others stays."""
    stage, out, used = run.config.stage("translate"), [], []
    prompt = Path(stage.prompt).read_text(encoding="utf-8")
    units = units or [u for u in run.config.units if run.only is None or (u.config, u.split) in run.only]
    for unit in units:
        place = {"dataset_config": F.lit(unit.config), "split": F.lit(unit.split)}
        rows = rows_of(run, unit, limit)
        kept = versions.commit(rows.withColumnsRenamed({c: f"source_{c}" for c in place}).withColumns(place), snapshot(run, unit), [(unit.config, unit.split)], key="row_id" if limit else None)
        if not limit:  # then the snapshot has these rows and no others
            rows = kept.drop(*place).withColumnsRenamed({f"source_{c}": c for c in place}).select(*rows.columns)
        for number, group in enumerate(identity.groups_for(run.config.fields, unit.config, unit.split)):
            items, kind = _items(run, unit, number, group, limit, rows)
            values = template.prompt_values(F.col("source"), kind, F.col("language"), F.col("script"), F.col("language_code"))
            requests = items.withColumns({"key": F.col("record_id"), "prompt": template.render(prompt, values)})

            def error_of(text: Column, kind: T.StructType = kind) -> Column:
                return let(_object(stage, text), lambda p: F.coalesce(p["error"], validate.translation_error(p["value"], F.col("source"), kind)))

            attempts, final = _answered(run, stage, requests, error_of, f"{run.path('translate')}/{unit.label}/g{number}")
            used.append(attempts)
            value = _object(stage, F.col("text"))["value"]
            out.append(
                final.select(
                    *IDENTITY, F.to_json("source", {"ignoreNullFields": "false"}).alias("source"), F.lit("translate").alias("stage"), F.lit(0).alias("round"),
                    F.when(F.col("ok"), F.to_json(validate.cleaned(value, kind))).alias("translation"), F.col("text").alias("raw_response"), F.col("ok").alias("valid"),
                    F.col("failure").alias("validation_error"), F.col("attempt").alias("attempts"), "model", F.col("mode").alias("inference_mode"), *_provenance(stage, prompt),
                )
            )
    return _write(run, out, used, "translate", 0, [(u.config, u.split) for u in units], part=bool(limit))


def _provenance(stage: Stage, prompt: str) -> list[Column]:
    """Where a record came from: the prompt, its digest, the request and the time."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return [F.lit(stage.prompt).alias("prompt_path"), F.lit(hashlib.sha256(prompt.encode()).hexdigest()).alias("prompt_sha256"), F.col("prompt_hash"), F.col("key").alias("request_key"), now.alias("timestamp")]


def _write(run: Run, parts: list[DataFrame], attempts: list[DataFrame], stage: str, round_: int, units: list[versions.UnitKey], part: bool) -> DataFrame:
    """Commit the units' records, those of failed requests apart as well, and their usage; the records."""
    both = lambda dfs: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    top, df = run.path(stage, round_), both(parts)
    versions.commit(both([_usage(run, a) for a in attempts]), f"{top}/usage", units, key="key" if part else None)
    records = versions.commit(df, f"{top}/records", units, key="record_id" if part else None)
    versions.commit(versions.read(run.spark, f"{top}/records", units).where("validation_error IS NOT NULL"), f"{top}/failures", units)
    return records


def _units_of(df: DataFrame) -> list[versions.UnitKey]:
    """The units that records are of: as few as a benchmark has."""
    return sorted((r["dataset_config"], r["split"]) for r in df.select(*versions.UNIT).distinct().collect())


def _about(run: Run, prompt: str, translation: str, more: dict[str, Column]) -> Column:
    """A prompt about a record, rendered."""
    script = fanout.language_script(F.col("language"), run.config.scripts)
    return template.render(prompt, template.record_values(prompt, F.col("source"), F.col(translation), F.col("language"), script, F.col("language_code"), more))


def judge_prompt(run: Run, prompt: str) -> Column:
    """The judge's prompt, from translation records."""
    stage = run.config.stage("judge")
    return _about(run, prompt, "translation", {"translation_json": F.col("translation"), "translation_model": F.col("translation_model"), "pass_threshold": F.lit(f"{stage.pass_threshold:g}"), "score_scale": F.lit(f"{stage.score_scale:g}")})


def correct_prompt(run: Run, prompt: str) -> Column:
    """The corrector's prompt, from judged records."""
    audit = judgement.audit_payload(F.col("judge_parsed"), F.col("judge_score"), F.col("judge_passed"), F.col("judge_feedback"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    more = {n: F.col("previous_translation") for n in ("previous_translation_json", "translation_json", "candidate_json")}
    more |= {"audit_json": audit, "error_analysis_json": judgement.audit_errors(audit), "judge_score": text("judge_score"), "judge_score_scale": text("score_scale"), "judge_feedback": text("judge_feedback"), "judge_model": text("judge_model")}
    more["judge_verdict"] = F.when(F.coalesce(F.col("judge_passed"), F.lit(False)), "PASS").otherwise("FAIL")
    return _about(run, prompt, "previous_translation", more)


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Null columns for those that a table of records lacks."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def judge(run: Run, records: DataFrame, round_: int = 1, part: bool = False) -> DataFrame:
    """Judge usable translations of the run's units; if they are a `part` of their units, judgements of others stay."""
    stage, records = run.config.stage("judge"), run.chosen(records)
    prompt = Path(stage.prompt).read_text(encoding="utf-8")
    usable, _ = selection.for_judging(_with(records, {"prompt_path": "string", "prompt_sha256": "string"}))
    of = {"translation_stage": "stage", "translation_round": "round", "translation_model": "model", "translation_prompt_path": "prompt_path", "translation_prompt_sha256": "prompt_sha256"}
    asked = usable.select(*IDENTITY, "source", "translation", *[F.col(c).alias(n) for n, c in of.items()])
    requests = asked.withColumns({"key": F.col("record_id"), "prompt": judge_prompt(run, prompt)})

    def verdict(value: Column) -> Column:
        return judgement.judgement(value, stage.pass_threshold, stage.score_scale)

    def error_of(response: Column) -> Column:
        return let(_object(stage, response), lambda p: F.coalesce(p["error"], verdict(p["value"])["error"]))

    attempts, final = _answered(run, stage, requests, error_of, run.path("judge", round_))
    final = final.withColumn("parsed", F.when(F.col("ok"), _object(stage, F.col("text"))["value"]))
    out = final.withColumn("v", verdict(F.col("parsed"))).select(
        *IDENTITY, "source", "translation", *of, F.lit("judge").alias("stage"), F.lit(round_).alias("round"), "v.score", "v.passed", "v.feedback", F.lit(stage.pass_threshold).alias("pass_threshold"),
        F.lit(stage.score_scale).alias("score_scale"), F.col("parsed").alias("judge_parsed"), F.col("ok").alias("valid"), F.col("failure").alias("validation_error"), F.col("text").alias("judge_raw_response"),
        F.col("attempt").alias("attempts"), F.col("model").alias("judge_model"), "model", F.col("mode").alias("inference_mode"), *_provenance(stage, prompt),
    )
    return _write(run, [out], [attempts], "judge", round_, _units_of(records), part)


def correct(run: Run, judged: DataFrame, round_: int = 1, max_score: float | None = None, part: bool = False) -> DataFrame:
    """Rewrite what failed of the run's units; a failed rewrite keeps the translation it was to replace.

    Fields of a rewrite must have the kind (text, list or object) that they have in
    the translation before.
    """
    stage = run.config.stage("correct")
    prompt = Path(stage.prompt).read_text(encoding="utf-8")
    bound = stage.max_score if max_score is None else max_score
    of = {"previous_translation": "translation", "judge_score": "score", "judge_passed": "passed", "judge_feedback": "feedback", "judge_parsed": "judge_parsed", "judge_model": "judge_model", "score_scale": "score_scale"}
    judged = _with(run.chosen(judged), {"judge_parsed": "string", "judge_model": "string", "score_scale": "double"})
    asked = selection.for_correction(judged, bound).select(*IDENTITY, "source", *[F.col(c).alias(n) for n, c in of.items()])
    requests = asked.withColumns({"key": F.col("record_id"), "prompt": correct_prompt(run, prompt)})
    shape = lambda text, k: F.substring(F.to_json(F.element_at(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"), k)), 1, 1)  # noqa: E731  the first sign of a value

    def error_of(response: Column) -> Column:
        def wrong(p: Column) -> Column:
            given = F.coalesce(F.json_object_keys(p["value"]), F.array().cast("array<string>"))
            lost = F.array_except(F.json_object_keys("source"), given)
            other = F.filter(F.json_object_keys("source"), lambda k: F.array_contains(given, k) & shape(F.col("previous_translation"), k).isin('"', "[", "{") & (shape(p["value"], k) != shape(F.col("previous_translation"), k)))
            return F.coalesce(p["error"], F.when(F.size(lost) > 0, F.concat(F.lit("missing field "), F.array_join(lost, ","))), F.when(F.size(other) > 0, F.concat(F.lit("another kind of value in field "), F.array_join(other, ","))))

        return let(_object(stage, response), wrong)

    attempts, final = _answered(run, stage, requests, error_of, run.path("correct", round_))
    final = final.withColumn("new", F.when(F.col("ok"), _object(stage, F.col("text"))["value"]))
    out = final.select(
        *IDENTITY, "source", F.lit("correct").alias("stage"), F.lit(round_).alias("round"), F.coalesce("new", "previous_translation").alias("translation"), F.col("ok").alias("corrected"), "previous_translation",
        "judge_score", "judge_feedback", F.get_json_object("new", "$.source_mistake").alias("source_mistake"), F.lit(True).alias("valid"), F.col("failure").alias("validation_error"), F.col("text").alias("raw_response"),
        F.col("attempt").alias("attempts"), "model", F.col("mode").alias("inference_mode"), *_provenance(stage, prompt),
    )
    return _write(run, [out], [attempts], "correct", round_, _units_of(judged), part)


def stage_folders(run: Run, part: str) -> list[tuple[str, int, str]]:
    """(stage, round, folder) of all rounds in the store that have committed a part, in reading order."""
    names = [(m[1], int(m[2] or 0), m[0]) for m in map(STAGE.fullmatch, readers.folders(run.spark, run.root)) if m]
    return [x for x in sorted(names, key=lambda x: (x[1], ORDER[x[0]])) if versions.exists(run.spark, f"{run.root}/{x[2]}/{part}")]


def records_of(run: Run, names: list[str] | None = None) -> DataFrame:
    """All records of all stages and rounds in the store, or of the stage folders named, with a place in reading order."""
    out = None
    for place, (_, _, name) in enumerate(x for x in stage_folders(run, "records") if not names or x[2] in names):
        df = run.chosen(versions.read(run.spark, f"{run.root}/{name}/records")).withColumn("position", F.lit(place).cast("long"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no records under {run.root}")
    return _with(out, {"score": "double", "passed": "boolean", "feedback": "string", "translation_stage": "string", "translation_round": "int"})


def assemble(run: Run, unit: Unit, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The wide dataset of a unit, of its rows as they were translated, and its missing translations."""
    c = run.config
    records = records_of(run, names)
    best = selection.newest_usable(records.where((F.col("stage") != "judge") & (F.col("dataset_config") == unit.config) & (F.col("split") == unit.split)))
    groups = identity.groups_for(c.fields, unit.config, unit.split)
    keys = [identity.field_key(f) for g in groups for f in g]
    scores = selection.newest(records.where("stage = 'judge'")).select("record_id", F.col("score").alias("_score"))
    parts = best.join(scores, "record_id", "left").select("row_id", "language", "stage", F.col("_score").alias("score"), *[F.get_json_object("translation", f"$['{k}']").alias(k) for k in keys])
    flat = parts.groupBy("row_id", "language").agg(F.max("stage").alias("stage"), F.max("score").alias("score"), *[F.max(k).alias(k) for k in keys])
    codes = {x: c.codes.get(x, fanout.LANGUAGES.get(x, (x,))[0]) for x in c.languages}
    kept = snapshot(run, unit)
    rows = versions.read(run.spark, kept).drop("dataset_config", "split").withColumnsRenamed({"source_dataset_config": "dataset_config", "source_split": "split"}) if versions.exists(run.spark, kept) else rows_of(run, unit)
    wide = assembly.wide(rows, flat, keys, codes, c.output.column_template, c.output.keep_source_columns, c.output.include_quality_columns)
    slots = None
    for i, g in enumerate(groups):
        items, _ = _items(run, unit, i, g, 0)
        s = items.select("record_id", "row_id", "language", "group_index", "fields")
        slots = s if slots is None else slots.unionByName(s)
    return wide, assembly.missing(slots, best)


def review_threshold(c: Config) -> float:
    """What scores below it is queued: the review's own bound, else the judge's."""
    if c.review.fail_threshold is not None:
        return c.review.fail_threshold
    return c.stages["judge"].pass_threshold if "judge" in c.stages else 0.0


def review_run(run: Run, names: list[str] | None = None) -> DataFrame:
    """Marked review rows of all records, with the views of their stages."""
    c, records = run.config, records_of(run, names)
    rows = review.review_rows(review.history(records), c.review.prefer_best_translation)
    marked = review.mark(rows, review_threshold(c), c.review.sample_rate, c.review.sample_seed, c.review.queue_regressions)
    of = records.where("stage = 'translate'").select("record_id", "dataset_config", "split", "row_id", "row_index", "language", "source")
    return marked.join(of, "record_id").join(review.views(records, c.review.include_judge_details), "record_id")


def write_review(run: Run, queue_only: bool = False, names: list[str] | None = None) -> dict:
    """Rows, queue, spreadsheets and summary under <root>/review; the summary."""
    c, folder = run.config, f"{run.root}/review"
    review_run(run, names).write.mode("overwrite").parquet(f"{folder}/rows")
    rows = run.spark.read.parquet(f"{folder}/rows")
    order = ["dataset_config", "split", "row_index", "language"]
    queue = rows.where("review_selected")
    if c.review.include_all_rows and not queue_only:
        writers.write_jsonl(rows.orderBy(*order), f"{folder}/all")
    writers.write_jsonl(queue.orderBy(*order), f"{folder}/queue")
    used = sorted(r["round"] for r in review.rounds_used(rows).collect())  # a row for each round
    judged = sorted(r["round"] for r in review.rounds_used(rows, "judge_rounds").collect())
    many = max(used, default=0) > 1
    for unit in c.units if c.review.csv else []:
        fields = [identity.field_key(f) for g in identity.groups_for(c.fields, unit.config, unit.split) for f in g]
        mine = (F.col("dataset_config") == unit.config) & (F.col("split") == unit.split)
        part = lambda text, f: F.get_json_object(text, f"$['{f}']").alias(f)
        for name, df in [("queue", queue), *([("all", rows)] if c.review.csv_all_rows and not queue_only else [])]:
            split = df.where(mine).withColumns({t: F.struct(*[part(t, f) for f in fields]) for t in ("source", "translation")})
            writers.write_csv(writers.review_sheet(split, fields, c.review.human_fields, judged if many else None).orderBy("row_id", "language"), f"{folder}/{name}_csv/{unit.label}")
    keys = ["dataset_config", "split"]
    units = {(r["dataset_config"], r["split"]): r.asDict() for r in review.unit_summary(rows, review_threshold(c), keys).collect()}  # a row for each unit
    for r in review.reasons(rows, [*keys, "language"]).collect():  # and for each language and reason
        unit = units[r["dataset_config"], r["split"]]
        unit.setdefault("by_reason", {})[r["review_reason"]] = unit.get("by_reason", {}).get(r["review_reason"], 0) + r["n"]
        unit.setdefault("by_language", {}).setdefault(r["language"], {})[r["review_reason"]] = r["n"]
    summary = {"benchmark": c.benchmark, "fail_threshold": review_threshold(c), "sample_rate": c.review.sample_rate, "sample_seed": c.review.sample_seed, "correction_rounds_seen": used, "judge_rounds_seen": judged, "units": [units[k] for k in sorted(units)]}
    writers.write_document(run.spark, summary, f"{folder}/summary.json")
    return summary


def recorrect(run: Run, threshold: float, again: bool = False, dry: bool = False, correct_round: int | None = None, judge_round: int | None = None, skip_judge: bool = False) -> dict:
    """Correct and judge again what scores below a raised threshold; a dry run only counts."""
    records = _with(records_of(run), {"judge_parsed": "string", "judge_model": "string", "score_scale": "double"})
    plan = selection.recorrect_plan(records.where("stage = 'judge'"), records.where("stage = 'correct'"), threshold, again)
    rounds = selection.next_rounds(records.select("stage", "round").distinct()).first()
    counts = {r["decision"]: r["n"] for r in plan.groupBy("decision").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {"threshold": threshold, "selected": counts.pop("selected", 0), "skipped": counts, "correct_round": correct_round or rounds["correct_round"], "judge_round": judge_round or rounds["judge_round"]}
    if dry:
        return out
    folder = f"{run.root}/recorrect_r{out['correct_round']}"
    writers.write_document(run.spark, out | {"record_ids": f"{folder}/input"}, f"{folder}/manifest.json")
    if out["selected"]:
        plan.where("decision = 'selected'").orderBy("dataset_config", "split", "row_index", "language").write.mode("overwrite").parquet(f"{folder}/input")
        fixed = correct(run, run.spark.read.parquet(f"{folder}/input"), out["correct_round"], threshold)
        if not skip_judge:
            judge(run, fixed, out["judge_round"])
    return out


def usage_of(run: Run, policy: str = "gaps") -> DataFrame:
    """The usage rows of all stages, priced again by `policy`: stages that cost nothing so far ("gaps"), all ("force"), none ("off")."""
    out = None
    for stage, number, name in stage_folders(run, "usage"):
        df = run.chosen(versions.read(run.spark, f"{run.root}/{name}/usage")).select("dataset_config", "split", "language", "mode", "model", "attempt", "ok", *cost.TOKENS, "cost_usd").withColumns({"stage": F.lit(stage), "round": F.lit(number)})
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise FileNotFoundError(f"no usage under {run.root}")
    return cost.repriced(out, cost.price_table(run.spark, run.config.pricing), policy)


def costs(run: Run, policy: str = "gaps") -> DataFrame:
    """The roll-up of all stages' usage."""
    return cost.roll_up(usage_of(run, policy))


def attempt_totals(run: Run) -> DataFrame:
    """How many requests of each stage, round and attempt were answered well, and how many failed."""
    return usage_of(run, "off").groupBy("stage", "round", "attempt").agg(F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))


def chain(run: Run, rounds: int = 1, stages: tuple[str, ...] = ("translate", "judge", "correct"), limit: int = 0) -> DataFrame:
    """translate, then judge and correct so many times, and a last judgement; stages that are left out are read from the store."""
    current = translate(run, limit=limit) if "translate" in stages else run.table("translate")
    if "judge" not in stages:
        return current
    for n in range(1, rounds + 1):
        judged = judge(run, current, n)
        if "correct" not in stages:
            return judged
        current = correct(run, judged, n)
    return judge(run, current, rounds + 1)


def preview(run: Run, unit: Unit, name: str = "translate") -> tuple[str, list[str]]:
    """The first prompt of a unit and stage, without any call, and the placeholders that stay unfilled.

    Prompts of later stages are about the first row as its own translation, judged at 0.
    """
    stage = run.config.stage(name)
    prompt = Path(stage.prompt).read_text(encoding="utf-8")
    items, kind = _items(run, unit, 0, identity.groups_for(run.config.fields, unit.config, unit.split)[0], 1)
    if name == "translate":
        text = template.render(prompt, template.prompt_values(F.col("source"), kind, F.col("language"), F.col("script"), F.col("language_code")))
    else:
        as_json = F.to_json("source", {"ignoreNullFields": "false"})
        items = items.withColumns({"source": as_json, "translation": as_json, "previous_translation": as_json, "translation_model": F.lit(""), "judge_parsed": F.lit(None).cast("string"), "judge_score": F.lit(0.0), "judge_passed": F.lit(False), "judge_feedback": F.lit(""), "judge_model": F.lit(""), "score_scale": F.lit(stage.score_scale)})
        text = (judge_prompt if name == "judge" else correct_prompt)(run, prompt)
    shown = items.orderBy("language").select(text.alias("p")).first()["p"]
    return shown, [p for p in template.placeholders(prompt) if "{" + p + "}" in shown]
