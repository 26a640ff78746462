"""Human review: history by record, what to show, what to queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.exact import exact_mean
from lexiloom.functions.hashing import sample_fraction

UNJUDGED, FAILED, REGRESSED, SAMPLED = "never_judged", "failed_after_final_judge", "score_regressed", "random_sample"


def history(records: DataFrame) -> DataFrame:
    """One row for each record_id from all stages' records, in one shuffle.

    `records` has record_id, stage (translate, judge, correct), round, position,
    translation, score, passed, feedback, translation_stage, translation_round.
    Of equal (stage, round) the record read last counts.  Result: record_id,
    translate (struct or null), corrections and judgements (arrays by round).
    """
    last = F.max_by(F.struct("translation", "score", "passed", "feedback", "translation_stage", "translation_round"), "position")
    one = records.groupBy("record_id", "stage", "round").agg(last.alias("r"))
    version = F.struct(F.col("round"), F.col("r.translation").alias("translation"))
    verdict = F.struct(F.col("round"), F.col("r.score").alias("score"), F.col("r.passed").alias("passed"), F.col("r.feedback").alias("feedback"), F.col("r.translation_stage").alias("of_stage"), F.col("r.translation_round").alias("of_round"))
    of = lambda stage, x: F.array_sort(F.collect_list(F.when(F.col("stage") == stage, x)))
    return one.groupBy("record_id").agg(F.max(F.when(F.col("stage") == "translate", version)).alias("translate"), of("correct", version).alias("corrections"), of("judge", verdict).alias("judgements"))


def _best(judgements: Column) -> Column:
    """The highest (score, round) of scored judgements."""
    scored = F.transform(F.filter(judgements, lambda j: j["score"].isNotNull()), lambda j: F.struct(j["score"].alias("score"), j["round"].alias("round"), j.alias("j")))
    return F.array_max(F.transform(scored, lambda s: F.struct(s["score"], s["round"])))


def review_rows(hist: DataFrame, prefer_best: bool = False) -> DataFrame:
    """The version to show, its judgement, and what is known of its rounds."""
    first = lambda a: F.get(F.col(a), F.lit(0))
    final = lambda a: F.try_element_at(F.col(a), F.lit(-1))
    h = hist.withColumns({"best": _best(F.col("judgements")), "latest_judge": final("judgements"), "latest_fix": final("corrections")})
    h = h.withColumn("best_judge", F.get(F.filter("judgements", lambda j: (j["round"] == F.col("best.round"))), F.lit(0)))
    fixed = F.get(F.filter("corrections", lambda c: c["round"] == F.col("best_judge.of_round")), F.lit(0))
    version = lambda stage, v: F.when(v.isNotNull(), F.struct(F.lit(stage).alias("stage"), v["round"].cast("long").alias("round"), v["translation"].alias("translation")))
    judged = F.when(F.col("best_judge.of_stage") == "correct", version("correct", fixed)).when(F.col("best_judge").isNotNull(), version("translate", F.col("translate")))
    h = h.withColumns({"best_version": judged, "latest_version": F.coalesce(version("correct", F.col("latest_fix")), version("translate", F.col("translate")))})
    use = F.col("best_version").isNotNull() if prefer_best else F.lit(False)
    h = h.withColumns({"shown": F.when(use, F.col("best_version")).otherwise(F.col("latest_version")), "judge": F.when(use, F.col("best_judge")).otherwise(F.col("latest_judge"))})
    stale = ~(F.col("judge.of_stage").eqNullSafe(F.col("shown.stage")) & F.col("judge.of_round").cast("long").eqNullSafe(F.col("shown.round")))
    rounds = lambda a: F.transform(a, lambda x: x["round"])
    return h.select(
        "record_id",
        F.col("shown.translation").alias("translation"),
        F.col("shown.stage").alias("final_stage"),
        F.col("shown.round").alias("final_round"),
        (F.size("corrections") > 0).alias("was_corrected"),
        F.size("corrections").alias("correction_rounds"),
        rounds("judgements").alias("judge_rounds"),
        F.col("judge.round").alias("final_judge_round"),
        F.col("judge.score").alias("final_score"),
        F.col("judge.passed").alias("final_passed"),
        F.col("judge.feedback").alias("final_feedback"),
        first("judgements")["score"].alias("first_score"),
        F.transform("judgements", lambda j: F.struct(j["round"].alias("judge_round"), j["score"], j["passed"], j["of_stage"], j["of_round"])).alias("score_history"),
        F.col("best.score").alias("best_score"),
        F.col("best.round").alias("best_judge_round"),
        F.col("best_version.stage").alias("best_stage"),
        F.col("best_version.round").alias("best_round"),
        F.when(use, "best_score").otherwise("latest_round").alias("translation_picked"),
        rounds("corrections").alias("correction_rounds_applied"),
        F.exists("corrections", lambda c: c["round"] > 1).alias("recorrected"),
        F.col("latest_judge.score").alias("latest_score"),
        F.coalesce(F.col("judge").isNotNull() & F.col("shown").isNotNull() & stale, F.lit(False)).alias("final_score_stale"),
    )


# What a reviewer sees of each stage's records, by name and column.
VIEWS = {
    "translate": {c: c for c in ("translation", "model", "prompt_path", "inference_mode", "attempts", "timestamp", "valid", "validation_error")},
    "judge": {"round": "round", "score": "score", "passed": "passed", "feedback": "feedback", "judged_stage": "translation_stage", "judged_round": "translation_round", "pass_threshold": "pass_threshold", "score_scale": "score_scale", "model": "judge_model"}
    | {c: c for c in ("prompt_path", "timestamp", "valid", "validation_error")},
    "correct": {c: c for c in ("round", "corrected", "previous_translation", "translation")} | {"judge_score_in": "judge_score", "judge_feedback_in": "judge_feedback"}
    | {c: c for c in ("source_mistake", "model", "prompt_path", "timestamp", "valid", "validation_error")},
}
DETAILS = {"translate": ("raw_response", "raw_response"), "judge": ("parsed", "judge_parsed"), "correct": ("raw_response", "raw_response")}


def views(records: DataFrame, details: bool = True) -> DataFrame:
    """For each record_id the views of its translation, judgements and corrections, by round; of equal rounds the record read last counts."""

    def view(stage: str) -> Column:
        names = VIEWS[stage] | (dict([DETAILS[stage]]) if details else {})
        return F.struct(*[(F.col(c) if c in records.columns else F.lit(None).cast("string")).alias(n) for n, c in names.items()])

    of = {s: F.max_by(F.when(F.col("stage") == s, view(s)), "position") for s in VIEWS}
    one = records.groupBy("record_id", "stage", "round").agg(*[c.alias(f"{s}_view") for s, c in of.items()])
    rounds = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("stage") == s, F.struct("round", F.col(f"{s}_view").alias("v"))))), lambda x: x["v"])
    return one.groupBy("record_id").agg(F.max(F.when(F.col("stage") == "translate", F.col("translate_view"))).alias("translate_view"), rounds("judge").alias("judge_views"), rounds("correct").alias("correct_views"))


def mark(rows: DataFrame, threshold: float, rate: float = 0.25, seed: str = "human-review-v1", regressions: bool = False) -> DataFrame:
    """Add review_reason and review_selected: never judged, failed, regressed if asked for, sampled, or none."""
    reason = F.when(F.col("final_score").isNull(), UNJUDGED).when(F.col("final_score") < threshold, FAILED)
    if regressions:
        reason = reason.when(F.col("final_score") < F.col("best_score"), REGRESSED)
    if rate:
        reason = reason.when(sample_fraction(seed, F.col("record_id")) < rate, SAMPLED)
    return rows.withColumn("review_reason", reason.otherwise("")).withColumn("review_selected", F.col("review_reason") != "")


def unit_summary(rows: DataFrame, threshold: float, keys: list[str]) -> DataFrame:
    """Counts and means of marked rows by unit."""
    count = lambda c: F.count_if(c).cast("long")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("instances"),
        count(F.col("review_selected")).alias("queued"),
        F.round(100 * F.count_if(F.col("review_selected")) / F.count(F.lit(1)), 2).alias("queued_pct"),
        F.count("final_score").alias("judged"),
        F.round(F.avg("final_score"), 3).alias("mean_final_score"),
        count(F.col("was_corrected")).alias("corrected"),
        count(F.col("recorrected")).alias("recorrected"),
        F.round(F.avg("best_score"), 3).alias("mean_best_score"),
        count(F.col("best_score") < threshold).alias("below_threshold_at_best"),
        count(F.col("final_score") < F.col("best_score")).alias("regressed"),
        count(F.col("final_score_stale")).alias("stale_final_score"),
    )


def reasons(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where("review_selected").groupBy(*keys, "review_reason").agg(F.count(F.lit(1)).alias("n"))


def rounds_used(rows: DataFrame, column: str = "correction_rounds_applied") -> DataFrame:
    return rows.select(F.explode(column).alias("round")).distinct()


def round_scores(rows: DataFrame, rounds: list[int]) -> DataFrame:
    """A column judge_r<N>_score for each round."""
    score = lambda n: F.get(F.filter("score_history", lambda h: h["judge_round"] == n), F.lit(0))["score"]
    return rows.withColumns({f"judge_r{n}_score": score(n) for n in rounds})


def judge_stats(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Passed, failed and mean score of valid judgements; rates are null where there are none."""
    valid = F.col("score").isNotNull()
    return judged.groupBy(*keys).agg(
        F.count_if(valid).cast("long").alias("judged"),
        F.count_if(valid & F.col("passed")).cast("long").alias("n_passed"),
        F.count_if(~valid).cast("long").alias("failed_judgement"),
        F.round(exact_mean("score"), 3).alias("mean_score"),
        F.round(F.try_divide(F.count_if(valid & F.col("passed")), F.count_if(valid)), 4).alias("pass_rate"),
    )
