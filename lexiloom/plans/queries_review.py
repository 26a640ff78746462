"""Queries of selection, assembly, review and cost over the deterministic run."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiloom.functions.exact import exact_sum
from lexiloom.operators import assembly, cost, fanout, review, selection
from lexiloom.plans import fixture
from lexiloom.plans.catalogue import query
from lexiloom.plans.fixture import BASE, FAILING, FIXED, THRESHOLD, table

count = lambda name="n": F.count(F.lit(1)).alias(name)


@query(f"WITH {BASE} SELECT split, count(*)::BIGINT AS n_judged, sum((score_1 < {THRESHOLD})::INT)::BIGINT AS n_failed FROM judged GROUP BY split")
def usable_and_failed_filter(spark, sf_dir):
    r = fixture.records(spark, sf_dir).where("stage = 'judge' AND round = 1").withColumn("translation", F.lit("x"))
    failed = selection.for_correction(r).groupBy("split").agg(count("n_failed"))
    return selection.for_judging(r)[0].groupBy("split").agg(count("n_judged")).join(failed, "split", "left").select("split", "n_judged", F.coalesce("n_failed", F.lit(0)).cast("long").alias("n_failed"))


@query(f"WITH {BASE} SELECT language, count(*)::BIGINT AS n, max(score_1) AS highest FROM judged WHERE score_1 <= {FIXED} GROUP BY language")
def correct_by_max_score(spark, sf_dir):
    r = fixture.records(spark, sf_dir).where("stage = 'judge' AND round = 1").withColumn("translation", F.lit("x"))
    return selection.for_correction(r, float(FIXED)).groupBy("language").agg(count(), F.max("score").alias("highest"))


@query(f"""WITH {BASE} SELECT language, CASE WHEN NOT fixed THEN 'selected' WHEN doc_id % 2 = 0 THEN 'correction_never_judged' ELSE 'already_corrected' END AS decision, count(*)::BIGINT AS n
FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN score_1 ELSE score_2 END AS s FROM judged) WHERE s < {THRESHOLD} GROUP BY 1, 2""")
def recorrect_plan(spark, sf_dir):
    """The second judgement is missing for even documents, so their corrections were never judged."""
    r = fixture.records(spark, sf_dir)
    j = r.where("stage = 'judge' AND (round = 1 OR CAST(row_id AS long) % 2 = 1)").withColumn("translation", F.lit("x"))
    return selection.recorrect_plan(j, r.where("stage = 'correct'"), THRESHOLD).groupBy("language", "decision").agg(count())


@query(f"WITH {BASE} SELECT (max(fixed::INT) + 1)::BIGINT AS correct_round, 3::BIGINT AS judge_round FROM judged")
def next_rounds(spark, sf_dir):
    return selection.next_rounds(fixture.records(spark, sf_dir).select("stage", "round").distinct())


@query(f"WITH {BASE} SELECT record_id, CASE WHEN fixed THEN 'correct' ELSE 'translate' END AS stage, '[' || language || '] ' || CASE WHEN fixed THEN 'c ' ELSE 't ' END || row_id AS translation FROM judged")
def latest_usable_record(spark, sf_dir):
    return selection.newest_usable(fixture.records(spark, sf_dir).where("stage <> 'judge'")).select("record_id", "stage", "translation")


@query(f"""WITH {BASE} SELECT record_id, greatest(score_1, score_2) AS score, (CASE WHEN score_2 >= score_1 THEN 2 ELSE 1 END)::BIGINT AS round,
  CASE WHEN fixed AND score_2 >= score_1 THEN '[' || language || '] c ' || row_id ELSE '[' || language || '] t ' || row_id END AS judged_translation FROM judged""")
def best_judgement(spark, sf_dir):
    r = fixture.records(spark, sf_dir)
    best = selection.best_judgement(r.where("stage = 'judge'").select("record_id", "score", "round", "translation_stage", "translation_round"))
    return selection.judged_versions(best, r.where("stage <> 'judge'")).select("record_id", "score", F.col("round").cast("long").alias("round"), "judged_translation")


def _rows(spark, sf_dir, prefer_best=False):
    return review.review_rows(review.history(fixture.records(spark, sf_dir)), prefer_best)


@query(f"WITH {BASE} SELECT record_id, '1:' || score_1::INT || ',2:' || score_2::INT AS history, score_1 AS judge_r1_score, score_2 AS judge_r2_score FROM judged")
def score_history(spark, sf_dir):
    rows = review.round_scores(_rows(spark, sf_dir), [1, 2])
    line = F.array_join(F.transform("score_history", lambda h: F.concat(h["judge_round"].cast("string"), F.lit(":"), h["score"].cast("int").cast("string"))), ",")
    return rows.select("record_id", line.alias("history"), "judge_r1_score", "judge_r2_score")


@query(f"""WITH {BASE} SELECT record_id, CASE WHEN fixed THEN 'correct' ELSE 'translate' END AS final_stage, fixed::INT::BIGINT AS final_round, fixed AS was_corrected,
  score_2 AS final_score, score_2 >= {THRESHOLD} AS final_passed, score_1 AS first_score, greatest(score_1, score_2) AS best_score, (CASE WHEN score_2 >= score_1 THEN 2 ELSE 1 END)::BIGINT AS best_judge_round,
  CASE WHEN fixed AND score_2 >= score_1 THEN 'correct' ELSE 'translate' END AS best_stage, false AS final_score_stale, false AS recorrected FROM judged""")
def review_rows(spark, sf_dir):
    long = lambda c: F.col(c).cast("long").alias(c)
    return _rows(spark, sf_dir).select("record_id", "final_stage", long("final_round"), "was_corrected", "final_score", "final_passed", "first_score", "best_score", long("best_judge_round"), "best_stage", "final_score_stale", "recorrected")


@query(f"""WITH {BASE} SELECT record_id, CASE WHEN fixed AND score_2 >= score_1 THEN 'correct' ELSE 'translate' END AS final_stage, greatest(score_1, score_2) AS final_score, 'best_score' AS translation_picked FROM judged""")
def review_rows_best(spark, sf_dir):
    return _rows(spark, sf_dir, prefer_best=True).select("record_id", "final_stage", "final_score", "translation_picked")


MARK_SQL = f"""marked AS (SELECT *, CASE WHEN score_2 < {FAILING} THEN 'failed_after_final_judge' WHEN score_2 < score_1 THEN 'score_regressed'
  WHEN {fixture._hex("sha256('human-review-v1|' || record_id)", 8)}::DOUBLE / 4294967296 < 0.25 THEN 'random_sample' ELSE '' END AS review_reason FROM judged)"""


def _marked(spark, sf_dir):
    parts = F.split("record_id", r"\|")
    return review.mark(_rows(spark, sf_dir), FAILING, 0.25, regressions=True).withColumns({"split": parts[2], "language": parts[4]})


@query(f"WITH {BASE}, {MARK_SQL} SELECT record_id, review_reason, review_reason <> '' AS review_selected FROM marked")
def review_queue(spark, sf_dir):
    return _marked(spark, sf_dir).select("record_id", "review_reason", "review_selected")


@query(f"""WITH {BASE}, {MARK_SQL} SELECT split, count(*)::BIGINT AS instances, sum((review_reason <> '')::INT)::BIGINT AS queued, round(100.0 * sum((review_reason <> '')::INT) / count(*), 2)::DOUBLE AS queued_pct,
  count(score_2)::BIGINT AS judged, round(avg(score_2), 3) AS mean_final_score, sum(fixed::INT)::BIGINT AS corrected, 0::BIGINT AS recorrected, round(avg(greatest(score_1, score_2)), 3) AS mean_best_score,
  sum((greatest(score_1, score_2) < {FAILING})::INT)::BIGINT AS below_threshold_at_best, sum((score_2 < score_1)::INT)::BIGINT AS regressed, 0::BIGINT AS stale_final_score FROM marked GROUP BY split""")
def review_summary(spark, sf_dir):
    return review.unit_summary(_marked(spark, sf_dir), FAILING, ["split"])


@query(f"WITH {BASE}, {MARK_SQL} SELECT language, review_reason, count(*)::BIGINT AS n FROM marked WHERE review_reason <> '' GROUP BY language, review_reason")
def review_reason_by_language(spark, sf_dir):
    return review.reasons(_marked(spark, sf_dir), ["language"])


@query(f"""WITH {BASE}, {MARK_SQL} SELECT split, language, review_reason, record_id, row_number() OVER (ORDER BY split, doc_id, language)::BIGINT AS place FROM marked WHERE review_reason = 'score_regressed'""")
def review_order(spark, sf_dir):
    """The queue of one reason in the reviewer's order."""
    from lexiloom.operators.identity import row_index

    q = _marked(spark, sf_dir).where(f"review_reason = '{review.REGRESSED}'").withColumn("row", F.split("record_id", r"\|")[3].cast("long"))
    return row_index(q.select("split", "language", "review_reason", "record_id", "row"), ["split", "row", "language"]).select("split", "language", "review_reason", "record_id", (F.col("row_index") + 1).alias("place"))


@query(f"""WITH {BASE} SELECT split, round, count(*)::BIGINT AS judged, sum((s >= {THRESHOLD})::INT)::BIGINT AS n_passed, 0::BIGINT AS failed_judgement, round(avg(s), 3) AS mean_score,
  round(sum((s >= {THRESHOLD})::INT) / count(*), 4)::DOUBLE AS pass_rate FROM (SELECT split, 1::BIGINT AS round, score_1 AS s FROM judged UNION ALL SELECT split, 2, score_2 FROM judged) GROUP BY split, round""")
def judge_stats(spark, sf_dir):
    r = fixture.records(spark, sf_dir).where("stage = 'judge'").withColumn("round", F.col("round").cast("long"))
    return review.judge_stats(r, ["split", "round"])


LANGS = {k: c for k, (c, _) in fanout.LANGUAGES.items()}
WIDE_SQL = ", ".join(f"max(CASE WHEN language = '{k}' AND doc_id % 9 <> 0 THEN t END) AS question_{c}" for k, c in LANGS.items())


@query(f"WITH {BASE} SELECT row_id, doc_id, {WIDE_SQL} FROM (SELECT *, '[' || language || '] ' || CASE WHEN fixed THEN 'c ' ELSE 't ' END || row_id AS t FROM judged) GROUP BY row_id, doc_id")
def assemble_wide(spark, sf_dir):
    """The newest usable translations beside their rows; every ninth document has none."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("row_id"), "doc_id")
    best = selection.newest_usable(fixture.records(spark, sf_dir).where("stage <> 'judge' AND CAST(row_id AS long) % 9 <> 0"))
    return assembly.wide(rows, best.withColumnRenamed("translation", "question"), ["question"], LANGS, "{field}_{code}")


@query(f"WITH {BASE} SELECT record_id, row_id, language FROM judged WHERE doc_id % 9 = 0")
def assemble_missing(spark, sf_dir):
    best = selection.newest_usable(fixture.records(spark, sf_dir).where("stage <> 'judge' AND CAST(row_id AS long) % 9 <> 0"))
    return assembly.missing(fixture.items(spark, sf_dir).select("record_id", "row_id", "language"), best)


SUMS = "count(*)::BIGINT AS requests, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, sum(reasoning_tokens)::BIGINT AS reasoning_tokens, sum(total_tokens)::BIGINT AS total_tokens, round(sum(cost_usd), 6) AS cost_usd"


def _rounded(df):
    return df.withColumn("cost_usd", F.round("cost_usd", 6))


@query(f"WITH {BASE} SELECT language, grouping(language) = 0 AS grouped, {SUMS} FROM usage GROUP BY GROUPING SETS ((language), ())")
def usage_by_language(spark, sf_dir):
    return _rounded(cost.summarise(fixture.usage(spark, sf_dir), ["language"]))


@query(f"WITH {BASE} SELECT mode, {SUMS} FROM usage GROUP BY mode")
def usage_by_mode(spark, sf_dir):
    return _rounded(fixture.usage(spark, sf_dir).groupBy("mode").agg(*cost.totals()))


@query(f"""WITH {BASE}, u AS (SELECT *, CASE WHEN round > 0 THEN stage || '_r' || round ELSE stage END AS k, dataset_config || '/' || split AS unit FROM usage)
SELECT CASE WHEN grouping(k) = 0 THEN 'stage' WHEN grouping(unit) = 0 THEN 'unit' WHEN grouping(language) = 0 THEN 'language' ELSE 'run' END AS level, coalesce(k, unit, language, 'run') AS key, {SUMS}
FROM u GROUP BY GROUPING SETS ((k), (unit), (language), ())""")
def cost_rollup(spark, sf_dir):
    return _rounded(cost.roll_up(fixture.usage(spark, sf_dir)))


@query(f"WITH {BASE} SELECT language, {SUMS} FROM usage GROUP BY language")
def cost_merge(spark, sf_dir):
    """Sums by unit and language, summed again."""
    part = fixture.usage(spark, sf_dir).groupBy("split", "language").agg(*cost.totals())
    return _rounded(cost.merge(part, ["language"]))


MODELS = ["gemini-2.5-flash-001", "gemini-2.5-flash-lite-002", "hosted/google/gemini-2.5-pro", "own/model", "unknown-1", "gemini-2.0-flash"]
PRICE_SQL = "p(k, i, o) AS (VALUES " + ", ".join(f"('{k}', {a}::DOUBLE, {b}::DOUBLE)" for k, (a, b) in cost.PRICES.items()) + ", ('own/model', 9.0, 9.0))"
BEST_SQL = f"""m(model) AS (VALUES {", ".join(f"('{m}')" for m in MODELS)}), {PRICE_SQL},
best AS (SELECT * FROM (SELECT m.model, p.k, p.i, p.o, row_number() OVER (PARTITION BY m.model ORDER BY (m.model = p.k OR m.model LIKE '%/' || p.k) DESC, length(p.k) DESC) AS r
  FROM m JOIN p ON m.model = p.k OR m.model LIKE '%/' || p.k OR starts_with(regexp_extract(m.model, '[^/]*$'), p.k)) WHERE r = 1)"""


def _models(df):
    return df.withColumn("model", F.element_at(F.array(*[F.lit(m) for m in MODELS]), (F.col("doc_id") % len(MODELS) + 1).cast("int")))


OWN = {"own/model": {"input_per_1m": 9.0, "output_per_1m": 9.0}}


@query(f"WITH {BEST_SQL}, d AS (SELECT (doc_id % 6)::INT AS j FROM documents) SELECT x.model, best.k AS price_key, best.i AS input_per_1m, best.o AS output_per_1m, count(*)::BIGINT AS n FROM (SELECT [{', '.join(repr(m) for m in MODELS)}][j + 1] AS model FROM d) x LEFT JOIN best USING (model) GROUP BY ALL")
def price_lookup(spark, sf_dir):
    d = _models(table(spark, sf_dir, "documents").select("doc_id"))
    return cost.match_prices(d, cost.price_table(spark, OWN)).groupBy("model", "price_key", "input_per_1m", "output_per_1m").agg(count())


@query(f"""WITH {BEST_SQL}, d AS (SELECT doc_id, [{', '.join(repr(m) for m in MODELS)}][(doc_id % 6)::INT + 1] AS model, n_chars AS i, n_chars // 2 AS o, doc_id % 10 AS r FROM documents)
SELECT doc_id, round(CASE WHEN k IS NULL THEN 0.0 ELSE (d.i * best.i + (d.o + d.r) * best.o) / 1000000 * CASE WHEN doc_id % 2 = 0 THEN 0.5 ELSE 1 END END, 11)::DOUBLE AS cost_usd,
  CASE WHEN k IS NULL THEN 'unknown' ELSE 'price_table' END AS cost_source FROM d LEFT JOIN best USING (model)""")
def cost_estimate(spark, sf_dir):
    d = _models(table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("input_tokens"), F.floor(F.col("n_chars") / 2).alias("output_tokens"), (F.col("doc_id") % 10).alias("reasoning_tokens")))
    priced = cost.match_prices(d, cost.price_table(spark, OWN))
    exact = F.round(cost.cost_of(F.col("doc_id") % 2 == 0), 11)
    return priced.select("doc_id", exact.alias("cost_usd"), F.when(F.col("price_key").isNull(), "unknown").otherwise("price_table").alias("cost_source"))


@query(f"""WITH {BASE}, m AS (SELECT stage, mode, sum(input_tokens) AS i, sum(output_tokens + reasoning_tokens) AS o FROM usage GROUP BY stage, mode),
f AS (SELECT stage, sum((i * 0.30::DOUBLE + o * 2.50::DOUBLE) / 1000000 * CASE mode WHEN 'batch' THEN 0.5 ELSE 1.0 END) AS new, sum((i * 0.30::DOUBLE + o * 2.50::DOUBLE) / 1000000) AS flat FROM m GROUP BY stage)
SELECT u.stage, u.language, round((sum(input_tokens) * 0.30::DOUBLE + sum(output_tokens + reasoning_tokens) * 2.50::DOUBLE) / 1000000 * max(f.new / f.flat), 3)::DOUBLE AS cost_usd, round(max(f.new), 3)::DOUBLE AS stage_cost FROM usage u JOIN f USING (stage) GROUP BY u.stage, u.language""")
def reprice_blend(spark, sf_dir):
    u = fixture.usage(spark, sf_dir)
    sums = [F.sum(t).alias(t) for t in cost.TOKENS]
    zero = F.lit(0.0).alias("cost_usd")
    by_mode = u.groupBy("stage", "mode").agg(*sums).select("*", F.lit("gemini-2.5-flash-001").alias("model"), zero)
    groups = u.groupBy("stage", F.col("language").alias("grp")).agg(*sums).select("*", zero)
    stages, parts = cost.reprice(by_mode, groups, cost.price_table(spark))
    return parts.join(stages.select("stage", F.round("cost_usd", 3).alias("stage_cost")), "stage").select("stage", F.col("grp").alias("language"), F.round("cost_usd", 3).alias("cost_usd"), "stage_cost")


@query("""SELECT l_returnflag AS language, l_linestatus AS mode, count(*)::BIGINT AS requests, sum(l_quantity::BIGINT)::BIGINT AS input_tokens, sum((l_discount * 100)::BIGINT)::BIGINT AS output_tokens,
  round(sum(l_extendedprice), 2) AS cost_usd FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""")
def usage_scale(spark, sf_dir):
    """The usage roll-up over the largest table."""
    u = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("language"), F.col("l_linestatus").alias("mode"), F.col("l_quantity").cast("long").alias("i"), F.round(F.col("l_discount") * 100).cast("long").alias("o"), "l_extendedprice")
    out = u.groupingSets([["language", "mode"], ["language"], []], "language", "mode").agg(F.count(F.lit(1)).alias("requests"), F.sum("i").alias("input_tokens"), F.sum("o").alias("output_tokens"), F.round(F.sum("l_extendedprice"), 2).alias("cost_usd"))
    return out.select("language", "mode", "requests", "input_tokens", "output_tokens", "cost_usd")


@query("""SELECT d.lang, count(*)::BIGINT AS n_docs, count(l.quality)::BIGINT AS judged, sum(coalesce(l.quality, 0))::BIGINT AS n_passed, round(sum(l.quality) / count(l.quality), 4)::DOUBLE AS pass_rate
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang""")
def label_pass_rate(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(count("n_docs"), F.count("quality").alias("judged"), F.coalesce(F.sum("quality"), F.lit(0)).cast("long").alias("n_passed"), F.round(F.try_divide(F.sum("quality"), F.count("quality")), 4).alias("pass_rate"))


@query(f"""WITH {BASE} SELECT 'judge' AS stage, round, count(*)::BIGINT AS n FROM judged CROSS JOIN (VALUES (1), (2)) r(round) GROUP BY round
UNION ALL SELECT 'correct', 1, count(*)::BIGINT FROM judged WHERE fixed HAVING count(*) > 0""")
def rounds_seen(spark, sf_dir):
    """The rounds of judgements and corrections that review rows passed through."""
    rows = review.review_rows(review.history(fixture.records(spark, sf_dir)))
    of = lambda c, stage: rows.select(F.explode(c).alias("round")).groupBy("round").agg(F.count(F.lit(1)).alias("n")).join(review.rounds_used(rows, c), "round").select(F.lit(stage).alias("stage"), "round", "n")
    return of("judge_rounds", "judge").unionByName(of("correction_rounds_applied", "correct"))


@query(f"WITH {BASE} SELECT split, count(*)::BIGINT AS n FROM items WHERE split IN ('en', 'fr') GROUP BY split")
def records_in_units(spark, sf_dir):
    units = spark.range(1).select(F.lit("default").alias("dataset_config"), F.explode(F.array(F.lit("en"), F.lit("fr"))).alias("split"))
    return selection.in_units(fixture.items(spark, sf_dir), units).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {BASE} SELECT stage, round, sum((mode = 'batch')::INT)::BIGINT AS n_batch, round(sum(CASE WHEN stage = 'correct'
  THEN round((input_tokens * 1.25 + (output_tokens + reasoning_tokens) * 10.0) / 1000000 * CASE WHEN mode = 'batch' THEN 0.5 ELSE 1 END, 8)::DOUBLE ELSE total_tokens / 1000.0 END), 4) AS cost_usd FROM usage GROUP BY stage, round""")
def usage_as_recorded(spark, sf_dir):
    """Recorded costs, and those of a stage that cost nothing so far from its tokens and the model's prices."""
    u = fixture.usage(spark, sf_dir).withColumn("model", F.lit("gemini-2.5-pro-001")).withColumn("cost_usd", F.when(F.col("stage") == "correct", 0.0).otherwise(F.col("cost_usd")))
    u = cost.repriced(u, cost.price_table(spark), "gaps")
    return u.groupBy("stage", "round").agg(F.count_if(F.col("mode") == "batch").cast("long").alias("n_batch"), F.round(exact_sum("cost_usd"), 4).alias("cost_usd"))