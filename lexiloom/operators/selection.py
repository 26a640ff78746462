"""Which records a stage works on; newest and best of several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(translation: str = "translation") -> Column:
    """Valid, with a non-empty translation."""
    return F.coalesce(F.col("valid") & F.col(translation).isNotNull() & (F.col(translation).cast("string") != ""), F.lit(False))


def for_judging(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable records, and the skipped rest."""
    return records.where(usable()), records.where(~usable())


def for_correction(judged: DataFrame, max_score: float | None = None) -> DataFrame:
    """Usable judgements that failed; with a bound, those that score at most that (0 is a bound)."""
    wanted = F.col("score") <= max_score if max_score is not None else ~F.col("passed")
    return judged.where(usable() & F.coalesce(wanted, F.lit(False)))


def newest_usable(records: DataFrame, stages: tuple[str, ...] = ("translate", "correct")) -> DataFrame:
    """For each record_id the usable record of the latest stage and round; of equals the one read last (`position`)."""
    rank = F.coalesce(*[F.when(F.col("stage") == s, F.lit(i)) for i, s in enumerate(stages)], F.lit(-1))
    best = F.max_by(F.struct(*[c for c in records.columns if c != "record_id"]), F.struct(rank.alias("stage"), F.col("round"), F.col("position")))
    return records.where(usable()).groupBy("record_id").agg(best.alias("r")).select("record_id", "r.*")


def newest(records: DataFrame) -> DataFrame:
    """For each record_id the record of the highest round; of equals the one read first."""
    best = F.max_by(F.struct(*[c for c in records.columns if c != "record_id"]), F.struct(F.col("round"), -F.col("position")))
    return records.where(F.col("record_id").isNotNull()).groupBy("record_id").agg(best.alias("r")).select("record_id", "r.*")


def best_judgement(judged: DataFrame) -> DataFrame:
    """For each record_id the judgement of the highest score, the later round of equals; unscored ones do not count."""
    best = F.max_by(F.struct(*[c for c in judged.columns if c != "record_id"]), F.struct("score", "round"))
    return judged.where("score IS NOT NULL").groupBy("record_id").agg(best.alias("r")).select("record_id", "r.*")


def judged_versions(judged: DataFrame, versions: DataFrame) -> DataFrame:
    """Each judgement with the translation it was passed on, by the stage and round that it recorded; null if that is gone."""
    v = versions.select("record_id", F.col("stage").alias("translation_stage"), F.col("round").alias("translation_round"), F.col("translation").alias("judged_translation"))
    return judged.join(v, ["record_id", "translation_stage", "translation_round"], "left")


def next_rounds(rounds: DataFrame) -> DataFrame:
    """The next free rounds, from (stage, round): a judgement's round is above that of the correction it judges."""
    c = F.coalesce(F.max(F.when(F.col("stage") == "correct", F.col("round"))), F.lit(0)) + 1
    j = F.greatest(F.coalesce(F.max(F.when(F.col("stage") == "judge", F.col("round"))), F.lit(0)), c) + 1
    return rounds.agg(c.cast("long").alias("correct_round"), j.cast("long").alias("judge_round"))


STALE, CORRECTED = "correction_never_judged", "already_corrected"


def recorrect_plan(judged: DataFrame, corrections: DataFrame, threshold: float, again: bool = False) -> DataFrame:
    """Newest judgements below `threshold` with the decision on each: selected, STALE or CORRECTED.

    A judgement is stale if the newest correction is not the version it was
    passed on.  With `again`, corrected ones are selected too.
    """
    latest = newest(judged).where(usable() & (F.col("score") < threshold))
    fixed = newest(corrections).select("record_id", F.col("round").alias("correct_round"))
    both = latest.join(fixed, "record_id", "left")
    stale = F.coalesce(F.col("translation_stage"), F.lit("")).eqNullSafe("correct") & (F.coalesce("translation_round", F.lit(0)) >= F.col("correct_round"))
    decision = F.when(F.col("correct_round").isNull(), "selected").when(~stale, STALE).otherwise("selected" if again else CORRECTED)
    return both.withColumn("decision", decision)


def in_units(records: DataFrame, units: DataFrame) -> DataFrame:
    return records.join(units.select("dataset_config", "split").distinct(), ["dataset_config", "split"], "left_semi")
