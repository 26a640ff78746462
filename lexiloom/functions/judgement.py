"""Normalisation of judge responses to score, verdict and feedback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.parse import kind_of
from lexiloom.functions.text import let, strip

# The spellings that judge prompts use.
SCORE_KEYS = ("score", "quality_score", "rating", "translation_score", "overall_score")
VERDICT_KEYS = ("pass", "passed", "verdict", "result", "status")
FEEDBACK_KEYS = ("feedback", "reasoning", "explanation", "reason", "summary", "analysis_cot", "analysis", "comments", "critique", "error_analysis", "issues")
YES = ("pass", "passed", "true", "yes", "ok", "accept", "accepted", "correct")
NO = ("fail", "failed", "false", "no", "reject", "rejected", "incorrect")


def as_verdict(word: Column) -> Column:
    """True or false for a word of YES or NO; null for others."""
    word = F.lower(strip(word))
    return F.when(word.isin(*YES), True).when(word.isin(*NO), False)


def judgement(parsed: Column, threshold: float, scale: float = 10.0) -> Column:
    """struct(score, passed, feedback, error) of a JSON object.

    The first present score key counts, even if its value is not a number.  The
    first verdict key that is a boolean or a known word counts, else score >=
    threshold.  A failed judgement must have feedback.  With an error the other
    fields are null.
    """
    return let(F.struct(F.try_parse_json(parsed).alias("v"), F.coalesce(F.json_object_keys(parsed), F.array().cast("array<string>")).alias("keys")), lambda p: _normal(p["v"], p["keys"], parsed, threshold, scale))


def _first(keys: tuple[str, ...], given: Column) -> Column:
    """The first of `keys` that is given."""
    return F.get(F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.array_contains(given, k)), F.lit(0))


def _normal(v: Column, given: Column, parsed: Column, threshold: float, scale: float) -> Column:
    part = lambda k: F.try_variant_get(v, f"$['{k}']", "variant")
    told = lambda x: F.struct(kind_of(x).alias("kind"), F.try_variant_get(x, "$", "string").alias("text"), F.to_json(x).alias("json"))
    parts = lambda keys: F.transform(F.array(*[part(k) for k in keys]), told)

    score = F.coalesce(*[F.when(_first(SCORE_KEYS, given) == k, F.get_json_object(parsed, f"$.{k}")) for k in SCORE_KEYS])
    number = let(score, lambda x: F.when(x.isin("true", "false"), (x == "true").cast("double")).otherwise(strip(x).try_cast("double")))
    verdicts = F.transform(parts(VERDICT_KEYS), lambda x: F.when(x["kind"].isin("boolean", "string"), as_verdict(x["text"])))
    verdict = F.get(F.filter(verdicts, lambda x: x.isNotNull()), F.lit(0))
    full = F.filter(parts(FEEDBACK_KEYS), lambda x: x["kind"].isNotNull() & (x["kind"] != "null") & ~x["json"].isin('""', "false", "0", "0.0", "[]", "{}"))
    feedback = F.get(F.transform(full, lambda x: F.when(x["kind"] == "string", x["text"]).otherwise(x["json"])), F.lit(0))

    def outcome(n: Column, passed: Column, why: Column, key: Column) -> Column:
        error = F.when(parsed.isNull(), "no JSON object").when(key.isNull(), "missing a score field").when(n.isNull(), F.concat(F.lit("field '"), key, F.lit("': not a number")))
        if scale:
            error = error.when(~n.between(0, scale), f"score is not within 0 to {scale:g}")
        error = error.when(~passed & (why == ""), "a failed verdict needs feedback")
        pick = lambda e, x: F.when(e.isNull(), x)
        return let(error, lambda e: F.struct(pick(e, n).alias("score"), pick(e, passed).alias("passed"), pick(e, why).alias("feedback"), e.alias("error")))

    found = F.struct(number.alias("n"), verdict.alias("verdict"), F.coalesce(feedback, F.lit("")).alias("why"), _first(SCORE_KEYS, given).alias("key"))
    return let(found, lambda f: outcome(f["n"], F.coalesce(f["verdict"], f["n"] >= threshold), f["why"], f["key"]))


def audit_payload(parsed: Column, score: Column, passed: Column, feedback: Column) -> Column:
    """What a corrector is told of a judgement, as JSON: all of it where it was an object with members, else score, pass and reasoning."""
    plain = F.to_json(F.struct(score.alias("score"), passed.alias("pass"), F.coalesce(feedback, F.lit("")).alias("reasoning")), {"ignoreNullFields": "false"})
    return F.when(F.size(F.coalesce(F.json_object_keys(parsed), F.array().cast("array<string>"))) > 0, parsed).otherwise(plain)


def audit_errors(audit: Column) -> Column:
    """The list of findings in an audit, as JSON; empty if there is none."""
    return F.coalesce(F.get_json_object(audit, "$.error_analysis"), F.lit("[]"))
