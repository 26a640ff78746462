"""Routing of results to requests, and decoding of prediction lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.hashing import prompt_hash
from lexiloom.operators.identity import row_index


def join_results(requests: DataFrame, results: DataFrame, order: str) -> DataFrame:
    """Each request with its result: the last by `order` of several, else an error."""
    last = results.groupBy("key").agg(F.max_by(F.struct("text", "error"), order).alias("r"))
    out = requests.join(last, "key", "left").withColumns({"text": F.col("r.text"), "error": F.when(F.col("r").isNull(), "no result returned by backend").otherwise(F.col("r.error"))})
    return out.withColumn("ok", F.col("error").isNull() & F.coalesce(F.trim("text") != "", F.lit(False))).drop("r")


def match_by_prompt(requests: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prediction lines to requests of the same prompt, the n-th line to the n-th request; and the lines left over.

    `requests` has key, prompt, ordinal; `lines` has prompt, position and columns
    of its own.  Ranks are taken within a prompt's hash, in sorted partitions, so a
    prompt that many share is in no single task.
    """
    hashed = prompt_hash(F.col("prompt")).alias("_h")
    return match_by_hash(requests.select("key", "ordinal", hashed), lines.select("*", hashed))


def match_by_hash(requests: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same from the prompts' hashes `_h`; requests are moved without their prompts."""
    ranked = lambda df, order: row_index(df, [order], ["_h"], "_n")
    r, p = ranked(requests.select("key", "ordinal", "_h"), "ordinal").select("key", "_h", "_n"), ranked(lines, "position")
    return p.join(r, ["_h", "_n"]).drop("_h", "_n"), p.join(r, ["_h", "_n"], "left_anti").drop("_h", "_n")


def echoed_prompt(line: Column) -> Column:
    """The prompt that a prediction line repeats: its text parts joined."""
    contents = F.from_json(F.get_json_object(line, "$.request.contents"), "array<struct<parts: array<struct<text: string>>>>")
    parts = F.filter(F.flatten(F.transform(contents, lambda c: F.coalesce(c["parts"], F.array().cast("array<struct<text: string>>")))), lambda p: p.isNotNull())
    text = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")
    return F.when(text != "", text)


def response_object(line: Column) -> Column:
    """The response of a line as JSON of its own, which is short; null if there is none, or if it could be a string that looks like an object."""
    response = F.get_json_object(line, "$.response")
    plain = line.rlike(r'"response"\s*:\s*\{') & ~line.rlike(r'"response"\s*:\s*"')  # quotes within strings are escaped
    return F.when(plain & response.startswith("{"), response)


def _of_response(line: Column, path: str, response: Column | None = None) -> Column:
    """What a line's response has at a path; read from `response` where that is not null."""
    whole = F.get_json_object(line, f"$.response{path}")
    return whole if response is None else F.when(response.isNotNull(), F.get_json_object(response, f"${path}")).otherwise(whole)


def answer_text(line: Column, response: Column | None = None) -> Column:
    """The parts of the first candidate other than thoughts; null without text."""
    parts = F.from_json(_of_response(line, ".candidates[0].content.parts", response), "array<struct<text: string, thought: boolean>>")
    spoken = F.filter(parts, lambda p: ~F.coalesce(p["thought"], F.lit(False)) & (F.coalesce(p["text"], F.lit("")) != ""))
    return F.when(F.size(spoken) > 0, F.array_join(F.transform(spoken, lambda p: p["text"]), ""))


def usage_of(line: Column, response: Column | None = None) -> Column:
    """struct of token counts, under camelCase or snake_case names; the total falls back to the sum."""
    of = lambda path: _of_response(line, path, response)
    count = lambda camel, snake: F.coalesce(F.coalesce(of(f".usageMetadata.{camel}"), of(f".usage_metadata.{snake}")).try_cast("long"), F.lit(0).cast("long"))
    i, o, r = count("promptTokenCount", "prompt_token_count"), count("candidatesTokenCount", "candidates_token_count"), count("thoughtsTokenCount", "thoughts_token_count")
    t = count("totalTokenCount", "total_token_count")
    return F.struct(i.alias("input_tokens"), o.alias("output_tokens"), r.alias("reasoning_tokens"), F.when(t != 0, t).otherwise(i + o + r).alias("total_tokens"))


def decode_line(line: Column, response: Column | None = None) -> Column:
    """struct(text, error, finish_reason, model_version, usage): status, then error, then a missing response, then an empty one.

    With a column of the line's `response_object` the long line is parsed for that
    and not for every value.
    """
    status, failed = F.get_json_object(line, "$.status"), F.get_json_object(line, "$.error")
    of = lambda path: _of_response(line, path, response)
    finish = F.when(of(".candidates[0]").isNull(), "NO_CANDIDATES").otherwise(F.coalesce(of(".candidates[0].finishReason"), of(".candidates[0].finish_reason")))
    text = answer_text(line, response)
    error = (
        F.when(F.coalesce(status, F.lit("")) != "", F.concat(F.lit("batch error: "), F.substring(status, 1, 500)))
        .when(failed.isNotNull(), F.concat(F.lit("batch error: "), F.substring(failed, 1, 500)))
        .when(F.coalesce(of(""), F.lit("{}")) == "{}", "batch line has no 'response'")
        .when(text.isNull(), F.concat(F.lit("empty response (finishReason="), F.coalesce(finish, F.lit("None")), F.lit(")")))
    )
    return F.struct(F.when(error.isNull(), text).alias("text"), error.alias("error"), finish.alias("finish_reason"), F.coalesce(of(".modelVersion"), of(".model_version")).alias("model_version"), usage_of(line, response).alias("usage"))


def encode_request(prompt: Column, temperature: float = 0.2, max_output_tokens: int | None = None, json_mode: bool = True, thinking_budget: int | None = None) -> Column:
    """One line of a batch input file; only the request, the key stays here."""
    config = [F.lit(temperature).alias("temperature")]
    if max_output_tokens:
        config.append(F.lit(max_output_tokens).alias("maxOutputTokens"))
    if json_mode:
        config.append(F.lit("application/json").alias("responseMimeType"))
    if thinking_budget is not None:
        config.append(F.struct(F.lit(thinking_budget).alias("thinkingBudget"), F.lit(False).alias("includeThoughts")).alias("thinkingConfig"))
    contents = F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(prompt.alias("text"))).alias("parts")))
    return F.to_json(F.struct(F.struct(contents.alias("contents"), F.struct(*config).alias("generationConfig")).alias("request")))


def interactive_usage(prompt: Column, completion: Column, reasoning: Column) -> Column:
    """Counts of an interactive call, whose completion count includes the reasoning."""
    i, r = F.coalesce(prompt, F.lit(0)), F.coalesce(reasoning, F.lit(0))
    o = F.greatest(F.coalesce(completion, F.lit(0)) - r, F.lit(0))
    return F.struct(i.alias("input_tokens"), o.alias("output_tokens"), r.alias("reasoning_tokens"), (i + o + r).alias("total_tokens"))
