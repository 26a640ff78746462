"""Parsing of model output."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.text import let, strip, strip_fences


def _is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def json_object(text: Column) -> Column:
    """struct(value, error): the JSON object of a response, as text.

    The response is tried as it is, then without a fence around it, then from its
    first `{` to its last `}`.  What parses to other than an object is an error.
    Unlike Python's parser, Spark's rejects repeated keys and NaN.
    """

    def span(bare: Column) -> Column:
        first, back = F.instr(bare, "{"), F.instr(F.reverse(bare), "}")
        last = F.length(bare) - back + 1
        return F.when((first > 0) & (back > 0) & (last > first), F.substring(bare, first, last - first + 1))

    def outcome(raw: Column, inner: Column, value: Column) -> Column:
        error = (
            F.when(raw.isNull() | (raw == ""), "empty response")
            .when(value.isNull() & inner.isNull(), "no JSON object found in response")
            .when(value.isNull(), "invalid JSON")
            .when(F.substring(value, 1, 1) != "{", "expected a JSON object")
        )
        return let(error, lambda e: F.struct(F.when(e.isNull(), value).alias("value"), e.alias("error")))

    def tried(raw: Column) -> Column:
        rest = lambda bare: let(span(bare), lambda inner: let(F.when((bare != raw) & _is_json(bare), bare).when(_is_json(inner), inner), lambda v: outcome(raw, inner, v)))
        return F.when(_is_json(raw), outcome(raw, raw, raw)).otherwise(let(strip_fences(raw), rest))

    stripped = lambda t: F.when(F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}")), t).otherwise(strip(t))  # noqa: E731  an object alone needs no search for white space
    return let(text, lambda t: let(stripped(t), tried))


def sections(text: Column) -> Column:
    """`### key` blocks as map<key, text>: up to the next heading, stripped, a fence around it removed; the last of equal keys wins."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?m)^(?=###(?!#)\s*.)"), lambda p: p.rlike(r"\A###(?!#)\s*."))

    def entry(p: Column) -> Column:
        body = strip(F.regexp_replace(p, r"\A###(?!#)\s*.+", ""))
        return F.struct(strip(F.regexp_extract(p, r"\A###(?!#)\s*(.+)", 1)).alias("key"), F.when(F.startswith(body, F.lit("```")), strip_fences(body)).otherwise(body).alias("value"))

    entries = F.transform(parts, entry)
    later = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: ~later(e, i)))


def _strict(text: str | None) -> tuple[str | None, str | None]:
    if text is None or not text.strip():
        return None, "empty response"
    bare = text.strip()
    if bare.startswith("```") and bare.endswith("```") and len(bare) >= 6:
        inner = bare[3:-3]
        bare = (inner[4:] if inner[:4] in ("json", "JSON") else inner).strip()
    span = bare[bare.find("{") : bare.rfind("}") + 1] if "{" in bare else ""
    error = "no JSON object found in response"
    for candidate in (text.strip(), bare, span):
        try:
            value = json.loads(candidate)
        except json.JSONDecodeError:
            if candidate is span and span:
                error = "invalid JSON"
            continue
        return (json.dumps(value, ensure_ascii=False), None) if isinstance(value, dict) else (None, "expected a JSON object")
    return None, error


@F.pandas_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())]))
def json_object_python(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """json_object with Python's parser: repeated keys (the last wins) and NaN are read."""
    for s in texts:
        yield pd.DataFrame([_strict(None if pd.isna(x) else x) for x in s], columns=["value", "error"])


def has_key(json_text: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(json_text), key), F.lit(False))


def member(json_text: Column, key: str) -> Column:
    """The VARIANT of one member of an object; null if absent."""
    name = key.replace("'", "\\'")
    return F.try_variant_get(F.try_parse_json(json_text), f"$['{name}']", "variant")


def kind_of(value: Column) -> Column:
    """One of string, number, boolean, array, object, null; SQL null if absent."""

    def of(name: Column) -> Column:
        return F.when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object").when(name == "VOID", "null").when(name.isNotNull(), "number")

    return let(F.schema_of_variant(value), of)
