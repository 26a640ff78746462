"""Column functions against plain Python."""

import hashlib
import html
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions import contracts, hashing, judgement, parse, template, text, validate


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


TEXTS = ["", " a ", "\t\n x  ", "x\x1c", "　日本　", "```json\n{}\n```", None]


def test_strip(spark):
    assert apply(spark, TEXTS, text.strip) == [None if t is None else t.strip() for t in TEXTS]


def test_fences(spark):
    cases = ["```json\n{\"a\":1}\n```", "```\nx\n```", "pre ```x``` post", "  plain ", "```json\na\n```\nrest"]
    assert apply(spark, cases, text.strip_fences) == ['{"a":1}', "x", "pre ```x``` post", "plain", "```json\na\n```\nrest"]


def test_uuid5_and_sample(spark):
    ids = ["a", "ü|1", "日本"]
    assert apply(spark, ids, hashing.uuid5) == [str(uuid.uuid5(hashing.NAMESPACE, i)) for i in ids]
    want = [int(hashlib.sha256(f"s|{i}".encode()).hexdigest()[:8], 16) / 2**32 for i in ids]
    assert apply(spark, ids, lambda c: hashing.sample_fraction("s", c)) == want


def test_unescape(spark):
    cases = ["&lt;b&gt; &eacute; &amp;lt;", None, "&#x41;"]
    assert apply(spark, cases, text.unescape) == [None if c is None else html.unescape(c) for c in cases]


def test_tags(spark):
    page = "<p>One <b>two</b><br>three</p><ul><li>a</li><li>b</li></ul><script>x()</script>&amp;lt;"
    assert apply(spark, [page], text.strip_tags) == ["One two\nthree\n\n- a\n\n- b\n\n&lt;"]


def test_render_is_one_pass(spark):
    out = apply(spark, ["{b} {\"x\": 1}"], lambda c: template.render("{a}|{b}|{c}|{\"k\"}", {"a": c, "b": F.lit("B")}))
    assert out == ['{b} {"x": 1}|B|{c}|{"k"}']
    assert template.unfilled("{a} {z} {b}", {"a", "b"}) == ["z"]


@pytest.mark.parametrize("column", ["native", "python"])
def test_json_object(spark, column):
    cases = ['{"a": 1}', '```json\n{"a": 1}\n```', 'Sure: {"a": 1} done', "[1]", '[{"a": 1}]', "no", "", None, '{"a": ', '{"a": "```x```"}']
    f = parse.json_object if column == "native" else parse.json_object_python
    got = apply(spark, cases, f)
    values = [json.loads(g["value"]) if g["value"] else None for g in got]
    assert values == [{"a": 1}] * 3 + [None] * 6 + [{"a": "```x```"}]
    assert [g["error"] for g in got] == [None] * 3 + ["expected a JSON object"] * 2 + ["no JSON object found in response"] + ["empty response"] * 2 + ["no JSON object found in response", None]


def test_sections(spark):
    got = apply(spark, ["x\n### a\n1\n#### no\n### b\n```\ncode\n```\n### a\nlast", "none", None], parse.sections)
    assert got == [{"b": "code", "a": "last"}, {}, {}]


KIND = T.StructType([T.StructField("q", T.StringType()), T.StructField("c", T.ArrayType(T.StringType()))])


@pytest.mark.parametrize(
    "parsed, error",
    [
        ({"q": "x", "c": ["a", "b"]}, None),
        ({"q": 3, "c": '["a", "b"]'}, None),
        ({"c": ["a", "b"]}, "missing field 'q'"),
        ({"q": " ", "c": ["a", "b"]}, "field 'q': empty translation"),
        ({"q": ["x"], "c": ["a", "b"]}, "field 'q': expected a string"),
        ({"q": "x", "c": ["a"]}, "field 'c': expected 2 items, got 1"),
        ({"q": "x", "c": ["a", " "]}, "field 'c': list contains an empty item"),
        ({"q": "x", "c": "b"}, "field 'c': expected a list"),
        ({"q": "x\x08", "c": ["a", "b"]}, "field 'q': control character"),
        ({"q": "x\ty", "c": ["a", "b"]}, "field 'q': more tabs than the source"),
    ],
)
def test_validation(spark, parsed, error):
    source = F.struct(F.lit("question").alias("q"), F.array(F.lit("a"), F.lit("b")).alias("c"))
    assert apply(spark, [json.dumps(parsed)], lambda c: validate.translation_error(c, source, KIND)) == [error]


@pytest.mark.parametrize(
    "parsed, want",
    [
        ({"score": 8, "feedback": "ok"}, (8.0, True, "ok", None)),
        ({"score": 5, "feedback": "bad"}, (5.0, False, "bad", None)),
        ({"rating": "9", "verdict": "FAIL", "issues": ["x"]}, (9.0, False, '["x"]', None)),
        ({"score": 9, "verdict": "NEEDS_REVIEW", "result": "no", "reason": "r"}, (9.0, False, "r", None)),
        ({"score": True, "pass": True}, (1.0, True, "", None)),
        ({"score": 1}, (None, None, None, "a failed verdict needs feedback")),
        ({"score": "x", "rating": 3}, (None, None, None, "field 'score': not a number")),
        ({"score": 11}, (None, None, None, "score is not within 0 to 10")),
        ({"verdict": "yes"}, (None, None, None, "missing a score field")),
    ],
)
def test_judgement(spark, parsed, want):
    assert tuple(apply(spark, [json.dumps(parsed)], lambda c: judgement.judgement(c, 7.0))[0]) == want


def test_contracts(spark):
    row = spark.range(1).select(
        contracts.extractive(F.lit("a b c"), F.array(F.lit("b"), F.lit("c"))).alias("a"), contracts.same_lines(F.lit("x\n#### 5"), F.lit("y\n#### 5")).alias("b"), contracts.same_lines(F.lit("x\n#### 5"), F.lit("y\n#### 6")).alias("c"),
        contracts.options_kept(F.lit("(A)(B)(C)(D)")).alias("d"), contracts.one_blank(F.lit("a _ b _")).alias("e"), contracts.answer_offset(F.lit("abc"), F.lit("c")).alias("f"),
    ).first()
    assert tuple(row) == (True, True, False, True, False, 2)
