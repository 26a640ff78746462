"""Fill-in-middle against brute force."""

import hashlib
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexiloom.llm import infill

ROWS = "doc_id long, text string, n string, places string, same string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], ROWS).repartition(3)


def brute(doc_id, text, unit=None, plain=10, spm=20):
    text = text or ""
    units = list(text) if unit is None else re.findall(unit, text, re.S)
    assert "".join(units) == text
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in infill.MARKS) or h[2] % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LONG = "wörter 日本 🙂🙂\r\n" * 3000
TEXTS = [None, "", "a", "ab", "🙂", "🙂a", "\n", "has <P> in it", "<M>", "<", "<S", LONG, LONG[:4096], LONG[:4097], LONG[:8192], "x" * 4096, " lead and tail "]


def cases():
    return [(i, t) for i, t in enumerate(TEXTS * 6)] + [(1, "again"), (1, "again"), (1, "other"), (None, "no id"), (None, "no id"), (None, None)]


@pytest.mark.parametrize("unit", [None, r"\s*\S+|\s+", "[^\n]*\n|[^\n]+"])
def test_against_brute_force(spark, unit):
    got = infill.fill_in_middle(frame(spark, cases()), unit).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((brute(i, t, unit) for i, t in cases()), key=repr)
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in cases())
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_a_hot_row(spark):
    """A third of all rows are one row, which the join deals out."""
    rows = [(7, "the same text")] * 300 + [(i, f"text {i}") for i in range(600)]
    got = infill.fill_in_middle(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got if r["form"] == "psm") == sorted(x for x in (brute(i, t) for i, t in rows) if x[2] == "psm") and len(got) == 900


def test_rates_and_gaps(spark):
    rows = frame(spark, [(i, f"text {i}") for i in range(200)])
    assert {r["form"] for r in infill.fill_in_middle(rows, plain_percent=0, spm_percent=100).collect()} == {"spm"}
    assert {r["form"] for r in infill.fill_in_middle(rows, plain_percent=100).collect()} == {"plain"}
    with pytest.raises(PySparkException, match="do not cover"):
        infill.fill_in_middle(rows, "[a-z]+").collect()
    assert infill.fill_in_middle(spark.createDataFrame([], ROWS)).count() == 0
