"""As-of joins, page records, passages, canonical JSON, exact sums, verification in order, line numbers."""

import datetime
import decimal
import json
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.canonical import canonical_row
from lexiloom.functions.exact import exact_mean, exact_sum
from lexiloom.functions.text import strip_tags
from lexiloom.operators import identity
from lexiloom.operators.asof import asof_join
from lexiloom.operators.passages import held_passages, shards
from lexiloom.operators.records import page_records, pieces, spans
from lexiloom.sources import readers, writers


def test_asof_join_against_brute_force(spark):
    """One key has most rows, times repeat, keys and times may be null."""
    rng = random.Random(3)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    time = lambda: rng.choice([None, *range(40)])
    left = [(i, key(), time()) for i in range(400)]
    right = [(key(), time(), rng.randrange(100)) for _ in range(300)]
    a = spark.createDataFrame(left, "id int, k int, t int").repartition(7)
    b = spark.createDataFrame(right, "k int, u int, v int").repartition(5)
    got = {r["id"]: (r["u"], r["v"]) for r in asof_join(a, b, ["k"], "t", "u").collect()}
    for i, k, t in left:
        fits = [(u, v) for k2, u, v in right if None not in (k, t, u) and k2 == k and u <= t]
        assert got[i] == (max(fits) if fits else (None, None)), (i, k, t)
    assert len(got) == 400 and asof_join(a, b.limit(0), ["k"], "t", "u").where("u IS NULL").count() == 400 and asof_join(a.limit(0), b, ["k"], "t", "u").count() == 0
    with pytest.raises(ValueError, match="rename"):
        asof_join(a, b.withColumnRenamed("v", "id"), ["k"], "t", "u")


SCROLL = '<div style="display: block;" class="problem-content-scroll w">'


def page(*problems, tier=1):
    titles = [f'<h3 class="display-4 ">{t}</h3>'.replace("4 ", "4") + "".join(f"{SCROLL}{p}</div>" for p in panels) for t, panels in problems]
    return f'<h2 id="tier-{tier}" class="a">Tier</h2>' + "".join(titles)


def test_page_records(spark):
    nested = '<p>Let <div class="eq"><div>\\(x\\)</div></div> be.</p>'
    solved = "<p><strong>Answer</strong>: <b>7</b>.</p><p>Because <div>of it</div>.</p>"
    marked = "<p><strong>Answer:</strong> a<p>b</p><strong>Solution:</strong> work</p>"
    html = "<div><h3 class=\"display-4\">none</h3></div>" + page(("A &amp; <i>B</i>", [nested, solved, "third"]), ("a b", ["p2", marked])) + page(("Last", ["p3", "no mark"]), tier=3)
    rows = spark.createDataFrame([(1, html), (2, page(("A / B", ["q", solved]))), (3, None), (4, "plain")], "page_id int, html string")
    got = {r["id"]: r for r in page_records(rows, "page_id", "html", prefix="x").collect()}
    assert set(got) == {"x-tier1-a-b", "x-tier1-a-b-2", "x-tier1-a-b-3", "x-tier3-last"}
    first = got["x-tier1-a-b"]
    assert (first["title"], first["problem"], first["answer"], first["solution"]) == ("A & B", "Let \\(x\\)\n\nbe.", "7", "Because of it\n\n.")
    assert (got["x-tier1-a-b-2"]["answer"], got["x-tier1-a-b-2"]["solution"]) == ("a\n\nb", "work") or got["x-tier1-a-b-2"]["answer"].replace("\n", "") == "ab"
    assert (got["x-tier3-last"]["answer"], got["x-tier3-last"]["solution"], got["x-tier3-last"]["tier"]) == ("", "no mark", 3)
    for bad, what in ((page(("t", ["only one"])), "no panel 2 of 2"), (page(("t", ["a", "b"]))[: -len("</div>")], "never closes")):
        with pytest.raises(PySparkException, match=what):
            page_records(spark.createDataFrame([(1, bad)], "page_id int, html string"), "page_id", "html").collect()


def test_spans_are_balanced(spark):
    html = "<div>a<div>b</div><div><div>c</div></div></div></div><div>open<div>x</div>"
    got = spans(pieces(spark.createDataFrame([(1, html)], "k int, h string"), "k", "h"), "k", "div").orderBy("place").collect()
    inner = [html[r["open_end"] : r["close_start"]] if r["close_start"] else None for r in got]
    assert inner == ["a<div>b</div><div><div>c</div></div>", "b", "<div>c</div>", "c", None, "x"]


def test_tags_in_code(spark):
    html = '<p>See</p>  <pre class="x" data-language="py"><code><span class="line"><span>a = 1</span></span>\n<span class="line"><span>b &lt; 2</span></span></code></pre><ul><li>one</li> <li>two</li></ul>x<br/>y<!-- no --><script>if (a < b) {}</script> 1 < 2'
    assert spark.createDataFrame([(html,)], "h string").select(strip_tags(F.col("h"))).first()[0] == "See\n\n```py\na = 1\nb < 2\n```\n\n- one\n\n- two\n\nx\ny 1 < 2"


def test_passages_against_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("ab é\n") for _ in range(n))
    docs = [(i, text(rng.randrange(0, 400))) for i in range(120)] + [(200, None), (201, ""), (0, "b" * 50)]
    parts = [(i, (d := rng.choice(docs[:120])[1])[(a := rng.randrange(len(d) + 1)) : a + rng.choice([0, 1, 3, 31, 32, 33, 90])]) for i in range(80)] + [(300, None), (301, "zz"), (1, "a")]
    d, p = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(parts, "item_id long, text string")
    want = {(i, k, t.find(s)) for i, s in parts for k, t in docs if s is not None and t is not None and s in t}
    for size in (4_000_000, 200):
        found = [tuple(r) for r in held_passages(d, p, size).collect()]
        assert {(i, k) for i, k, _ in found} == {(i, k) for i, k, _ in want} and set(found) >= {w for w in want if w[:2] != (1, 0)} - {w for w in want if w[0] == 1}
    assert len(shards(p.where("text IS NOT NULL"), 200)) > 3 and held_passages(d, p.limit(0)).isEmpty()


NESTED = T.StructType(
    [
        T.StructField("z", T.StringType()), T.StructField("a", T.ArrayType(T.DoubleType())), T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        T.StructField("s", T.StructType([T.StructField("y", T.BooleanType()), T.StructField("b", T.ArrayType(T.StructType([T.StructField("q", T.StringType()), T.StructField("c", T.DoubleType())])))])),
        T.StructField("d", T.DateType()), T.StructField("t", T.TimestampNTZType()), T.StructField("n", T.DecimalType(10, 2)), T.StructField("i", T.IntegerType()),
    ]
)


def test_canonical_json_is_pythons(spark):
    rng = random.Random(7)
    double = lambda: rng.choice([0.0, -0.0, 1.0, 0.1, 1e16, 1e15, 123456789.125, 1e-4, 9.9e-5, 5e-324, 1.7976931348623157e308, 2**-44, 1e23, -2.5, rng.uniform(-1, 1), rng.uniform(-1e20, 1e20), 10 ** rng.uniform(-300, 300), float(rng.randrange(10**17)), math.inf, math.nan])
    text = lambda: "".join(rng.choice('a"\\\n\t\r\b\f\x01\x1f\x7fé€😀/ ') for _ in range(rng.randrange(6)))
    maybe = lambda x: None if rng.random() < 0.15 else x

    def row():
        inner = maybe([maybe({"q": maybe(text()), "c": maybe(double())}) for _ in range(rng.randrange(3))])
        return {
            "z": maybe(text()), "a": maybe([maybe(double()) for _ in range(rng.randrange(4))]), "m": maybe({text() + str(k): maybe(k) for k in range(rng.randrange(4))}), "s": maybe({"y": maybe(True), "b": inner}),
            "d": maybe(datetime.date(2024, 2, rng.randrange(1, 28))), "t": maybe(datetime.datetime(2024, 1, 2, 3, 4, 5, rng.choice([0, 120000, 7]))), "n": maybe(decimal.Decimal("12.50")), "i": maybe(rng.randrange(-5, 5)),
        }

    rows = [row() for _ in range(300)]
    got = [r[0] for r in spark.createDataFrame(rows, NESTED).coalesce(1).select(canonical_row(NESTED)).collect()]
    assert got == [json.dumps(r, sort_keys=True, ensure_ascii=False, default=str) for r in rows]
    with pytest.raises(TypeError, match="binary"):
        canonical_row(T.StructType([T.StructField("b", T.BinaryType())]))


def test_sums_do_not_depend_on_partitions(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), round(rng.uniform(0, 1e7), 8) if rng.random() < 0.5 else 0.00000001) for _ in range(5000)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    seen = {tuple(tuple(r) for r in df.repartition(n).groupBy("k").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).orderBy("k").collect()) for n in (1, 7, 200)}
    assert len(seen) == 1
    for k, total, mean in seen.pop():
        exact = sum(decimal.Decimal(repr(x)) for key, x in rows if key == k and x is not None)
        assert total == float(exact) and mean == pytest.approx(total / sum(key == k and x is not None for key, x in rows))
    assert df.where("x IS NULL").agg(exact_sum("x"), exact_mean("x")).first()[:] == (None, None)


def test_two_swapped_rows_are_found(spark):
    rows = [(i, "ab"[i % 2], f"text {i // 6}") for i in range(40)]
    a = spark.createDataFrame(rows, "i int, v string, t string").repartition(5)
    check = lambda b: {r["value"]: (r["first_at"], r["n_differ"], r["n_missing"], r["n_extra"]) for r in writers.verify_order(a, b, "v", ["t"], ["i"], ["i"]).collect()}
    assert check(a.repartition(3)) == {}
    swapped = {4: 10, 10: 4}  # both of value a, with other texts
    b = a.withColumn("i", F.coalesce(*[F.when(F.col("i") == x, y) for x, y in swapped.items()], F.col("i")))
    assert check(b) == {"a": (2, 2, 0, 0)} and writers.verify_split(a, b, "v", ["t"]).isEmpty()
    assert check(a.where("i <> 39")) == {"b": (19, 1, 1, 0)}
    assert check(a.unionByName(spark.createDataFrame([(41, None, "new")], a.schema))) == {None: (0, 1, 0, 1)}


def test_line_numbers_over_splits(spark, tmp_path):
    lines = ["" if i % 50 == 7 else "{bad" if i % 97 == 5 else json.dumps({"i": i, "t": "x" * (i % 30)}) for i in range(3000)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text('{"i": 1}\nno\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = readers.bad_lines(spark, str(tmp_path)).collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["line_number"] for r in found if r["file"].endswith("a.jsonl")) == [i + 1 for i, x in enumerate(lines) if x == "{bad"]
    assert [(r["line_number"], r["line"]) for r in found if r["file"].endswith("b.jsonl")] == [(2, "no")]


def test_positions_move_rows_once(spark):
    """Counts of partitions are few, so rows are sorted and not shuffled again, and orders are compared in runs, so no value is in one task."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows = spark.range(0, 500, 1, 5).select("id", (F.col("id") % 2).alias("v"), F.lit("t").alias("t"))
    placed = identity.row_index(rows, [F.desc("id")], ["v"])
    assert "SortMergeJoin" not in plan(placed) and plan(placed).count("hashpartitioning") == 0
    assert {(r["id"], r["row_index"]) for r in placed.collect()} == {(i, (499 - i) // 2) for i in range(500)}
    odd = writers.verify_order(rows, rows.withColumn("id", -F.col("id")).withColumn("t", F.concat("t", F.when(F.col("v") == 1, "x").otherwise(""))), "v", ["t"], ["id"], ["id"])
    assert [tuple(r) for r in odd.select("value", "first_at", "n_differ").collect()] == [(1, 0, 250)] and "run" in plan(odd)


def test_row_ids_join_only_repeats(spark):
    """Rows with ids of their own are not sorted again for repeats; those that repeat are numbered, generated ones are not."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows = spark.range(6).select(F.col("id").alias("__at"), F.concat(F.lit("r"), "id").alias("id"))
    own = identity.attach_row_ids(rows, "b", "c", "s", ["__at"])
    assert plan(own).count("Join") == 1  # the one that gives row_index
    assert [(r["row_index"], r["row_id"]) for r in own.orderBy("row_index").collect()] == [(i, f"r{i}") for i in range(6)]
    twice = identity.attach_row_ids(rows.withColumn("id", F.when(F.col("__at") == 3, "").otherwise(F.concat(F.lit("r"), (F.col("__at") % 2).cast("string")))), "b", "c", "s", ["__at"])
    got = [r["row_id"] for r in twice.orderBy("row_index").collect()]
    assert [*got[:3], *got[4:]] == ["r0", "r1", "r0#1", "r0#2", "r1#1"] and len(got[3]) == 36
