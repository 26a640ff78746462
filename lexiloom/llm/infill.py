"""Fill-in-middle training texts: two cuts of a text, its parts behind marks in another order.

A text is a sequence of units, the matches of a pattern.  The matches become
rows, a window sums up their lengths into the place where each begins, requests
for a cut before unit k are joined with the row of that unit, and the places are
gathered per document; the text itself is moved once, to be cut there.

Where every unit is one code point, a match is a run of RUN units, so a row
stands for RUN units: unit k is in row k div RUN, k mod RUN further on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.scratch import written
from lexiloom.llm.skew import heavy_keys, spread_join

#: Code points of a match where units are code points.
RUN = 4096
#: The marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
_KEY = ["doc_id", "same", "n_chars"]  # rows that agree here are cut alike


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of seed and doc_id (null: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cut_places(rows: DataFrame, unit: str | None, cuts: Callable[[Column, Column], list[Column]]) -> DataFrame:
    """For each distinct key of rows (doc_id, same, n_chars, lengths of matches): n units and, as array `places`, the code points before each cut.

    cuts(doc_id, n) gives the units before each cut, 0 to n of them.
    """
    per = 1 if unit else RUN
    n = F.size("lengths").cast("long") if unit else F.col("n_chars")
    keys = rows.dropDuplicates(_KEY).withColumn("n", n)
    ends = F.array_append(F.col("lengths"), F.lit(0))  # the place after the last unit is that of an empty one
    units = keys.select(*_KEY, F.posexplode(ends).alias("row", "length"))
    before = Window.partitionBy(*_KEY).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    starts = units.select(*_KEY, "row", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("start"))
    asked = keys.select(*_KEY, "n", F.posexplode(F.array(*cuts(F.col("doc_id"), F.col("n")))).alias("cut", "k"))
    asked = asked.withColumns({"row": F.expr(f"cast(k div {per} as int)"), "more": F.col("k") % per})
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in _KEY]
    found = asked.alias("a").join(starts.alias("s"), [*same, F.col("a.row") == F.col("s.row")])
    place = F.struct("a.cut", (F.col("s.start") + F.col("a.more")).alias("place"))
    at = found.groupBy(*[F.col(f"a.{c}") for c in _KEY], "n").agg(F.array_sort(F.collect_list(place)).alias("p"))  # as many as there are cuts
    return at.select(*_KEY, "n", F.transform("p", lambda x: x["place"]).alias("places"))


def restored(output: Column, form: Column) -> Column:
    """The text before its transformation, from the output and its form alone."""
    p, s, m = MARKS
    parts = F.split(output, f"{p}|{s}|{m}", -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(docs: DataFrame, unit: str | None = None, plain_percent: int = 10, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n, form, prefix_chars, middle_chars, output.

    `unit` is a pattern whose matches follow each other without a gap (an error if
    not); None means code points.  Both cuts are drawn from doc_id, so rows that
    repeat a doc_id and a text have the same result; a null doc_id draws as a text
    of its own.  Null and empty texts, texts with a mark in them and
    `plain_percent` of the others stay plain, with null lengths; of the rest
    `spm_percent` put the suffix first.  Other columns are not read.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    src = src.withColumns({"same": F.xxhash64("text", F.lit(13)), "n_chars": F.length("text").cast("long")})
    lengths = F.transform(F.regexp_extract_all("text", F.lit(unit or f"(?s).{{1,{RUN}}}"), F.lit(0)), lambda x: F.length(x))
    rows = src.select(*_KEY, lengths.alias("lengths"))
    if unit:
        gap = F.raise_error(F.lit("matches of the unit's pattern do not cover a text"))
        rows = rows.withColumn("lengths", F.when(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x) == F.col("n_chars"), F.col("lengths")).otherwise(gap))
    rows = written(rows, "units")

    def cuts(doc_id: Column, n: Column) -> list[Column]:
        h1, h2, *_ = draws(doc_id, seed)
        a, b = h1 % (n + 1), h2 % (n + 1)
        return [F.least(a, b), F.greatest(a, b)]

    places = written(cut_places(rows, unit, cuts), "places")
    counts = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
    named = lambda df: df.withColumns({"doc_id": F.coalesce("doc_id", F.lit(0)), "no_id": F.col("doc_id").isNull()})  # noqa: E731  keys of joins are not null
    on = ["doc_id", "no_id", "same", "n_chars"]
    joined = spread_join(named(src), named(places).hint("shuffle_hash"), on, heavy_keys(named(counts), on), F.monotonically_increasing_id())
    joined = joined.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id")))

    p, s, m = MARKS
    *_, h3, h4 = draws(F.col("doc_id"), seed)
    text, marked = F.col("text"), F.col("text").contains(p) | F.col("text").contains(s) | F.col("text").contains(m)
    form = F.when((text == "") | marked | (h3 % 100 >= 100 - plain_percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    a, b = F.col("places")[0].cast("int"), F.col("places")[1].cast("int")
    cut = joined.select("doc_id", "n", form.alias("form"), "text", F.substring(text, F.lit(1), a).alias("prefix"), F.substring(text, a + 1, b - a).alias("middle"), F.substring(text, b + 1, F.length("text")).alias("suffix"), a.alias("a"), b.alias("b"))
    psm, spm = F.concat(F.lit(p), "prefix", F.lit(s), "suffix", F.lit(m), "middle"), F.concat(F.lit(s), "suffix", F.lit(p), "prefix", F.lit(m), "middle")
    output = F.when(F.col("form") == "plain", text).when(F.col("form") == "psm", psm).otherwise(spm)
    size = lambda x: F.when(F.col("form") != "plain", x.cast("long"))
    return cut.select("doc_id", "n", "form", size(F.col("a")).alias("prefix_chars"), size(F.col("b") - F.col("a")).alias("middle_chars"), output.alias("output"))


def op13(spark, sf_dir: str) -> DataFrame:
    """See fill_in_middle; the digests of the output and of the text that is rebuilt from it."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256)}
    return made.withColumns(digests).drop("output")


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || doc_id) AS h FROM documents),
u AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b, ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS e FROM d),
f AS (SELECT *, least(a, b) AS x, greatest(a, b) AS y, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substring(t, 1, x) AS pre, substring(t, x + 1, y - x) AS mid, substring(t, y + 1, n - y) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
