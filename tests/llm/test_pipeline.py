"""The stages of the corpus pipeline against brute-force versions, and their edge cases."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_passages
from test_operators import ids_of, loaded

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS).repartition(3)


def test_pipeline(spark, tmp_path):
    """Every stage against a brute-force version of it."""
    sf = "/root/testdata/sf0.001"
    start = spark.read.parquet(f"{sf}/documents.parquet")
    after = [start]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, after[-1], sf).write.parquet(str(tmp_path / str(i)))
        after.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(a.columns == start.columns for a in after[:4])
    rows = [sorted(tuple(r) for r in a.select("doc_id", "text").collect()) for a in after[:4]]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0 AND quality = 1").collect()}
    kept = {i for i, _ in rows[1]}
    assert not kept & toxic and len(kept & good) >= 0.98 * len(good & {i for i, _ in rows[0]})
    ids, texts = zip(*rows[1], strict=True)
    root, _ = brute_components(texts, 5, 80)
    assert [i for i, _ in rows[2]] == [ids[k] for k in range(len(ids)) if root[k] == k]
    want = brute_passages([t for _, t in rows[2]], 35)
    assert [t for _, t in rows[3]] == [w[2] if w[1] else t for (_, t), w in zip(rows[2], want, strict=True)]
    library = loaded()
    by = dict(rows[3])
    pieces = after[4].collect()
    assert {r["doc_id"] for r in pieces} == set(by)
    total = sum(len(ids_of(library, t, [0])) for t in by.values())
    assert sum(r["length"] for r in pieces) == total and len({r["sequence_id"] for r in pieces}) <= -(-total // 2048) + 1


def test_near_dedup_of_repeated_and_null_ids(spark):
    """One whole row of each group passes stages 2 and 3, also where rows repeat a doc_id or have none."""
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"}
    rows = [(1, text["a"]), (1, text["a"]), (None, text["b"]), (None, text["b"]), (None, text["c"]), (7, text["c"]), (9, text["d"]), (9, text["d"].upper()), (4, text["d"]), (5, text["e"]), (5, text["f"]), (None, text["g"]), (6, None), (6, None)]
    start = table(spark, rows).withColumns({"left": F.lit("x"), "n": F.lit(1), "row_key": F.lit("y")})
    second = corpus_pipeline.near_dedup(spark, start, "")
    third = corpus_pipeline.substring_dedup(spark, second, "")
    want = Counter([(1, text["a"]), (None, text["b"]), (7, text["c"]), (4, text["d"]), (5, text["e"]), (5, text["f"]), (None, text["g"]), (6, None), (6, None)])
    assert second.columns == third.columns == start.columns
    assert [Counter((r["doc_id"], r["text"]) for r in x.collect()) for x in (second, third)] == [want, want]


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "a b"), (None, "a b"), (5, " ".join(f"w{i % 997}" for i in range(30_000))), (None, None)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:3])
def test_stages_take_odd_rows(spark, tmp_path, name, stage):
    """Nulls in any column, empty, blank and very long texts, repeated rows, columns of clashing names, empty tables."""
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 0, 0), (5, 0, 1), (9, 1, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    start = table(spark, ODD).withColumns({c: F.lit(None).cast("string") for c in ("left", "n_removed", "k0", "rid", "tail_probability", "row_key", "c0")})
    got = stage(spark, start, str(tmp_path))
    rows = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert got.schema.simpleString() == start.schema.simpleString()
    if name == "near_dedup":
        assert rows == Counter(set(ODD))
    elif name == "substring_dedup":
        assert rows == Counter([(i, "" if i == 5 else t) for i, t in ODD])
    else:
        assert not rows - Counter(ODD) and (5, ODD[7][1]) not in rows and rows[4, "one"] in (0, 2)
    assert stage(spark, start.limit(0), str(tmp_path)).count() == 0


def test_packing_takes_odd_rows(spark):
    got = corpus_pipeline.pack(spark, table(spark, ODD), "").collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(i for i, _ in ODD)
    assert sum(r["length"] for r in got) == sum(len(ids_of(loaded(), t, [0])) for _, t in ODD)
    assert corpus_pipeline.pack(spark, table(spark, ODD).limit(0), "").count() == 0
