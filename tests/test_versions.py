"""Versioned tables: units replaced one at a time, whole commits."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexiloom.sources import versions

SCHEMA = "dataset_config string, split string, record_id string, n long"


def rows(df):
    return sorted((r["split"], r["record_id"], r["n"]) for r in df.collect())


def frame(spark, *data):
    return spark.createDataFrame([("c", *r) for r in data], SCHEMA)


def test_units_stay_beside_each_other(spark, tmp_path):
    t = str(tmp_path / "t")
    versions.commit(frame(spark, ("01", "a", 1), ("01", "b", 2)), t, [("c", "01")])
    assert rows(versions.commit(frame(spark, ("val", "a", 3)), t, [("c", "val")])) == [("01", "a", 1), ("01", "b", 2), ("val", "a", 3)]
    versions.commit(frame(spark, ("01", "z", 9)), t, [("c", "01")])
    assert rows(versions.read(spark, t)) == [("01", "z", 9), ("val", "a", 3)]
    assert rows(versions.read(spark, t, [("c", "val")])) == [("val", "a", 3)]
    assert rows(versions.read(spark, t, number=2)) == [("01", "a", 1), ("01", "b", 2), ("val", "a", 3)]
    versions.commit(frame(spark), t, [("c", "01"), ("c", "val")])
    assert rows(versions.read(spark, t)) == []


def test_parts_of_a_unit(spark, tmp_path):
    t = str(tmp_path / "t")
    versions.commit(frame(spark, ("s", "a", 1), ("s", "b", 2)), t, [("c", "s")], key="record_id")
    assert rows(versions.commit(frame(spark, ("s", "b", 7), ("s", "c", 8)), t, [("c", "s")], key="record_id")) == [("s", "a", 1), ("s", "b", 7), ("s", "c", 8)]


def test_a_killed_write_leaves_the_version_before(spark, tmp_path):
    t = str(tmp_path / "t")
    versions.commit(frame(spark, ("s", "a", 1)), t, [("c", "s")])
    broken = frame(spark, ("s", "b", 2)).withColumn("n", F.raise_error(F.lit("killed")).cast("long"))
    with pytest.raises(PySparkException):
        versions.commit(broken, t, [("c", "s")])
    with pytest.raises(PySparkException, match="another unit"):
        versions.commit(frame(spark, ("other", "b", 2)), t, [("c", "s")])
    assert rows(versions.read(spark, t)) == [("s", "a", 1)]
    assert versions.expire(spark, t) > 0 and rows(versions.read(spark, t)) == [("s", "a", 1)]


def test_two_writers(spark, tmp_path, monkeypatch):
    """The second to publish a number takes over what the first has committed."""
    t, late = str(tmp_path / "t"), []
    publish = versions._publish

    def slow(spark, path, document):
        if not late:
            late.append(1)
            versions.commit(frame(spark, ("b", "y", 2)), t, [("c", "b")])
        return publish(spark, path, document)

    monkeypatch.setattr(versions, "_publish", slow)
    versions.commit(frame(spark, ("a", "x", 1)), t, [("c", "a")])
    assert rows(versions.read(spark, t)) == [("a", "x", 1), ("b", "y", 2)] and versions.numbers(spark, t) == [1, 2]


def test_new_columns_and_other_types(spark, tmp_path):
    t = str(tmp_path / "t")
    versions.commit(frame(spark, ("a", "x", 1)), t, [("c", "a")])
    versions.commit(frame(spark, ("b", "y", 2)).withColumn("more", F.lit("m")), t, [("c", "b")])
    assert {r["split"]: r["more"] for r in versions.read(spark, t).collect()} == {"a": None, "b": "m"}
    with pytest.raises(ValueError, match="was bigint"):
        versions.commit(frame(spark, ("a", "x", 1)).withColumn("n", F.lit("text")), t, [("c", "a")])
    other = versions.commit(frame(spark, ("a", "x", 1)).withColumn("n", F.lit("text")), t, [("c", "a"), ("c", "b")])
    assert [r["n"] for r in other.collect()] == ["text"]  # nothing of the old type is left
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))
