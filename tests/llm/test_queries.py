"""Every query with SQL against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from lexiloom.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(df: pd.DataFrame, columns: list[str]) -> list:
    plain = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (float, int)) and not isinstance(x, bool) else x
    return sorted(repr([plain(x.item() if hasattr(x, "item") else x) for x in r]) for r in df[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))


def test_names():
    assert {n.partition("_")[0] for n in queries.QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"} and set(queries.ORACLES) <= set(queries.QUERIES)
