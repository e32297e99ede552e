"""Queries whose result SQL can express, on the given tables."""

import duckdb
import pytest

from churnkit.llm.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    listed = ", ".join(columns)
    theirs = sorted(repr(r) for r in duck.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall())
    assert mine and mine == theirs


def test_all_numbers_are_registered():
    found = {name.split("_")[0] for name in QUERIES if name.startswith("op")}
    assert found == {f"op{n}" for n in range(1, 14)}
