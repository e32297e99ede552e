"""Every registered query against its SQL on the given tables."""

import datetime
import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from checks.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}" if abs(value) >= 1e4 else round(value + 0.0, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def as_bag(rows):
    return Counter(tuple(plain(x) for x in row) for row in rows)


# Shares of a total are taken over rows that are one per label already; a top-k report and a
# one-row summary end in one task by nature.
ONE_TASK = {
    "risk_distribution", "revenue_at_risk", "top_risk", "missing_counts", "profile", "quantile_merged_error", "quantile_rank_error",
    "raw_topics",
}


def check_plan(name, df):
    """No cross join, no Python per row, no table pulled into one task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in plan
    assert name in ONE_TASK or "SinglePartition" not in plan


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    check_plan(name, df)
    columns = sorted(df.columns)
    kinds = dict(df.dtypes)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    expected_kinds = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    assert {c: KINDS[kinds[c]] for c in columns} == expected_kinds
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall()
    assert len(rows) == len(expected)
    assert rows or name == "outlier_columns"
    mine, theirs = as_bag(rows), as_bag(expected)
    assert mine == theirs, list((mine - theirs).items())[:3] + list((theirs - mine).items())[:3]


def test_key_diff_reads_all_orders(spark, duck):
    """Keys that only cheap orders have must be among the answers, and each side must have keys of its own."""
    found = {(r.k, r.only_in) for r in QUERIES["key_set_diff_whole"](spark, SF_DIR).collect()}
    assert {side for _, side in found} == {"left", "right"}
    cheap = duck.execute(
        "SELECT o_custkey + 7 FROM orders GROUP BY 1 HAVING max(o_totalprice) <= 200000 "
        "AND o_custkey + 7 NOT IN (SELECT c_custkey FROM customer)"
    ).fetchall()
    absent = duck.execute(
        "SELECT c_custkey FROM customer WHERE c_custkey - 7 IN "
        "(SELECT o_custkey FROM orders GROUP BY 1 HAVING max(o_totalprice) <= 200000)"
    ).fetchall()
    assert {(k, "right") for (k,) in cheap} <= found
    assert absent and not {(k, "left") for (k,) in absent} & found
