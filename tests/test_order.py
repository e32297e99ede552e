"""Dense keys and exact quantiles against brute force."""

import bisect
import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnkit.operators import order, ranks
from churnkit.operators import column_sketches, continue_ids, dense_key, exact_quantiles, quantiles, sketch_quantiles
from churnkit.operators.ranks import sketch_size


@pytest.fixture
def many_parts(spark):
    """Keep small shuffles in several partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def parts_of(df):
    """Files that the rows come from."""
    return df.select(F.input_file_name().alias("f")).distinct().count()


def test_dense_key_equals_global_row_number(spark, many_parts, tmp_path):
    df = spark.range(5000).selectExpr("id", "id % 37 AS g", "CASE WHEN id % 11 = 0 THEN NULL ELSE id % 101 END AS h")
    keyed = dense_key(df, "k", ["g", "h"], ties=["id"], distinct=True, path=str(tmp_path / "placed"))
    assert parts_of(spark.read.parquet(str(tmp_path / "placed"))) > 1
    expected = df.withColumn("k", F.row_number().over(Window.orderBy("g", "h", "id")).cast("long"))
    assert keyed.select("id", "k").exceptAll(expected.select("id", "k")).isEmpty()
    assert keyed.count() == 5000


def test_dense_key_spreads_copies_of_one_row(spark, many_parts, tmp_path):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS a", "1 AS b").repartition(4)
    keyed = dense_key(df, "k", ["a"], path=str(tmp_path / "placed"))
    assert keyed.selectExpr("min(k)", "max(k)", "count(DISTINCT k)").first() == (1, 3000, 3000)
    assert keyed.filter("a = 1").selectExpr("min(k)", "max(k)", "count(*)").first() == (1, 1001, 1001)
    assert parts_of(spark.read.parquet(str(tmp_path / "placed")).filter("a = 1")) > 1


def test_dense_key_writes_scanned_rows_once(spark, tmp_path, monkeypatch):
    """Rows of a plain scan keep their place; only those out of a shuffle are written before they are placed."""
    spark.range(50).selectExpr("id % 5 AS a").write.parquet(str(tmp_path / "in"))
    labels = []
    write = order.materialize
    monkeypatch.setattr(order, "materialize", lambda df, label, path=None: labels.append(label) or write(df, label, path))
    scanned = spark.read.parquet(str(tmp_path / "in"))
    for df, first in ((scanned, []), (scanned.repartition(3), ["unkeyed"])):
        labels.clear()
        keyed = dense_key(df, "k", ["a"])
        assert labels == [*first, "placed", "starts"]
        assert sorted(r.k for r in keyed.collect()) == list(range(1, 51))


@pytest.mark.parametrize("sign", [1, -1])
def test_exact_quantiles_with_infinite_values(spark, sign):
    df = spark.range(1000).selectExpr(f"IF(id % 5 = 0, {sign} * double('Infinity'), double(id)) AS x")
    found = quantiles(df, ["x"], [0.1, 0.5, 0.9], rel_error=0)["x"]
    values = sorted(r.x for r in df.collect())
    assert found == [values[99], values[499], values[899]]


def test_dense_key_of_nothing(spark):
    empty = spark.range(0)
    assert dense_key(empty, "k", ["id"], distinct=True).count() == 0


def test_keep_and_continue(spark):
    new = spark.createDataFrame([("b", 1), ("a", 2)], "name string, id int")
    out = continue_ids(spark.range(5, 8), new, "id", ["name"], distinct=True)
    assert sorted((r.name, r.id) for r in out.collect()) == [("a", 8), ("b", 9)]
    first = continue_ids(spark.range(0), new, "id", ["name"], distinct=True)
    assert sorted(r.id for r in first.collect()) == [1, 2]


def brute(values, prob):
    kept = sorted(x for x in values if x is not None and not math.isnan(x))
    return kept[max(math.ceil(round(prob * len(kept), 9)), 1) - 1]


PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@pytest.mark.parametrize("error", [0.001, 0.05])
def test_exact_quantiles(spark, many_parts, error):
    rng = random.Random(5)
    columns = {
        "normal": [rng.gauss(0, 1) for _ in range(4000)],
        "hot": [7.0 if i % 3 == 0 else rng.random() * 20 for i in range(4000)],
        "few": [float(rng.randrange(3)) for _ in range(4000)],
        "holes": [None if i % 4 else rng.uniform(-5, 5) for i in range(4000)],
        "odd": [float("nan") if i % 5 == 0 else float(i) for i in range(4000)],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(6)
    found = exact_quantiles(df, list(columns), PROBS, sketch_error=error)
    assert found == {c: [brute(x, p) for p in PROBS] for c, x in columns.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100])
def test_exact_quantiles_of_few_rows(spark, n):
    df = spark.range(n).selectExpr("double(id) AS x", "CASE WHEN id < 0 THEN 1.0D END AS none")
    found = quantiles(df, ["x", "none"], [0.0, *PROBS, 1.0], rel_error=0)
    assert found == {"x": [brute(range(n), p) for p in [0.0, *PROBS, 1.0]], "none": []}


def test_sketch_keeps_its_error(spark):
    df = spark.range(20000).selectExpr("id AS x").repartition(8)
    marks = sketch_quantiles(df, ["x"], PROBS, 0.01)["x"]
    assert all(abs(m / 20000 - p) <= 0.0101 for m, p in zip(marks, PROBS))


def test_sketches_are_merged_in_two_levels(spark):
    """Error and plan of the merge: tasks meet in groups first, and infinite values keep their ranks."""
    infinite = "CASE id % 5 WHEN 0 THEN double('Infinity') WHEN 1 THEN double('-Infinity') WHEN 2 THEN double('NaN') ELSE id END AS y"
    df = spark.range(30000).selectExpr("double(id) AS x", infinite, "double(NULL) AS none").repartition(40)
    marks = sketch_quantiles(df, ["x", "y", "none"], [0.0, *PROBS, 1.0], 0.01, groups=6)
    assert marks["none"] == [] and marks["x"][0] == 0 and marks["x"][-1] == 29999
    assert all(abs(m / 30000 - p) <= 0.0101 for m, p in zip(marks["x"][1:-1], PROBS))
    values = sorted(float("inf") if i % 5 == 0 else float("-inf") if i % 5 == 1 else i for i in range(30000) if i % 5 != 2)
    for m, p in zip(marks["y"], [0.0, *PROBS, 1.0], strict=True):
        below, upto = bisect.bisect_left(values, m) / len(values), bisect.bisect_right(values, m) / len(values)
        assert below - 0.0101 <= p <= upto + 0.0101
    plan = column_sketches(df, ["x"], 0.01)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"hashpartitioning\(([^)]*)", plan)
    assert any("name" in e and "_group" in e for e in exchanges) and len(exchanges) == 2
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("wrong", [(10.0, 20.0), (-5.0, -5.0), (5000.0, 9000.0), (None, 3.0), (900.0, None), (float("-inf"), float("inf"))])
def test_exact_quantiles_where_the_sketch_was_wrong(spark, monkeypatch, wrong):
    """An interval that misses its quantile costs time, not the result."""
    df = spark.range(1000).selectExpr("double(id % 250 * 4) AS x").repartition(5)
    monkeypatch.setattr(ranks, "_intervals", lambda df, columns, probs, error: {"x": [*wrong] * len(probs)})
    assert exact_quantiles(df, ["x"], PROBS) == {"x": [brute([i % 250 * 4 for i in range(1000)], p) for p in PROBS]}


@pytest.mark.parametrize("error", [0.2, 0.01, 0.001])
def test_sketch_size_follows_the_error(error):
    k = sketch_size(error)
    assert 2.446 / k**0.9433 <= error / 2 < 2.446 / (k - 2) ** 0.9433
