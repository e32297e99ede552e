"""Joins that must stay whole under skew."""

import pytest
from pyspark.sql import functions as F

from churnkit.operators import key_set_diff, latest_per_key, lookup, same_keys
from churnkit.operators import joins
from churnkit.operators.joins import hot_fingerprints, inner_join, measured_bytes, salted_join


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def skewed(spark):
    left = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 17 = 0 THEN NULL ELSE id END AS k", "id AS row"
    )
    right = spark.range(0, 3000, 5).selectExpr("id AS k", "id * 2 AS v")
    return left, right.union(spark.createDataFrame([(5, -1), (None, -2)], "k long, v long"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(skewed, how, null_safe):
    """Hot on the left, on the right, and on both."""
    left, right = skewed
    assert hot_fingerprints(left, ["k"], 16)
    some = left.where("row % 5 = 0")
    for a, b in ((left, right), (right, left), (left, some.withColumnRenamed("row", "other"))):
        a.createOrReplaceTempView("a")
        b.createOrReplaceTempView("b")
        listed = ", ".join([f"a.{c}" for c in a.columns] + [f"b.{c}" for c in b.columns if c != "k"])
        expected = a.sparkSession.sql(f"SELECT {listed} FROM a {how} JOIN b ON a.k {'<=>' if null_safe else '='} b.k")
        assert bag(salted_join(a, b, ["k"], how, null_safe, tasks=16)) == bag(expected)


def test_a_hot_right_key_whose_hash_is_not_there(spark, monkeypatch):
    """A left row that only seems to have the hot key stays, without a partner."""
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, l string")
    right = spark.range(300).selectExpr("1L AS k", "id AS r")
    fake = {spark.sql(f"SELECT xxhash64({k}L)").first()[0]: 4 for k in (1, 2)}
    monkeypatch.setattr(joins, "hot_keys", lambda df, *_: fake if "r" in df.columns else {})
    found = bag(salted_join(left, right, ["k"]))
    assert found == bag(left.join(right, ["k"], "left"))


@pytest.mark.parametrize("side", ["left", "right"])
def test_equal_rows_of_a_hot_key_spread(spark, side):
    """A third of the rows are alike; over 8 tasks, none gets half of them."""
    heavy = spark.range(30_000, numPartitions=3).selectExpr("IF(id % 3 = 0, 7L, id) AS k", "'same' AS v")
    light = spark.range(0, 30_000, 7).selectExpr("id AS k", "id AS w")
    a, b = (heavy, light) if side == "left" else (light, heavy)
    found = salted_join(a, b, ["k"], "inner", tasks=32)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    where = found.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    for name, value in before.items():
        spark.conf.set(name, value)
    sizes = [r["count"] for r in where]
    assert sum(sizes) == 10_001 and len(sizes) >= 4 and max(sizes) <= 10_000 / 2


def test_salted_join_refuses_other_kinds(skewed):
    with pytest.raises(ValueError):
        salted_join(*skewed, ["k"], "full")


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_beyond_and_below_the_limit(skewed, limit, null_safe):
    left, right = skewed
    out = lookup(left, right, ["k"], ["v"], null_safe=null_safe, max_broadcast_bytes=limit)
    same = left.k.eqNullSafe(right.k) if null_safe else left.k == right.k
    expected = left.join(right, same, "left").select(left.k, left.row, right.v)
    assert out.columns == ["k", "row", "v"]
    assert bag(out) == bag(expected)


def test_inner_join_and_size(spark, skewed):
    left, right = skewed
    assert bag(inner_join(left, right, ["k"])) == bag(left.join(right, ["k"]))
    text = spark.createDataFrame([(1, "ab"), (2, None)], "k int, t string")
    assert measured_bytes(text) == 8 * 2 * 2 + 2
    assert measured_bytes(text.filter("k > 5")) == 0


def test_key_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert bag(key_set_diff(a, b, ["k"])) == [(1, "left"), (3, "right")]
    assert same_keys(a, a.distinct(), ["k"]) and not same_keys(a, b, ["k"])


def test_latest_breaks_equal_times(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9), (2, None, 1)], "k int, t int, id int")
    assert bag(latest_per_key(df, ["k"], "t", ["id"])) == [(1, 5, 2), (2, None, 1)]
    assert bag(latest_per_key(df, ["k"], "t")) == [(1, 5, 2), (2, None, 1)]


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], "t", [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
