"""Star schema: keys, row counts, fan-out and the two ways to the usage means."""

import datetime

import pytest
from pyspark.sql import functions as F

from checks import views
from churnkit.operators import same_keys
from churnkit.plans import values as v
from churnkit.plans import warehouse
from churnkit.plans.scoring import score_customers
from churnkit.plans.silver import build_silver, focus
from churnkit.scratch import materialize

SF_DIR = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def staging(spark):
    client, record = views.bronze(spark, SF_DIR)
    run = datetime.datetime(2024, 1, 5, 10, 0, tzinfo=datetime.timezone.utc)
    calls, network, usage = (e.drop("event_id") for e in views.events(spark, SF_DIR))
    return {
        "silver": materialize(build_silver(client, record, run), "silver"),
        "calls": calls,
        "network": network,
        "usage": usage,
        "risk": materialize(score_customers(calls, network, usage), "risk"),
    }


@pytest.fixture(scope="module")
def dims(staging):
    return warehouse.build_dims(staging)


@pytest.fixture(scope="module")
def facts(staging, dims):
    return warehouse.build_facts(staging, dims)


def test_silver_shape(staging):
    silver = staging["silver"]
    assert len(silver.columns) == 64
    assert silver.groupBy("customer_id").count().filter("count > 1").isEmpty()
    filled = [c for c in silver.columns if c not in ("asl_flag", "refurb_new")]
    assert silver.select([F.count_if(F.col(c).isNull()).alias(c) for c in filled]).first().asDict() == dict.fromkeys(filled, 0)
    assert silver.filter("customer_id % 97 = 0").isEmpty()
    assert silver.filter("rev_mean < 0").isEmpty()


def test_label_filter_before_or_after_the_choice(spark):
    client, record = views.bronze(spark, SF_DIR)
    before, after = (focus(client, record, filter_first=f) for f in (True, False))
    # Rows with a bad label sort behind the good ones here, so only the all-bad customers are lost.
    assert same_keys(before, after.filter("churn IN (0, 1)"), ["customer_id"])


def test_keys_are_dense(dims, facts):
    for name, df in {**dims, **facts}.items():
        key = df.columns[0]
        low, high, n = df.agg(F.min(key), F.max(key), F.count("*")).first()
        assert (low, high) == (1, n), name
        assert df.select(key).distinct().count() == n, name


def test_fact_rows(staging, facts):
    for fact, table in (("customer_snapshot", "silver"), ("customer_care_call", "calls"), ("churn_risk", "risk")):
        assert facts[f"fact_{fact}"].count() == staging[table].count()
    pairs = staging["usage"].join(staging["network"], ["customer_id", "event_time"], "left").count()
    assert facts["fact_usage_network_event"].count() == pairs


def test_marts(facts, dims, staging):
    marts = warehouse.build_marts(facts, dims)
    for name in ("mart_customer_overview", "mart_network_service_quality"):
        assert marts[name].count() == staging["silver"].count()
    assert len(marts["mart_customer_overview"].columns) == 27
    assert len(marts["mart_network_service_quality"].columns) == 23


def test_snapshot_time_keys(staging, facts):
    """The run time is no event time, so its time of day finds no key unless run times are added."""
    assert facts["fact_customer_snapshot"].filter("time_key IS NOT NULL").count() in (0, staging["silver"].count())
    late = staging["silver"].withColumn("pipeline_run_ts", F.lit("2031-05-05 05:05:05.5").cast("timestamp"))
    tables = {**staging, "silver": late}
    without, with_run = warehouse.build_dims(tables), warehouse.build_dims(tables, with_run_times=True)
    snapshot = warehouse.fact_customer_snapshot(late, without)
    assert snapshot.filter("date_key IS NOT NULL OR time_key IS NOT NULL").isEmpty()
    assert warehouse.fact_customer_snapshot(late, with_run).filter("date_key IS NULL").isEmpty()
    times = [r.full_time for r in with_run["dim_time"].filter("minute = 5").collect()]
    assert times == ["05:05:05.000000"]


def test_null_safe_snapshot_finds_every_device(staging, dims, facts):
    plain = facts["fact_customer_snapshot"]
    assert plain.filter("device_key IS NULL").count() == staging["silver"].filter("refurb_new IS NULL").count()
    safe = warehouse.fact_customer_snapshot(staging["silver"], dims, null_safe=True)
    assert safe.filter("device_key IS NULL OR loyalty_key IS NULL").isEmpty()


def test_junk_and_unknown_ids(spark, dims):
    calls = spark.createDataFrame(
        [("junk", 1), ("999999999", 2), ("1", 3), (None, 4)], "customer_id string, anger_rate int"
    ).selectExpr("*", "'x' AS issue_type", "1 AS call_duration_sec", "'Yes' AS resolved",
                 "timestamp '1999-01-01 00:00:00' AS event_time")
    fact = warehouse.fact_customer_care_call(calls, dims)
    found = {r.anger_rate: (r.customer_key is not None, r.date_key) for r in fact.collect()}
    assert found == {1: (False, None), 2: (False, None), 3: (True, None), 4: (False, None)}


def test_usage_means_without_pairs(spark, dims):
    """Two rows on each side give four pairs; nulls and lone rows take part too."""
    usage = spark.createDataFrame(
        [("1", 1, 10, 5), ("1", 1, 20, None), ("1", 2, 90, 7), ("2", 1, 4, 1), ("zz", 1, 8, 2), ("yy", 1, 2, 4), ("001", 1, 6, 6)],
        "customer_id string, t int, data_usage_mb int, package_usage_pct int",
    ).selectExpr("*", "1 AS voice_minutes", "1 AS sms_count", "timestamp_seconds(t) AS event_time")
    network = spark.createDataFrame(
        [("1", 1, 50, 3), ("1", 1, 70, None), ("9", 1, 1, 1), ("zz", 1, 5, 5)],
        "customer_id string, t int, signal_strength int, internet_speed int",
    ).selectExpr("*", "0 AS dropped_calls", "0 AS outage_flag", "timestamp_seconds(t) AS event_time")
    fact = warehouse.fact_usage_network_event(usage, network, dims)
    assert fact.count() == 9
    expected = bag(warehouse.usage_means(fact))
    assert bag(warehouse.usage_means_from_events(usage, network, dims).select(
        "customer_key", *v.USAGE_MEANS)) == expected
