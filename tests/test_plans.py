"""Plan shapes that have to hold at scale."""

from pyspark.sql import functions as F

from checks import views
from churnkit.operators import latest_per_key, missing_counts
from churnkit.plans import silver
from churnkit.plans.scoring import score_customers

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_needed(spark):
    calls, network, usage = views.events(spark, SF_DIR)
    text = plan(score_customers(calls, network, usage, ties=["event_id"]))
    assert "PushedFilters: [" in text and "EqualTo(event_type,error)" in text
    text = plan(missing_counts(views.load(spark, SF_DIR, "customer"), ["c_acctbal"]))
    assert "ReadSchema: struct<c_acctbal:double>" in text


def test_scoring_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        calls, network, usage = views.events(spark, SF_DIR)
        text = plan(score_customers(calls, network, usage, ties=["event_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(customer_id") == 3
    assert text.count("Exchange") == 3


def test_focus_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(silver.focus(*views.bronze(spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(Customer_ID") == 2


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = views.view(spark, SF_DIR, "usage").withColumn(
        "customer_id", F.when(F.col("event_id") % 3 == 0, "1").otherwise(F.col("customer_id"))
    )
    text = plan(latest_per_key(df, ["customer_id"], "event_time", ["event_id"]))
    # The plan is printed from the last step to the first.
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
