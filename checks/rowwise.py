"""Row-wise rules, projection and text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query, rounded
from checks.views import ROUND2, ctes, load, silver, view
from churnkit.functions import (
    at_most_one_ratio,
    flag,
    map_values,
    number_or,
    prefix_class,
    ratio_or,
    rule_points,
    tier,
)
from churnkit.operators import (
    add_run_columns,
    clamp_negative,
    coerce_numbers,
    keep_columns,
    normalize_text,
    quantile_bins,
    rename_snake_case,
)
from churnkit.plans import values as v
from churnkit.scratch import new_path
from churnkit.sinks import write_messages
from churnkit.sources import as_messages, parse_topic

FEATURE_NAMES = """
asl_flag refurb_new prizm_social_mapped crclscod_bin refunds overage_flag overage_rate
overage_status is_roamer customer_status customer_loyalty clv_segment household_segment device_age
completed_call_rate blocked_call_rate drop_block_call_rate network_quality data_failure_rate
data_experience
""".split()


@query(
    "row_features",
    ctes("silver") + f"SELECT customer_id, {', '.join(FEATURE_NAMES)} FROM silver",
)
def row_features(spark, sf_dir):
    return silver(spark, sf_dir).select("customer_id", *FEATURE_NAMES)


@query(
    "value_map",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' END AS known,
      CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Other' END AS known_or_other
    FROM orders
    """,
)
def value_map(spark, sf_dir):
    labels = {"F": "Filled", "O": "Open"}
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        map_values("o_orderstatus", labels).alias("known"),
        map_values("o_orderstatus", labels, "Other").alias("known_or_other"),
    )


@query(
    "prefix_bin",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'top' WHEN o_orderpriority LIKE '2%' THEN 'high'
      ELSE 'rest' END AS urgency
    FROM orders
    """,
)
def prefix_bin(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", prefix_class("o_orderpriority", {"1": "top", "2": "high"}, "rest").alias("urgency")
    )


@query(
    "tier_labels",
    """
    SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size < 30 THEN 'mid' WHEN p_size = 30 THEN 'edge'
      ELSE 'large' END AS size_tier,
      CASE WHEN p_retailprice > 1000 THEN 'Yes' ELSE 'No' END AS is_dear
    FROM part
    """,
)
def tier_labels(spark, sf_dir):
    steps = [("<=", 10, "small"), ("<", 30, "mid"), ("==", 30, "edge")]
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        tier("p_size", steps, "large").alias("size_tier"),
        flag(F.col("p_retailprice") > 1000).alias("is_dear"),
    )


@query(
    "capped_ratio",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      {ROUND2.format("CASE WHEN l_tax > 0 THEN least(1.0, l_discount / nullif(l_tax, 0)) ELSE 0.0 END")} AS capped,
      {ROUND2.format("CASE WHEN l_tax > 0 THEN l_discount / nullif(l_tax, 0) ELSE 0.0 END")} AS uncapped
    FROM lineitem
    """,
)
def capped_ratio(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        at_most_one_ratio("l_discount", "l_tax").alias("capped"),
        ratio_or("l_discount", "l_tax").alias("uncapped"),
    )


@query(
    "quantile_bins",
    """
    WITH q AS (SELECT quantile_disc(o_totalprice, 0.25) AS a, quantile_disc(o_totalprice, 0.5) AS b,
      quantile_disc(o_totalprice, 0.75) AS c FROM orders)
    SELECT o_orderkey, CASE WHEN o_totalprice < a THEN 'Low' WHEN o_totalprice < b THEN 'Mid-Low'
      WHEN o_totalprice < c THEN 'Mid-High' ELSE 'High' END AS price_bin
    FROM orders, q
    """,
)
def price_bins(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return quantile_bins(orders, "o_totalprice", "price_bin", rel_error=0).drop("o_totalprice")


@query(
    "score_rules",
    ctes("calls", "network", "usage")
    + """
    SELECT event_id,
      CASE WHEN anger_rate > 7 THEN 30 ELSE 0 END + CASE WHEN resolved = 'No' THEN 20 ELSE 0 END AS churn_score
    FROM calls
    UNION ALL SELECT event_id,
      CASE WHEN dropped_calls > 2 THEN 20 ELSE 0 END + CASE WHEN outage_flag = 1 THEN 15 ELSE 0 END FROM network
    UNION ALL SELECT event_id, CASE WHEN package_usage_pct < 20 THEN 15 ELSE 0 END FROM usage
    """,
)
def score_rules(spark, sf_dir):
    """Each kind of event scored on its own: the measures it lacks are null."""
    calls, network, usage = (view(spark, sf_dir, n) for n in ("calls", "network", "usage"))
    union = calls.unionByName(network, allowMissingColumns=True).unionByName(usage, allowMissingColumns=True)
    return union.select("event_id", rule_points(v.SCORE_RULES).alias("churn_score"))


@query(
    "clamp_negative",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def clamped(spark, sf_dir):
    return clamp_negative(load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


@query(
    "normalize_text",
    "SELECT p_partkey, upper(trim(p_name)) AS p_name, upper(trim(' ' || p_type || '  ')) AS p_type FROM part",
)
def normalized(spark, sf_dir):
    part = load(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.concat(F.lit(" "), "p_type", F.lit("  ")).alias("p_type")
    )
    return normalize_text(part, ["p_name", "p_type"])


@query(
    "coerce_default",
    """
    SELECT event_id, coalesce(TRY_CAST(regexp_extract(props, ': *([0-9]+)', 1) AS INTEGER), 0) AS k,
      0.0::DOUBLE AS kind, CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END AS amount, event_type
    FROM events
    """,
)
def coerce_default(spark, sf_dir):
    """Numbers kept as text, some blank, some junk."""
    events = load(spark, sf_dir, "events")
    junk = F.element_at(F.array(F.lit(""), F.lit("n/a"), F.lit("1,5"), F.lit("--")), (F.col("event_id") % 4 + 1).cast("int"))
    text = events.select(
        "event_id",
        F.concat(F.lit(" "), F.regexp_extract("props", "([0-9]+)", 1)).alias("k"),
        F.col("event_type").alias("kind"),
        F.when(F.col("event_id") % 4 == 0, junk).otherwise(F.col("value").cast("string")).alias("amount"),
        F.concat(F.col("event_type"), F.lit(" ")).alias("event_type"),
    )
    return coerce_numbers(text, doubles=["kind", "amount"], integers=["k"])


@query(
    "snake_case_names",
    """
    SELECT c_custkey AS customer_id, c_acctbal AS rev_mean, c_name AS hhstatin, c_nationkey AS kid0_2,
      c_mktsegment AS pipeline_version FROM customer
    """,
)
def snake_names(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer_ID"),
        F.col("c_acctbal").alias("rev_Mean"),
        F.col("c_name").alias("HHstatin"),
        F.col("c_nationkey").alias("kid0_2"),
        F.col("c_mktsegment").alias("_pipelineVersion"),
    )
    return rename_snake_case(customer)


@query(
    "run_columns",
    """
    SELECT s_suppkey, timestamp '2024-07-01 13:00:00' AS _pipeline_run_ts, 'v1' AS _pipeline_version,
      'files' AS _source_system FROM supplier
    """,
)
def run_columns(spark, sf_dir):
    suppliers = keep_columns(load(spark, sf_dir, "supplier"), ["s_suppkey"])
    started = datetime(2024, 7, 1, 10, 0)
    return add_run_columns(suppliers, "v1", "files", started)


@query("json_roundtrip", "SELECT event_id, user_id, event_type, value, props, ts FROM events")
def json_roundtrip(spark, sf_dir):
    """Rows to keyed JSON messages and back; the key is the user."""
    sent = load(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    fields = "event_id long, user_id long, event_type string, value double, props string, ts string"
    return parse_topic(as_messages(sent, "user_id"), fields, time="ts")


@query(
    "json_malformed",
    """
    SELECT event_id % 5 = 0 AS broken, CASE WHEN event_id % 5 <> 0 THEN regexp_extract(props, '([0-9]+)', 1)::INTEGER END AS k,
      count(*) AS n FROM events GROUP BY ALL
    """,
)
def json_malformed(spark, sf_dir):
    """Broken JSON gives nulls, not errors."""
    broken = F.expr("CASE WHEN event_id % 5 = 0 THEN left(props, 3) ELSE props END")
    parsed = parse_topic(load(spark, sf_dir, "events").select(broken.alias("value")), "k int", time=None)
    return parsed.groupBy(F.col("k").isNull().alias("broken"), "k").agg(F.count("*").alias("n"))


@query(
    "sent_messages",
    "SELECT 'orders' AS topic, o_custkey::VARCHAR AS key, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey",
)
def sent_messages(spark, sf_dir):
    """Rows sent as keyed messages through a writer and read back from where they went."""
    path = new_path(spark, "messages")
    write_messages(load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice"), "o_custkey", "orders", "parquet", path=path)
    messages = spark.read.parquet(path).select("topic", "key", F.get_json_object("value", "$.o_totalprice").cast("double").alias("price"))
    return messages.groupBy("topic", "key").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))


@query(
    "number_or_default",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(TRY_CAST(l_returnflag AS INTEGER), -1) AS flag_number FROM lineitem",
)
def number_or_default(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", number_or("l_returnflag", "int", -1).alias("flag_number")
    )


@query(
    "feature_profile",
    ctes("silver")
    + """
    SELECT network_quality, overage_status, count(*) AS n, round(avg(completed_call_rate), 6) AS mean_completed
    FROM silver GROUP BY ALL
    """,
)
def feature_profile(spark, sf_dir):
    grouped = silver(spark, sf_dir).groupBy("network_quality", "overage_status")
    return rounded(grouped.agg(F.count("*").alias("n"), F.avg("completed_call_rate").alias("mean_completed")))
