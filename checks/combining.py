"""Joins, latest rows, set operations and dense keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import ctes, events, load
from churnkit.operators import (
    append_rows,
    continue_ids,
    dense_key,
    distinct_union,
    inner_join,
    key_set_diff,
    latest_per_key,
    left_chain,
    lookup,
)
from churnkit.operators.joins import salted_join
from churnkit.plans.warehouse import join_usage_network


@query(
    "inner_join",
    """
    SELECT o_orderkey, c_custkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def orders_with_customers(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return inner_join(orders, customers, ["c_custkey"])


LATEST_SQL = """
{0}_latest AS (SELECT * FROM {0} QUALIFY row_number() OVER (
  PARTITION BY customer_id ORDER BY event_time DESC, event_id DESC) = 1)
"""


@query(
    "latest_per_customer",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest(spark, sf_dir):
    return latest_per_key(load(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


@query(
    "left_chain",
    ctes("calls", "network", "usage", more=",".join(LATEST_SQL.format(n) for n in ("calls", "network", "usage")))
    + """
    SELECT customer_id, anger_rate, signal_strength, voice_minutes FROM calls_latest
    LEFT JOIN network_latest USING (customer_id) LEFT JOIN usage_latest USING (customer_id)
    """,
)
def chained(spark, sf_dir):
    sides = [latest_per_key(e, ["customer_id"], "event_time", ["event_id"]) for e in events(spark, sf_dir)]
    measures = ("anger_rate", "signal_strength", "voice_minutes")
    return left_chain(*[s.select("customer_id", m) for s, m in zip(sides, measures)], on=["customer_id"])


@query(
    "usage_network_join",
    ctes("network", "usage")
    + """
    SELECT u.event_id AS usage_id, n.event_id AS network_id, customer_id, event_time, voice_minutes, signal_strength
    FROM usage u LEFT JOIN network n USING (customer_id, event_time)
    """,
)
def usage_network(spark, sf_dir):
    _, network, usage = events(spark, sf_dir)
    return join_usage_network(
        usage.select("customer_id", "event_time", F.col("event_id").alias("usage_id"), "voice_minutes"),
        network.select("customer_id", "event_time", F.col("event_id").alias("network_id"), "signal_strength"),
    )


@query(
    "skewed_join",
    """
    WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS c_custkey,
      CASE WHEN event_id % 3 = 0 THEN 'x' ELSE event_type END AS event_type FROM events)
    SELECT c_custkey, event_type, c_name, count(*) AS n FROM e LEFT JOIN customer USING (c_custkey) GROUP BY ALL
    """,
)
def skewed(spark, sf_dir):
    """A third of the events belong to one customer and are all alike."""
    third = F.col("event_id") % 3 == 0
    heavy = load(spark, sf_dir, "events").select(
        F.when(third, F.lit(1)).otherwise(F.col("user_id")).alias("c_custkey"),
        F.when(third, F.lit("x")).otherwise(F.col("event_type")).alias("event_type"),
    )
    found = salted_join(heavy, load(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], tasks=64)
    return found.groupBy("c_custkey", "event_type", "c_name").agg(F.count("*").alias("n"))


@query(
    "skewed_right_join",
    """
    WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS c_custkey FROM events)
    SELECT c_custkey, c_name, event_id FROM customer LEFT JOIN e USING (c_custkey)
    """,
)
def skewed_right(spark, sf_dir):
    """The key that holds a third of the rows is on the right of a left join, and rare on the left."""
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")).alias("c_custkey")
    heavy = load(spark, sf_dir, "events").select("event_id", user)
    return salted_join(load(spark, sf_dir, "customer").select("c_custkey", "c_name"), heavy, ["c_custkey"], tasks=64)


@query(
    "lookup",
    "SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey + 5 = n_nationkey",
)
def looked_up(spark, sf_dir):
    """Keys are shifted, so that some find nothing."""
    nations = load(spark, sf_dir, "nation")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") + 5).alias("n_nationkey"))
    return lookup(suppliers, nations, ["n_nationkey"], ["n_name"]).select("s_suppkey", "n_name")


@query(
    "lookup_null_safe",
    """
    WITH d AS (SELECT nullif(n_nationkey, 3) AS k, n_name FROM nation)
    SELECT s_suppkey, n_name FROM supplier LEFT JOIN d ON nullif(s_nationkey, 3) IS NOT DISTINCT FROM k
    """,
)
def looked_up_null_safe(spark, sf_dir):
    nations = load(spark, sf_dir, "nation").selectExpr("nullif(n_nationkey, 3) AS k", "n_name")
    suppliers = load(spark, sf_dir, "supplier").selectExpr("s_suppkey", "nullif(s_nationkey, 3) AS k")
    return lookup(suppliers, nations, ["k"], ["n_name"], null_safe=True).drop("k")


@query(
    "lookup_null_safe_shuffled",
    """
    WITH d AS (SELECT nullif(n_nationkey, 3) AS k, n_name FROM nation)
    SELECT s_suppkey, l_linenumber, n_name, count(*) AS n FROM (SELECT l_linenumber, l_suppkey AS s_suppkey,
      CASE WHEN l_linenumber > 2 THEN NULL ELSE l_suppkey % 25 END AS k FROM lineitem) l
    LEFT JOIN d ON l.k IS NOT DISTINCT FROM d.k GROUP BY ALL
    """,
)
def looked_up_null_safe_shuffled(spark, sf_dir):
    """The null key holds most of the rows, and the dimension counts as too large to broadcast."""
    nations = load(spark, sf_dir, "nation").selectExpr("nullif(n_nationkey, 3) AS k", "n_name")
    key = "CASE WHEN l_linenumber > 2 THEN NULL ELSE l_suppkey % 25 END"
    lines = load(spark, sf_dir, "lineitem").selectExpr("l_linenumber", "l_suppkey AS s_suppkey", f"cast({key} AS int) AS k")
    found = lookup(lines, nations, ["k"], ["n_name"], null_safe=True, max_broadcast_bytes=0)
    return found.groupBy("s_suppkey", "l_linenumber", "n_name").agg(F.count("*").alias("n"))


@query(
    "key_set_diff",
    """
    SELECT coalesce(c_custkey, k) AS k, CASE WHEN k IS NULL THEN 'left' ELSE 'right' END AS only_in
    FROM (SELECT DISTINCT c_custkey FROM customer) FULL JOIN (
      SELECT DISTINCT CASE WHEN o_totalprice > 200000 THEN o_custkey ELSE -o_custkey END AS k FROM orders) ON c_custkey = k
    WHERE c_custkey IS NULL OR k IS NULL
    """,
)
def key_diff(spark, sf_dir):
    """Both whole tables; keys of small orders are negative, so they are nobody's."""
    buyers = load(spark, sf_dir, "orders").selectExpr("CASE WHEN o_totalprice > 200000 THEN o_custkey ELSE -o_custkey END AS k")
    return key_set_diff(load(spark, sf_dir, "customer").selectExpr("c_custkey AS k"), buyers, ["k"])


@query(
    "key_set_diff_whole",
    """
    SELECT coalesce(c_custkey, k) AS k, CASE WHEN k IS NULL THEN 'left' ELSE 'right' END AS only_in
    FROM (SELECT DISTINCT c_custkey FROM customer) FULL JOIN (
      SELECT DISTINCT o_custkey + 7 AS k FROM orders) ON c_custkey = k
    WHERE c_custkey IS NULL OR k IS NULL
    """,
)
def key_diff_whole(spark, sf_dir):
    """Both whole tables; the keys of orders are shifted, so that either side has some of its own."""
    buyers = load(spark, sf_dir, "orders").selectExpr("o_custkey + 7 AS k")
    return key_set_diff(load(spark, sf_dir, "customer").selectExpr("c_custkey AS k"), buyers, ["k"])


@query(
    "append_rows",
    """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
    """,
)
def appended(spark, sf_dir):
    suppliers = load(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    customers = load(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment AS segment", "c_custkey AS id", "c_name AS name", "c_acctbal AS balance"
    )
    return append_rows(suppliers, customers)


@query(
    "distinct_union",
    """
    SELECT o_orderdate::DATE AS d FROM orders UNION SELECT l_shipdate::DATE FROM lineitem UNION SELECT ts::DATE FROM events
    """,
)
def all_days(spark, sf_dir):
    return distinct_union(
        [
            load(spark, sf_dir, table).select(F.to_date(column).alias("d"))
            for table, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
        ]
    )


@query(
    "dense_key",
    """
    SELECT row_number() OVER (ORDER BY o_orderpriority NULLS FIRST, o_orderdate NULLS FIRST, o_orderkey) AS order_no,
      o_orderkey, o_orderpriority, o_orderdate FROM orders
    """,
)
def keyed_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return dense_key(orders, "order_no", ["o_orderpriority", "o_orderdate"], ties=["o_orderkey"], distinct=True)


@query(
    "dense_key_repeated_rows",
    """
    SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS line_no, l_returnflag, l_linestatus FROM lineitem
    """,
)
def keyed_lines(spark, sf_dir):
    """Almost all rows are copies of a few."""
    lines = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    return dense_key(lines, "line_no", ["l_returnflag", "l_linestatus"])


@query(
    "continue_ids",
    """
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name, s_suppkey) AS c_custkey,
      s_name, s_suppkey FROM supplier
    """,
)
def continued(spark, sf_dir):
    new = load(spark, sf_dir, "supplier").select("s_name", "s_suppkey")
    return continue_ids(load(spark, sf_dir, "customer"), new, "c_custkey", ["s_name", "s_suppkey"], distinct=True)
