"""Duplicates, imputation, outliers, caps, counts and quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, rounded
from checks.views import load
from churnkit.operators import (
    cap_two_sided,
    cap_upper,
    column_modes,
    conditional_rate,
    drop_exact_duplicates,
    event_rate,
    has_values,
    impute_constants,
    impute_median,
    impute_mode,
    keep_labels,
    means_by_key,
    missing_counts,
    one_row_per_key,
    outlier_columns,
    outlier_shares,
    profile,
    quantiles,
    require_rows,
    row_counts,
    topic_counts,
    value_counts,
)
from churnkit.operators.stats import any_negative, outside_share

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# A customer table with nulls and blanks put in by rule.
GAPPY_SQL = """
gappy AS (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS nation,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END AS segment
  FROM customer)
"""


def gappy(spark, sf_dir):
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        key,
        F.when(key % 7 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(key % 5 != 0, F.col("c_nationkey")).alias("nation"),
        F.when(key % 11 == 0, None).when(key % 13 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"),
    )


@query("drop_exact_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def exact_duplicates(spark, sf_dir):
    return drop_exact_duplicates(
        load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    )


@query(
    "one_row_per_key",
    """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1
    """,
)
def one_per_key(spark, sf_dir):
    return one_row_per_key(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "valid_labels",
    "SELECT c_custkey, c_nationkey AS label FROM customer WHERE c_custkey % 3 <> 0 AND c_nationkey IN (0, 1)",
)
def valid_labels(spark, sf_dir):
    label = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("label")
    return keep_labels(load(spark, sf_dir, "customer").select("c_custkey", label), "label")


@query(
    "not_missing",
    f"WITH {GAPPY_SQL} SELECT segment, count(*) AS n FROM gappy WHERE segment IS NOT NULL AND segment <> '' GROUP BY ALL",
)
def not_missing(spark, sf_dir):
    df = gappy(spark, sf_dir)
    return value_counts(df.filter(has_values(df, "segment")), "segment")


@query(
    "missing_counts",
    f"""
    WITH {GAPPY_SQL} SELECT count(*) FILTER (c_custkey IS NULL) AS c_custkey,
      count(*) FILTER (balance IS NULL) AS balance, count(*) FILTER (nation IS NULL) AS nation,
      count(*) FILTER (segment IS NULL OR segment = '') AS segment FROM gappy
    """,
)
def missing(spark, sf_dir):
    return missing_counts(gappy(spark, sf_dir))


@query(
    "impute_median",
    f"""
    WITH {GAPPY_SQL}, m AS (SELECT quantile_disc(balance, 0.5) AS b, quantile_disc(nation, 0.5) AS n FROM gappy)
    SELECT c_custkey, coalesce(balance, b) AS balance, coalesce(nation, n) AS nation, segment FROM gappy, m
    """,
)
def median_filled(spark, sf_dir):
    return impute_median(gappy(spark, sf_dir), ["balance", "nation"], rel_error=0)


@query(
    "impute_mode",
    f"""
    WITH {GAPPY_SQL}, m AS (SELECT segment AS top FROM gappy WHERE segment <> '' GROUP BY segment
      ORDER BY count(*) DESC, segment LIMIT 1)
    SELECT c_custkey, balance, nation, coalesce(segment, top) AS segment FROM gappy, m
    """,
)
def mode_filled(spark, sf_dir):
    return impute_mode(gappy(spark, sf_dir), ["segment"])


@query(
    "impute_constants",
    f"""
    WITH {GAPPY_SQL} SELECT c_custkey, coalesce(balance, -1.0) AS balance, coalesce(nation, 0) AS nation,
      coalesce(segment, 'Unknown') AS segment FROM gappy
    """,
)
def constant_filled(spark, sf_dir):
    return impute_constants(gappy(spark, sf_dir), {"balance": -1, "nation": 0, "segment": "Unknown"})


@query(
    "column_modes",
    """
    WITH c AS (
      SELECT 'l_returnflag' AS column_name, l_returnflag AS top_value, count(*) AS n FROM lineitem GROUP BY l_returnflag
      UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY l_linestatus)
    SELECT column_name, top_value FROM c
    QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, top_value) = 1
    """,
)
def modes(spark, sf_dir):
    found = column_modes(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])
    return spark.createDataFrame(list(found.items()), "column_name string, top_value string")


@query(
    "quantiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, quantile_disc({c}, 0.01) AS p1, quantile_disc({c}, 0.25) AS p25,
        quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.75) AS p75, quantile_disc({c}, 0.99) AS p99 FROM lineitem"""
        for c in LINE_NUMBERS
    ),
)
def line_quantiles(spark, sf_dir):
    marks = quantiles(load(spark, sf_dir, "lineitem"), LINE_NUMBERS, [0.01, 0.25, 0.5, 0.75, 0.99], rel_error=0)
    return spark.createDataFrame(
        [(c, *m) for c, m in marks.items()],
        "column_name string, p1 double, p25 double, p50 double, p75 double, p99 double",
    )


@query(
    "quantiles_infinite",
    """
    WITH x AS (SELECT CASE event_id % 5 WHEN 0 THEN 'Infinity'::DOUBLE WHEN 1 THEN '-Infinity'::DOUBLE ELSE value END AS v FROM events)
    SELECT quantile_disc(v, 0.1) = '-Infinity'::DOUBLE AS p10_low, quantile_disc(v, 0.5) AS p50,
      quantile_disc(v, 0.9) = 'Infinity'::DOUBLE AS p90_high FROM x
    """,
)
def quantiles_infinite(spark, sf_dir):
    """Exact quantiles where a fifth of the values is infinite at either end."""
    value = "CASE event_id % 5 WHEN 0 THEN double('Infinity') WHEN 1 THEN double('-Infinity') ELSE value END AS v"
    low, middle, high = quantiles(load(spark, sf_dir, "events").selectExpr(value), ["v"], [0.1, 0.5, 0.9], rel_error=0)["v"]
    return spark.createDataFrame(
        [(low == float("-inf"), middle, high == float("inf"))], "p10_low boolean, p50 double, p90_high boolean"
    )


@query(
    "quantile_rank_error",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS prob, count(*) AS n, true AS within FROM lineitem"
        for c in LINE_NUMBERS
        for p in (0.01, 0.25, 0.5, 0.75, 0.99)
    ),
)
def quantile_rank_error(spark, sf_dir):
    """The sketch that jobs use: the share of rows at or below each mark, and below it, is within the stated error."""
    lines, probs, error = load(spark, sf_dir, "lineitem"), [0.01, 0.25, 0.5, 0.75, 0.99], 0.01
    marks = quantiles(lines, LINE_NUMBERS, probs, rel_error=error)
    judged = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(p).alias("prob"),
            F.count("*").alias("n"),
            ((F.avg((F.col(c) <= m).cast("int")) >= p - error) & (F.avg((F.col(c) < m).cast("int")) <= p + error)).alias("within"),
        )
        for c in LINE_NUMBERS
        for p, m in zip(probs, marks[c], strict=True)
    ]
    return lines.agg(F.array(*judged).alias("rows")).select(F.inline("rows"))


@query(
    "profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, quantile_disc({c}, 0.25) AS p25,
        quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.75) AS p75, max({c}) AS max FROM lineitem"""
        for c in LINE_NUMBERS
    ),
)
def line_profile(spark, sf_dir):
    return rounded(profile(load(spark, sf_dir, "lineitem"), LINE_NUMBERS, rel_error=0))


def _share_sql(column: str, table: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, round(avg(CASE WHEN {column} < q1 - 1.5 * (q3 - q1)
      OR {column} > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END), 6) AS share
    FROM {table}, (SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {table}) q
    """


# Skewed by squaring, so that some columns have outliers and some have none.
SPREAD_SQL = "SELECT value, value * value AS value_squared, user_id, event_id FROM events"
SPREAD = ["value", "value_squared", "user_id", "event_id"]
SHARES_SQL = f"WITH spread AS ({SPREAD_SQL}) " + " UNION ALL ".join(_share_sql(c, "spread") for c in SPREAD)


def spread(spark, sf_dir):
    return load(spark, sf_dir, "events").selectExpr("value", "value * value AS value_squared", "user_id", "event_id")


@query("outlier_shares", SHARES_SQL)
def shares(spark, sf_dir):
    found = outlier_shares(spread(spark, sf_dir), SPREAD, rel_error=0)
    return rounded(spark.createDataFrame(list(found.items()), "column_name string, share double"))


@query("outlier_columns", f"SELECT column_name FROM ({SHARES_SQL}) WHERE share > 0.01")
def outliers(spark, sf_dir):
    found = outlier_columns(spread(spark, sf_dir), SPREAD, rel_error=0)
    return spark.createDataFrame([(c,) for c in found], "column_name string")


@query(
    "outside_share",
    "SELECT event_type, round(avg(CASE WHEN value < 5 OR value > 100 THEN 1.0 ELSE 0.0 END), 6) AS share FROM events GROUP BY event_type",
)
def outside(spark, sf_dir):
    return rounded(
        load(spark, sf_dir, "events").groupBy("event_type").agg(outside_share("value", 5, 100).alias("share"))
    )


@query(
    "cap_upper",
    """
    SELECT event_id, least(value, (SELECT quantile_disc(value, 0.99) FROM events)) AS value FROM events
    """,
)
def capped_above(spark, sf_dir):
    return cap_upper(load(spark, sf_dir, "events").select("event_id", "value"), ["value"], rel_error=0)


@query(
    "cap_two_sided",
    """
    SELECT c_custkey, greatest(least(c_acctbal, q99), q01) AS c_acctbal FROM customer,
      (SELECT quantile_disc(c_acctbal, 0.01) AS q01, quantile_disc(c_acctbal, 0.99) AS q99 FROM customer)
    """,
)
def capped_both(spark, sf_dir):
    return cap_two_sided(load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"], rel_error=0)


@query(
    "any_negative",
    """
    SELECT name AS column_name FROM (VALUES ('c_acctbal', (SELECT min(c_acctbal) FROM customer)),
      ('c_nationkey', (SELECT min(c_nationkey) FROM customer))) t(name, low) WHERE low < 0
    """,
)
def negatives(spark, sf_dir):
    found = any_negative(load(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])
    return spark.createDataFrame([(c,) for c in found], "column_name string")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def type_counts(spark, sf_dir):
    return value_counts(load(spark, sf_dir, "events"), "event_type")


COUNTED = ["customer", "orders", "lineitem", "events"]


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED),
)
def counts(spark, sf_dir):
    found = row_counts({t: load(spark, sf_dir, t) for t in COUNTED})
    return spark.createDataFrame(list(found.items()), "table_name string, n_rows long")


@query("row_gate", "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders")
def gate(spark, sf_dir):
    n = require_rows(load(spark, sf_dir, "orders"), "orders")
    return spark.createDataFrame([("orders", n)], "table_name string, n_rows long")


@query(
    "topic_counts",
    """
    SELECT event_type AS topic, count(*) AS n_rows, count(DISTINCT user_id) AS n_customers FROM events GROUP BY event_type
    """,
)
def per_topic(spark, sf_dir):
    renamed = load(spark, sf_dir, "events").withColumnsRenamed({"event_type": "topic", "user_id": "customer_id"})
    return topic_counts(renamed)


@query(
    "event_rate",
    """
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events,
      round(count(*) / 3600.0, 6) AS events_per_sec FROM events GROUP BY ALL
    """,
)
def rate(spark, sf_dir):
    return rounded(event_rate(load(spark, sf_dir, "events"), "ts", "1 hour", 3600, ["event_type"]))


@query(
    "means_by_customer",
    """
    SELECT user_id, round(avg(value), 6) AS avg_value, round(avg(length(props)), 6) AS avg_length
    FROM events GROUP BY user_id
    """,
)
def means(spark, sf_dir):
    rows = load(spark, sf_dir, "events").withColumn("length", F.length("props"))
    return rounded(means_by_key(rows, ["user_id"], {"avg_value": "value", "avg_length": "length"}))


@query(
    "resolution_rate",
    """
    SELECT user_id, round(avg(CASE WHEN nullif(event_type, 'view') = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate
    FROM events GROUP BY user_id
    """,
)
def resolution(spark, sf_dir):
    """Share of rows for which a condition holds; a null counts as not."""
    rows = load(spark, sf_dir, "events").groupBy("user_id")
    return rounded(rows.agg(conditional_rate(F.expr("nullif(event_type, 'view') = 'error'")).alias("error_rate")))
