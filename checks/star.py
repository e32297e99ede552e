"""Star schema and dashboard questions."""

from __future__ import annotations

from checks.combining import LATEST_SQL
from checks.registry import ORACLES, query, rounded
from checks.views import ctes, customers, events, silver, view
from churnkit.plans import insights, warehouse
from churnkit.plans import values as v
from churnkit.plans.scoring import score_customers
from churnkit.scratch import materialize
from churnkit.together import together

SCORED_SQL = (
    ",".join(LATEST_SQL.format(n) for n in ("calls", "network", "usage"))
    + """, points AS (
  SELECT c.customer_id, c.event_time,
    CASE WHEN anger_rate > 7 THEN 30 ELSE 0 END + CASE WHEN resolved = 'No' THEN 20 ELSE 0 END
    + CASE WHEN dropped_calls > 2 THEN 20 ELSE 0 END + CASE WHEN outage_flag = 1 THEN 15 ELSE 0 END
    + CASE WHEN package_usage_pct < 20 THEN 15 ELSE 0 END AS churn_score
  FROM calls_latest c LEFT JOIN network_latest n USING (customer_id) LEFT JOIN usage_latest u USING (customer_id)),
scored AS (SELECT customer_id, churn_score,
    CASE WHEN churn_score >= 60 THEN 'High' WHEN churn_score >= 30 THEN 'Medium' ELSE 'Low' END AS risk_level,
    event_time FROM points)
"""
)
EVENT_VIEWS = ("calls", "network", "usage")
SCORED = ctes(*EVENT_VIEWS, more=SCORED_SQL)


def scored(spark, sf_dir):
    return score_customers(*events(spark, sf_dir), ties=["event_id"])


@query("churn_score", SCORED + "SELECT * FROM scored")
def churn_score(spark, sf_dir):
    return scored(spark, sf_dir)


@query(
    "risk_distribution",
    SCORED
    + "SELECT risk_level, count(*) AS n_customers, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM scored GROUP BY risk_level",
)
def risk_distribution(spark, sf_dir):
    return rounded(insights.risk_distribution(scored(spark, sf_dir)))


@query(
    "top_risk",
    SCORED + "SELECT * FROM scored WHERE risk_level = 'High' ORDER BY churn_score DESC, customer_id LIMIT 20",
)
def top_risk(spark, sf_dir):
    return insights.top_risk(scored(spark, sf_dir))


@query(
    "score_trend",
    SCORED
    + """
    SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start, round(avg(churn_score), 6) AS avg_score,
      count(*) AS n_scores FROM scored GROUP BY 1
    """,
)
def score_trend(spark, sf_dir):
    return rounded(insights.score_trend(scored(spark, sf_dir)))


@query(
    "issue_resolution",
    ctes("calls")
    + """
    SELECT issue_type, count(*) AS n_calls, round(avg(anger_rate), 6) AS avg_anger_rate,
      round(avg(call_duration_sec), 6) AS avg_call_duration_sec,
      round(avg(CASE WHEN resolved = 'Yes' THEN 1.0 ELSE 0.0 END), 6) AS resolution_rate
    FROM calls GROUP BY issue_type
    """,
)
def issue_resolution(spark, sf_dir):
    return rounded(insights.issue_resolution(view(spark, sf_dir, "calls")))


NETWORK_TREND_SQL = (
    ctes("network")
    + """
    SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start, count(*) AS n_events,
      round(avg(signal_strength), 6) AS avg_signal_strength, round(avg(internet_speed), 6) AS avg_internet_speed,
      sum(dropped_calls)::BIGINT AS dropped_calls, round(avg(CASE WHEN outage_flag = 1 THEN 1.0 ELSE 0.0 END), 6) AS outage_share
    FROM network GROUP BY 1
    """
)


@query("network_trend", NETWORK_TREND_SQL)
def network_trend(spark, sf_dir):
    return rounded(insights.network_trend(view(spark, sf_dir, "network")))


@query(
    "segment_churn",
    ctes("silver")
    + "SELECT customer_loyalty, clv_segment, count(*) AS n_customers, round(avg(churn), 6) AS churn_rate FROM silver GROUP BY ALL",
)
def segment_churn(spark, sf_dir):
    return rounded(insights.segment_churn(silver(spark, sf_dir)))


DRIVERS = "customer_loyalty clv_segment network_quality data_experience overage_status device_age asl_flag".split()


@query(
    "churn_drivers",
    ctes("silver")
    + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, {a} AS level, count(*) AS n_customers, round(avg(churn), 6) AS churn_rate FROM silver GROUP BY {a}"
        for a in DRIVERS
    ),
)
def churn_drivers(spark, sf_dir):
    return rounded(insights.churn_drivers(silver(spark, sf_dir), DRIVERS))


@query(
    "revenue_at_risk",
    ctes("silver")
    + """
    SELECT clv_segment, round(risk, 2) AS revenue_at_risk, round(revenue, 2) AS revenue,
      round(risk / sum(risk) OVER (), 2) AS share_of_risk
    FROM (SELECT clv_segment, sum(CASE WHEN churn = 1 THEN avgrev ELSE 0.0 END) AS risk, sum(avgrev) AS revenue
      FROM silver GROUP BY clv_segment)
    """,
)
def revenue_at_risk(spark, sf_dir):
    return rounded(insights.revenue_at_risk(silver(spark, sf_dir)), 2)


@query(
    "area_quality",
    ctes("silver")
    + """
    SELECT area, network_quality, count(*) AS n_customers, round(avg(data_failure_rate), 6) AS avg_data_failure_rate,
      round(count(*) / sum(count(*)) OVER (PARTITION BY area), 6) AS share_in_area
    FROM silver GROUP BY area, network_quality
    """,
)
def area_quality(spark, sf_dir):
    return rounded(insights.area_quality(silver(spark, sf_dir)))


# Star schema


def _dim_sql(name: str, key: str, attributes: list[str], source: str) -> str:
    order = ", ".join(f"{a} NULLS FIRST" for a in attributes)
    columns = ", ".join(attributes)
    return (
        f"{name} AS (SELECT row_number() OVER (ORDER BY {order}) AS {key}, {columns} "
        f"FROM (SELECT DISTINCT {columns} FROM {source}))"
    )


DIM_CUSTOMER = _dim_sql("dim_customer", "customer_key", v.CUSTOMER_ATTRIBUTES, "silver")
DIM_LOYALTY = _dim_sql("dim_customer_loyalty", "loyalty_key", v.LOYALTY_ATTRIBUTES, "silver")
DIM_DEVICE = _dim_sql("dim_device", "device_key", v.DEVICE_ATTRIBUTES, "silver")
TIMES = "event_times AS (" + " UNION ALL ".join(f"SELECT event_time AS t FROM {e}" for e in (*EVENT_VIEWS, "scored")) + ")"
DIM_DATE = """
dim_date AS (SELECT row_number() OVER (ORDER BY full_date) AS date_key, full_date, year(full_date)::INTEGER AS year,
  month(full_date)::INTEGER AS month, day(full_date)::INTEGER AS day, quarter(full_date)::INTEGER AS quarter
  FROM (SELECT DISTINCT t::DATE AS full_date FROM event_times))
"""
DIM_TIME = """
dim_time AS (SELECT row_number() OVER (ORDER BY full_time) AS time_key, full_time,
  substr(full_time, 1, 2)::INTEGER AS hour, substr(full_time, 4, 2)::INTEGER AS minute,
  substr(full_time, 7, 2)::INTEGER AS second
  FROM (SELECT DISTINCT strftime(t, '%H:%M:%S.%f') AS full_time FROM event_times))
"""
EVENT_DIMS = ", ".join((SCORED_SQL, TIMES, DIM_DATE, DIM_TIME))
ALL_DIMS = ", ".join((EVENT_DIMS, DIM_CUSTOMER, DIM_LOYALTY, DIM_DEVICE))


def _event_joins(alias: str) -> str:
    return f"""
    LEFT JOIN dim_customer dc ON TRY_CAST({alias}.customer_id AS BIGINT) = dc.customer_id
    LEFT JOIN dim_date dd ON {alias}.event_time::DATE = dd.full_date
    LEFT JOIN dim_time dt ON strftime({alias}.event_time, '%H:%M:%S.%f') = dt.full_time
    """


FACT_CALL = f"""
fact_call AS (SELECT row_number() OVER (ORDER BY e.customer_id, e.event_time, e.event_id) AS call_key,
  customer_key, date_key, time_key, issue_type, anger_rate, call_duration_sec, resolved
  FROM calls e {_event_joins("e")})
"""
FACT_RISK = f"""
fact_risk AS (SELECT row_number() OVER (ORDER BY e.customer_id, e.event_time) AS risk_event_key,
  customer_key, date_key, time_key, risk_level, churn_score FROM scored e {_event_joins("e")})
"""
FACT_USAGE = f"""
fact_usage AS (SELECT row_number() OVER (ORDER BY e.customer_id, e.event_time, e.event_id, n.event_id NULLS FIRST)
    AS usage_network_event_key, customer_key, date_key, time_key, voice_minutes, data_usage_mb, sms_count,
  package_usage_pct, signal_strength, dropped_calls, internet_speed, outage_flag
  FROM usage e LEFT JOIN network n ON e.customer_id = n.customer_id AND e.event_time = n.event_time
  {_event_joins("e")})
"""
FACT_SNAPSHOT = f"""
fact_snapshot AS (SELECT row_number() OVER (ORDER BY s.customer_id) AS snapshot_key,
  customer_key, device_key, loyalty_key, date_key, time_key, {", ".join(v.SNAPSHOT_MEASURES)}
  FROM silver s LEFT JOIN dim_customer dc ON s.customer_id = dc.customer_id
  LEFT JOIN dim_device d ON s.device_age = d.device_age AND s.refurb_new = d.refurb_new AND s.eqpdays = d.eqpdays
  LEFT JOIN dim_customer_loyalty l ON s.customer_loyalty = l.customer_loyalty AND s.clv_segment = l.clv_segment
    AND s.crclscod = l.crclscod AND s.crclscod_bin = l.crclscod_bin AND s.asl_flag = l.asl_flag
  LEFT JOIN dim_date dd ON s.pipeline_run_ts::DATE = dd.full_date
  LEFT JOIN dim_time dt ON strftime(s.pipeline_run_ts, '%H:%M:%S.%f') = dt.full_time)
"""
MEANS_SQL = """
usage_means AS (SELECT customer_key, avg(data_usage_mb) AS avg_data_usage_mb, avg(signal_strength) AS avg_signal_strength,
  avg(internet_speed) AS avg_internet_speed, avg(package_usage_pct) AS avg_package_usage_pct
  FROM fact_usage GROUP BY customer_key),
care_means AS (SELECT customer_key, avg(anger_rate) AS avg_anger_rate, avg(call_duration_sec) AS avg_call_duration_sec,
  avg(CASE WHEN resolved = 'Yes' THEN 1.0 ELSE 0.0 END) AS resolution_rate FROM fact_call GROUP BY customer_key)
"""


def _rounded_columns(columns: list[str], doubles: set[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in doubles else c for c in columns)


# Measures that carry more digits than both engines agree on.
LONG_DOUBLES = {"rev_mean", "totrev", "adjrev", "avgrev", "change_rev", "change_mou", "mou_mean", "adjmou"}
MEANS = {*v.USAGE_MEANS, "resolution_rate", "avg_call_duration_sec", "avg_anger_rate"}


def event_tables(spark, sf_dir):
    """Usage, network, calls and scores, the tables the date and time dimensions come from."""
    calls, network, usage = events(spark, sf_dir)
    return usage, network, calls, materialize(scored(spark, sf_dir), "scored")


def silver_table(spark, sf_dir):
    return materialize(silver(spark, sf_dir), "silver")


def tables_and_silver(spark, sf_dir):
    built = together(
        spark,
        {"tables": lambda: event_tables(spark, sf_dir), "silver": lambda: silver_table(spark, sf_dir)},
    )
    return built["tables"], built["silver"]


def event_dims(tables, silver_rows):
    return together(
        silver_rows.sparkSession,
        {
            "dim_customer": lambda: warehouse.dim_customer(silver_rows),
            "dim_date": lambda: warehouse.dim_date(tables),
            "dim_time": lambda: warehouse.dim_time(tables),
        },
    )


def all_dims(tables, silver_rows):
    built = together(
        silver_rows.sparkSession,
        {
            "events": lambda: event_dims(tables, silver_rows),
            "dim_customer_loyalty": lambda: warehouse.dim_customer_loyalty(silver_rows),
            "dim_device": lambda: warehouse.dim_device(silver_rows),
        },
    )
    return built.pop("events") | built


@query("dim_customer", ctes("silver", more=DIM_CUSTOMER) + "SELECT * FROM dim_customer")
def dim_customer(spark, sf_dir):
    return warehouse.dim_customer(customers(spark, sf_dir))


@query("dim_customer_loyalty", ctes("silver", more=DIM_LOYALTY) + "SELECT * FROM dim_customer_loyalty")
def dim_customer_loyalty(spark, sf_dir):
    return warehouse.dim_customer_loyalty(silver(spark, sf_dir))


@query("dim_device", ctes("silver", more=DIM_DEVICE) + "SELECT * FROM dim_device")
def dim_device(spark, sf_dir):
    return warehouse.dim_device(customers(spark, sf_dir))


@query("dim_date", ctes(*EVENT_VIEWS, more=EVENT_DIMS) + "SELECT * FROM dim_date")
def dim_date(spark, sf_dir):
    return warehouse.dim_date(event_tables(spark, sf_dir))


@query("dim_time", ctes(*EVENT_VIEWS, more=EVENT_DIMS) + "SELECT * FROM dim_time")
def dim_time(spark, sf_dir):
    return warehouse.dim_time(event_tables(spark, sf_dir))


@query(
    "dim_issue_type",
    ctes("calls", more=_dim_sql("d", "issue_type_key", ["issue_type"], "calls")) + "SELECT * FROM d",
)
def dim_issue_type(spark, sf_dir):
    return warehouse.dim_issue_type(view(spark, sf_dir, "calls"))


@query(
    "dim_risk_level",
    ctes(*EVENT_VIEWS, more=SCORED_SQL + "," + _dim_sql("d", "risk_level_key", ["risk_level"], "scored"))
    + "SELECT * FROM d",
)
def dim_risk_level(spark, sf_dir):
    return warehouse.dim_risk_level(scored(spark, sf_dir))


@query(
    "fact_customer_care_call",
    ctes("silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_CALL}") + "SELECT * FROM fact_call",
)
def fact_customer_care_call(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    dims = event_dims(tables, customers(spark, sf_dir))
    return warehouse.fact_customer_care_call(tables[2], dims, ties=["event_id"])


@query(
    "fact_churn_risk",
    ctes("silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_RISK}") + "SELECT * FROM fact_risk",
)
def fact_churn_risk(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    dims = event_dims(tables, customers(spark, sf_dir))
    return warehouse.fact_churn_risk(tables[3], dims)


def usage_fact(tables, dims):
    usage = tables[0].withColumnRenamed("event_id", "usage_id")
    network = tables[1].withColumnRenamed("event_id", "network_id")
    return warehouse.fact_usage_network_event(usage, network, dims, ties=("usage_id", "network_id"))


@query(
    "fact_usage_network_event",
    ctes("silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_USAGE}") + "SELECT * FROM fact_usage",
)
def fact_usage_network_event(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    return usage_fact(tables, event_dims(tables, customers(spark, sf_dir)))


SNAPSHOT_KEYS = "snapshot_key customer_key device_key loyalty_key date_key time_key".split()


@query(
    "fact_customer_snapshot",
    ctes("silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_SNAPSHOT}")
    + f"SELECT {_rounded_columns([*SNAPSHOT_KEYS, *v.SNAPSHOT_MEASURES], LONG_DOUBLES)} FROM fact_snapshot",
)
def fact_customer_snapshot(spark, sf_dir):
    tables, silver_rows = tables_and_silver(spark, sf_dir)
    return rounded(warehouse.fact_customer_snapshot(silver_rows, all_dims(tables, silver_rows)))


@query(
    "usage_means",
    ctes("silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_USAGE}, {FACT_CALL}, {MEANS_SQL}")
    + f"SELECT {_rounded_columns(['customer_key', *v.USAGE_MEANS], MEANS)} FROM usage_means",
)
def usage_means(spark, sf_dir):
    """Means over usage-network pairs without forming the pairs."""
    _, network, usage = events(spark, sf_dir)
    dims = {"dim_customer": warehouse.dim_customer(customers(spark, sf_dir))}
    return rounded(warehouse.usage_means_from_events(usage, network, dims))


MART_JOINS = """
FROM fact_snapshot f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
LEFT JOIN dim_customer_loyalty l ON f.loyalty_key = l.loyalty_key
LEFT JOIN dim_device d ON f.device_key = d.device_key
LEFT JOIN usage_means u ON f.customer_key = u.customer_key
LEFT JOIN care_means ca ON f.customer_key = ca.customer_key
"""
MARTS = ctes(
    "silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_USAGE}, {FACT_CALL}, {FACT_SNAPSHOT}, {MEANS_SQL}"
)


def _mart_sql(name: str, snapshot: list[str], customer: list[str], loyalty: list[str], means: list[str]) -> str:
    columns = [
        "f.customer_key",
        *[f"f.{c}" for c in snapshot],
        *[f"c.{c}" for c in customer],
        *[f"l.{c}" for c in loyalty],
        *[f"d.{c}" for c in v.OVERVIEW_DEVICE],
        *means,
    ]
    plain = [c.split(".")[-1] for c in columns]
    chosen = _rounded_columns(plain, LONG_DOUBLES | MEANS)
    return f"SELECT {chosen} FROM (SELECT {', '.join(columns)} {MART_JOINS})"


def mart_inputs(spark, sf_dir, with_calls):
    """Dimensions, and what the marts take from facts: snapshot, usage means and care means."""
    tables, silver_rows = tables_and_silver(spark, sf_dir)
    dims = all_dims(tables, silver_rows)
    tasks = {
        "snapshot": lambda: warehouse.fact_customer_snapshot(silver_rows, dims),
        "usage": lambda: warehouse.usage_means_from_events(tables[0], tables[1], dims),
    }
    if with_calls:
        tasks["calls"] = lambda: warehouse.fact_customer_care_call(tables[2], dims, ties=["event_id"])
    return dims, together(spark, tasks)


@query(
    "mart_customer_overview",
    MARTS
    + _mart_sql(
        "overview", v.OVERVIEW_SNAPSHOT, v.OVERVIEW_CUSTOMER, v.OVERVIEW_LOYALTY,
        [*v.USAGE_MEANS, "resolution_rate", "avg_call_duration_sec", "avg_anger_rate"],
    ),
)
def mart_customer_overview(spark, sf_dir):
    dims, built = mart_inputs(spark, sf_dir, with_calls=True)
    care = warehouse.care_means(built["calls"])
    return rounded(warehouse.mart_customer_overview(built["snapshot"], dims, built["usage"], care))


@query("built_customer_overview", ORACLES["mart_customer_overview"])
def built_customer_overview(spark, sf_dir):
    """The same mart by the builders that the warehouse job runs: no event ids, means taken from the facts."""
    tables, silver_rows = tables_and_silver(spark, sf_dir)
    usage, network, calls, risk = (t.drop("event_id") for t in tables)
    staging = {"silver": silver_rows, "usage": usage, "network": network, "calls": calls, "risk": risk}
    dims = warehouse.build_dims(staging)
    marts = warehouse.build_marts(warehouse.build_facts(staging, dims), dims)
    return rounded(marts["mart_customer_overview"])


@query(
    "mart_network_service_quality",
    MARTS + _mart_sql("quality", v.QUALITY_SNAPSHOT, v.QUALITY_CUSTOMER, v.QUALITY_LOYALTY, list(v.USAGE_MEANS)),
)
def mart_network_service_quality(spark, sf_dir):
    dims, built = mart_inputs(spark, sf_dir, with_calls=False)
    return rounded(warehouse.mart_network_service_quality(built["snapshot"], dims, built["usage"]))
