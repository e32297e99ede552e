"""Star schema: dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.operators.joins import lookup, salted_join
from churnkit.operators.keys import stable_keys
from churnkit.operators.order import dense_key
from churnkit.operators.project import distinct_union
from churnkit.operators.stats import conditional_rate, means_by_key
from churnkit.plans import values as v
from churnkit.scratch import materialize
from churnkit.together import together

CUSTOMER = "customer_id"
TIME = "event_time"
RUN_TIME = "pipeline_run_ts"
TIME_OF_DAY = "HH:mm:ss.SSSSSS"

Tables = Mapping[str, DataFrame]


def day_of(time: Column | str) -> Column:
    return F.to_date(time)


def time_of_day(time: Column | str) -> Column:
    """Time of day as text, since Spark has no cast from timestamp to a time type."""
    return F.date_format(time, TIME_OF_DAY)


# Dimensions


def dimension(df: DataFrame, key: str, attributes: Sequence[str], path: str | None = None) -> DataFrame:
    """Distinct attribute tuples with a dense key in their order, nulls first."""
    return dense_key(df.select(*attributes).distinct(), key, attributes, distinct=True, path=path)


def dim_customer(silver: DataFrame, path: str | None = None) -> DataFrame:
    return dimension(silver, "customer_key", v.CUSTOMER_ATTRIBUTES, path)


def dim_customer_loyalty(silver: DataFrame, path: str | None = None) -> DataFrame:
    return dimension(silver, "loyalty_key", v.LOYALTY_ATTRIBUTES, path)


def dim_device(silver: DataFrame, path: str | None = None) -> DataFrame:
    return dimension(silver, "device_key", v.DEVICE_ATTRIBUTES, path)


def _all_times(events: Sequence[DataFrame], run_times: DataFrame | None) -> list[DataFrame]:
    """Time columns of all event tables, and on request the run times cut to seconds."""
    times = [e.select(F.col(TIME).cast("timestamp").alias("t")) for e in events]
    if run_times is not None:
        times.append(run_times.select(F.date_trunc("second", RUN_TIME).alias("t")))
    return times


def dim_date(
    events: Sequence[DataFrame], run_times: DataFrame | None = None, path: str | None = None
) -> DataFrame:
    """One row per day with an event.

    There are at most a few million days on the calendar, so a plain window numbers them.
    """
    days = distinct_union([t.select(day_of("t").alias("full_date")) for t in _all_times(events, run_times)])
    number = F.row_number().over(Window.orderBy(F.col("full_date").asc_nulls_first()))
    numbered = days.select(
        number.cast("long").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        F.quarter("full_date").alias("quarter"),
    )
    return materialize(numbered, "dim_date", path)


def dim_time(
    events: Sequence[DataFrame], run_times: DataFrame | None = None, path: str | None = None
) -> DataFrame:
    """One row per time of day with an event."""
    times = distinct_union([t.select(time_of_day("t").alias("full_time")) for t in _all_times(events, run_times)])
    part = F.col("full_time")
    return dense_key(times, "time_key", ["full_time"], distinct=True, path=path).select(
        "time_key",
        "full_time",
        part.substr(1, 2).cast("int").alias("hour"),
        part.substr(4, 2).cast("int").alias("minute"),
        part.substr(7, 2).cast("int").alias("second"),
    )


def stable_dims(silver: DataFrame, root: str, load: int) -> dict[str, DataFrame]:
    """The dimensions with attribute tuples, whose keys stay as they are from one load to the next.

    ``root`` keeps the known keys; ``load`` numbers the loads in rising order, see ``stable_keys``.
    """
    models = {
        "dim_customer": ("customer_key", v.CUSTOMER_ATTRIBUTES),
        "dim_customer_loyalty": ("loyalty_key", v.LOYALTY_ATTRIBUTES),
        "dim_device": ("device_key", v.DEVICE_ATTRIBUTES),
    }
    return {name: stable_keys(silver, key, columns, f"{root}/{name}", load) for name, (key, columns) in models.items()}


def dim_issue_type(calls: DataFrame) -> DataFrame:
    return dimension(calls, "issue_type_key", ["issue_type"])


def dim_risk_level(risk: DataFrame) -> DataFrame:
    return dimension(risk, "risk_level_key", ["risk_level"])


def build_dims(
    staging: Tables, with_run_times: bool = False, kept_keys: tuple[str, int] | None = None
) -> dict[str, DataFrame]:
    """All dimensions from the staging tables ``silver``, ``usage``, ``network``, ``calls``, ``risk``.

    ``kept_keys``, the folder and the number of the load, keeps keys from load to load (``stable_dims``); without
    it every build numbers anew.
    """
    silver = staging["silver"]
    events = [staging[name] for name in ("usage", "network", "calls", "risk")]
    run_times = silver if with_run_times else None
    tasks = {
        "dim_date": lambda: dim_date(events, run_times),
        "dim_time": lambda: dim_time(events, run_times),
        "dim_issue_type": lambda: dim_issue_type(staging["calls"]),
        "dim_risk_level": lambda: dim_risk_level(staging["risk"]),
    }
    if kept_keys is None:
        tasks |= {
            "dim_customer": lambda: dim_customer(silver),
            "dim_customer_loyalty": lambda: dim_customer_loyalty(silver),
            "dim_device": lambda: dim_device(silver),
        }
        return together(silver.sparkSession, tasks)
    return together(silver.sparkSession, tasks) | stable_dims(silver, *kept_keys)


# Facts


def with_customer_key(df: DataFrame, dims: Tables) -> DataFrame:
    """Customer key by the number in the text id; junk ids find no customer."""
    cast_id = df.withColumn("_id", F.col(CUSTOMER).try_cast("bigint"))
    customers = dims["dim_customer"].select(F.col(CUSTOMER).cast("bigint").alias("_id"), "customer_key")
    return lookup(cast_id, customers, ["_id"], ["customer_key"]).drop("_id")


def with_time_keys(df: DataFrame, dims: Tables, time: str) -> DataFrame:
    """Date and time keys of a timestamp column."""
    t = F.col(time).cast("timestamp")
    keyed = df.withColumns({"full_date": day_of(t), "full_time": time_of_day(t)})
    keyed = lookup(keyed, dims["dim_date"], ["full_date"], ["date_key"])
    keyed = lookup(keyed, dims["dim_time"], ["full_time"], ["time_key"])
    return keyed.drop("full_date", "full_time")


def _event_fact(
    events: DataFrame,
    dims: Tables,
    key: str,
    measures: Sequence[str],
    ties: Sequence[str] | None,
    path: str | None,
) -> DataFrame:
    """Key, dimension keys and measures of one row per event, numbered by customer text and time.

    With ``ties`` the caller states that they make each row's place unique.
    """
    columns = ["customer_key", "date_key", "time_key", *measures]
    rows = with_time_keys(with_customer_key(events, dims), dims, TIME)
    rows = rows.select(CUSTOMER, TIME, *(ties or ()), *columns)
    return dense_key(
        rows, key, [CUSTOMER, TIME], ties=ties, distinct=ties is not None, keep=columns, path=path
    )


def fact_customer_care_call(
    calls: DataFrame, dims: Tables, ties: Sequence[str] | None = None, path: str | None = None
) -> DataFrame:
    return _event_fact(calls, dims, "call_key", v.CALL_MEASURES, ties, path)


def fact_churn_risk(
    risk: DataFrame, dims: Tables, ties: Sequence[str] | None = None, path: str | None = None
) -> DataFrame:
    return _event_fact(risk, dims, "risk_event_key", v.RISK_MEASURES, ties, path)


def join_usage_network(usage: DataFrame, network: DataFrame) -> DataFrame:
    """Each usage event with every network event of the same customer and time, or with none."""
    return salted_join(usage, network, [CUSTOMER, TIME], "left")


def fact_usage_network_event(
    usage: DataFrame,
    network: DataFrame,
    dims: Tables,
    ties: tuple[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """``ties`` names the event id of usage and of network rows (different names)."""
    ids = ties or ()
    left = usage.select(CUSTOMER, TIME, *ids[:1], *v.USAGE_MEASURES)
    right = network.select(CUSTOMER, TIME, *ids[1:], *v.NETWORK_MEASURES)
    pairs = join_usage_network(left, right)
    measures = [*v.USAGE_MEASURES, *v.NETWORK_MEASURES]
    return _event_fact(pairs, dims, "usage_network_event_key", measures, ties, path)


def fact_customer_snapshot(
    silver: DataFrame, dims: Tables, null_safe: bool = False, path: str | None = None
) -> DataFrame:
    """One row per silver row with the keys of all five dimensions.

    Plain equality leaves the key null where a device or loyalty attribute is null; ``null_safe``
    matches nulls too.
    """
    rows = lookup(silver, dims["dim_customer"], [CUSTOMER], ["customer_key"])
    rows = lookup(rows, dims["dim_device"], v.DEVICE_ATTRIBUTES, ["device_key"], null_safe)
    rows = lookup(rows, dims["dim_customer_loyalty"], v.LOYALTY_ATTRIBUTES, ["loyalty_key"], null_safe)
    rows = with_time_keys(rows, dims, RUN_TIME)
    keys = ["customer_key", "device_key", "loyalty_key", "date_key", "time_key"]
    columns = [*keys, *v.SNAPSHOT_MEASURES]
    # Silver and the customer dimension hold each customer once, so the id alone orders the rows.
    return dense_key(
        rows.select(CUSTOMER, *columns), "snapshot_key", [CUSTOMER], ties=keys, distinct=True,
        keep=columns, path=path,
    )


def build_facts(staging: Tables, dims: Tables, null_safe: bool = False) -> dict[str, DataFrame]:
    usage, network = staging["usage"], staging["network"]
    return together(
        usage.sparkSession,
        {
            "fact_customer_snapshot": lambda: fact_customer_snapshot(staging["silver"], dims, null_safe),
            "fact_customer_care_call": lambda: fact_customer_care_call(staging["calls"], dims),
            "fact_usage_network_event": lambda: fact_usage_network_event(usage, network, dims),
            "fact_churn_risk": lambda: fact_churn_risk(staging["risk"], dims),
        },
    )


# Marts


def usage_means(fact: DataFrame) -> DataFrame:
    """Mean usage and network measures per customer, over usage-network pairs."""
    return means_by_key(fact, ["customer_key"], v.USAGE_MEANS)


def usage_means_from_events(usage: DataFrame, network: DataFrame, dims: Tables) -> DataFrame:
    """Same as ``usage_means`` of the fact without forming a single pair.

    Both sides are summed per customer and time first. A usage sum counts once per network row it
    would meet (at least once), a network sum once per usage row.
    """

    return usage_means_of_sums(usage_sums(usage), network_sums(network), dims)


OF_USAGE = [m for m in v.USAGE_MEANS.values() if m in v.USAGE_MEASURES]
OF_NETWORK = [m for m in v.USAGE_MEANS.values() if m in v.NETWORK_MEASURES]


def _time_sums(df: DataFrame, measures: Sequence[str], n: str) -> DataFrame:
    totals = [F.sum(m).alias(f"{m}_sum") for m in measures]
    filled = [F.count(m).alias(f"{m}_n") for m in measures]
    return df.groupBy(CUSTOMER, TIME).agg(F.count("*").alias(n), *totals, *filled)


def usage_sums(usage: DataFrame) -> DataFrame:
    """Usage rows, and sums and counts of their measures, per customer and time."""
    return _time_sums(usage, OF_USAGE, "n_usage")


def network_sums(network: DataFrame) -> DataFrame:
    """The same of network events."""
    return _time_sums(network, OF_NETWORK, "n_net")


def usage_means_of_sums(usage: DataFrame, network: DataFrame, dims: Tables) -> DataFrame:
    """Mean per customer key over usage-network pairs, from ``usage_sums`` and ``network_sums``."""
    wanted = list(v.USAGE_MEANS.values())
    met = usage.join(network, [CUSTOMER, TIME], "left")
    weight = {m: F.coalesce("n_net", F.lit(1)) for m in OF_USAGE} | {m: F.col("n_usage") for m in OF_NETWORK}
    per_customer = met.groupBy(CUSTOMER).agg(
        *[F.sum(F.col(f"{m}_{part}") * weight[m]).alias(f"{m}_{part}") for m in wanted for part in ("sum", "n")]
    )
    # Ids without a customer share the null key, so sums meet once more.
    sums_by_key = with_customer_key(per_customer, dims).groupBy("customer_key").agg(
        *[F.sum(f"{m}_{part}").alias(f"{m}_{part}") for m in wanted for part in ("sum", "n")]
    )
    return sums_by_key.select(
        "customer_key",
        *[F.try_divide(f"{m}_sum", f"{m}_n").alias(name) for name, m in v.USAGE_MEANS.items()],
    )


def care_means(calls: DataFrame) -> DataFrame:
    """Mean call measures and resolution rate per customer."""
    return calls.groupBy("customer_key").agg(
        F.avg("anger_rate").alias("avg_anger_rate"),
        F.avg("call_duration_sec").alias("avg_call_duration_sec"),
        conditional_rate(F.col("resolved") == "Yes").alias("resolution_rate"),
    )


def _snapshot_star(snapshot: DataFrame, dims: Tables, customer, loyalty, device) -> DataFrame:
    rows = lookup(snapshot, dims["dim_customer"], ["customer_key"], customer)
    rows = lookup(rows, dims["dim_customer_loyalty"], ["loyalty_key"], loyalty)
    return lookup(rows, dims["dim_device"], ["device_key"], device)


def mart_customer_overview(
    snapshot: DataFrame, dims: Tables, usage: DataFrame, care: DataFrame
) -> DataFrame:
    """One row per snapshot row; ``usage`` and ``care`` are means per customer key.

    The means are aggregated before they are joined, so no row multiplies.
    """
    snapshot = snapshot.select("customer_key", "loyalty_key", "device_key", *v.OVERVIEW_SNAPSHOT)
    rows = snapshot.join(usage, ["customer_key"], "left").join(care, ["customer_key"], "left")
    rows = _snapshot_star(rows, dims, v.OVERVIEW_CUSTOMER, v.OVERVIEW_LOYALTY, v.OVERVIEW_DEVICE)
    return rows.select(
        "customer_key",
        *v.OVERVIEW_SNAPSHOT,
        *v.OVERVIEW_CUSTOMER,
        *v.OVERVIEW_LOYALTY,
        *v.OVERVIEW_DEVICE,
        *v.USAGE_MEANS,
        "resolution_rate",
        "avg_call_duration_sec",
        "avg_anger_rate",
    )


def mart_network_service_quality(snapshot: DataFrame, dims: Tables, usage: DataFrame) -> DataFrame:
    """One row per snapshot row with its network experience."""
    snapshot = snapshot.select("customer_key", "loyalty_key", "device_key", *v.QUALITY_SNAPSHOT)
    rows = snapshot.join(usage, ["customer_key"], "left")
    rows = _snapshot_star(rows, dims, v.QUALITY_CUSTOMER, v.QUALITY_LOYALTY, v.OVERVIEW_DEVICE)
    return rows.select(
        "customer_key",
        *v.QUALITY_CUSTOMER,
        *v.QUALITY_LOYALTY,
        *v.OVERVIEW_DEVICE,
        *v.QUALITY_SNAPSHOT,
        *v.USAGE_MEANS,
    )


def fact_means(facts: Tables) -> tuple[DataFrame, DataFrame]:
    """Usage and care means from the facts."""
    return usage_means(facts["fact_usage_network_event"]), care_means(facts["fact_customer_care_call"])


def build_marts(
    facts: Tables, dims: Tables, usage: DataFrame | None = None, care: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Both marts; the means come from the facts unless they are given, such as those of ``increments``."""
    if usage is None or care is None:
        of_facts = fact_means(facts)
        usage, care = usage or of_facts[0], care or of_facts[1]
    snapshot = facts["fact_customer_snapshot"]
    return {
        "mart_customer_overview": mart_customer_overview(snapshot, dims, usage, care),
        "mart_network_service_quality": mart_network_service_quality(snapshot, dims, usage),
    }
