"""Means per customer for the marts, kept up to date by adding each increment of events to stored sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators.partials import fold_increments, merged_sums, store_increment
from churnkit.plans import warehouse as w

_KEYS = {"usage": [w.CUSTOMER, w.TIME], "network": [w.CUSTOMER, w.TIME], "calls": [w.CUSTOMER]}
_CALL_MEASURES = ("anger_rate", "call_duration_sec")


def call_sums(calls: DataFrame) -> DataFrame:
    """Calls, resolved calls, and sums and counts of the call measures, per customer."""
    return calls.groupBy(w.CUSTOMER).agg(
        F.count("*").alias("n_calls"),
        F.count_if(F.col("resolved") == "Yes").alias("n_resolved"),
        *[F.sum(m).alias(f"{m}_sum") for m in _CALL_MEASURES],
        *[F.count(m).alias(f"{m}_n") for m in _CALL_MEASURES],
    )


def add_events(root: str, increment: int, usage: DataFrame, network: DataFrame, calls: DataFrame) -> None:
    """Add one increment of events; only these are read. A retried increment replaces itself."""
    for name, sums in (("usage", w.usage_sums(usage)), ("network", w.network_sums(network)), ("calls", call_sums(calls))):
        store_increment(sums, f"{root}/{name}", increment)


def fold(spark: SparkSession, root: str) -> None:
    """Merge the increments so far, so that reading them does not slow down with their number."""
    for name, keys in _KEYS.items():
        fold_increments(spark, f"{root}/{name}", keys)


def usage_means(spark: SparkSession, root: str, dims: w.Tables) -> DataFrame:
    """As ``warehouse.usage_means_from_events`` over the events of all increments; pairs may be of two increments."""
    usage, network = (merged_sums(spark, f"{root}/{name}", _KEYS[name]) for name in ("usage", "network"))
    return w.usage_means_of_sums(usage, network, dims)


def care_means(spark: SparkSession, root: str, dims: w.Tables) -> DataFrame:
    """As ``warehouse.care_means`` over the calls of all increments."""
    per_customer = merged_sums(spark, f"{root}/calls", _KEYS["calls"])
    keyed = w.with_customer_key(per_customer, dims)
    sums = keyed.groupBy("customer_key").agg(*[F.sum(c).alias(c) for c in per_customer.columns if c != w.CUSTOMER])
    return sums.select(
        "customer_key",
        *[F.try_divide(f"{m}_sum", f"{m}_n").alias(f"avg_{m}") for m in _CALL_MEASURES],
        (F.col("n_resolved") / F.col("n_calls")).alias("resolution_rate"),
    )
