"""Churn score from the latest call, network and usage event of each customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.rules import rule_points, tier
from churnkit.operators.joins import left_chain
from churnkit.operators.latest import latest_per_key
from churnkit.plans import values as v

CUSTOMER = "customer_id"
TIME = "event_time"


def with_score(df: DataFrame) -> DataFrame:
    """Add ``churn_score`` and ``risk_level``; a missing measure adds no points."""
    scored = df.withColumn("churn_score", rule_points(v.SCORE_RULES))
    return scored.withColumn("risk_level", tier("churn_score", v.RISK_STEPS, v.RISK_REST))


def score_customers(
    calls: DataFrame, network: DataFrame, usage: DataFrame, ties: Sequence[str] | None = None
) -> DataFrame:
    """One scored row per customer with a call; the call gives the event time.

    All three sides are cut to one row per customer on the same partitioning the joins need.
    """
    latest_calls = latest_per_key(calls, [CUSTOMER], TIME, ties)
    others = [
        latest_per_key(side, [CUSTOMER], TIME, ties).select(CUSTOMER, *measures)
        for side, measures in ((network, v.NETWORK_MEASURES), (usage, v.USAGE_MEASURES))
    ]
    joined = left_chain(latest_calls.select(CUSTOMER, *v.CALL_MEASURES, TIME), *others, on=[CUSTOMER])
    return with_score(joined).select(CUSTOMER, "churn_score", "risk_level", F.col(TIME))


def split_topics(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, network and usage rows of a mixed table with a ``topic`` column."""
    calls, network, usage = (
        events.filter(F.col("topic") == topic).select(CUSTOMER, *measures, TIME)
        for topic, measures in (
            (v.CALLS_TOPIC, v.CALL_MEASURES),
            (v.NETWORK_TOPIC, v.NETWORK_MEASURES),
            (v.USAGE_TOPIC, v.USAGE_MEASURES),
        )
    )
    return calls, network, usage


def score_events(events: DataFrame) -> DataFrame:
    return score_customers(*split_topics(events))


def latest_events(events: DataFrame) -> DataFrame:
    """Newest call, network and usage event of each customer as structs, of a mixed table or of a stream so far.

    Equal times are settled by the measures, as ``latest_per_key`` does. On a stream the three structs of every customer are the
    state, which new events only ever raise; it grows with the customers, not with the events.
    """

    def newest(topic: str, measures: Sequence[str]) -> Column:
        wanted = F.col("topic") == topic
        if topic != v.CALLS_TOPIC:
            wanted &= F.col(CUSTOMER).isNotNull()  # events without a customer meet no call
        return F.max(F.when(wanted, F.struct(TIME, *measures)))

    return events.groupBy(CUSTOMER).agg(
        newest(v.CALLS_TOPIC, v.CALL_MEASURES).alias("call"),
        newest(v.NETWORK_TOPIC, v.NETWORK_MEASURES).alias("network"),
        newest(v.USAGE_TOPIC, v.USAGE_MEASURES).alias("usage"),
    )


def score_latest(events: DataFrame) -> DataFrame:
    """As ``score_events``, in one aggregation that also runs on streams: a call meets events of earlier batches."""
    joined = latest_events(events).where("call IS NOT NULL").select(
        CUSTOMER,
        "call.*",
        *[F.col(f"network.{m}") for m in v.NETWORK_MEASURES],
        *[F.col(f"usage.{m}") for m in v.USAGE_MEASURES],
    )
    return with_score(joined).select(CUSTOMER, "churn_score", "risk_level", F.col(TIME))
