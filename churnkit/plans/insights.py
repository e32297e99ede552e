"""Dashboard questions over scores, events and the silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.operators.stats import conditional_rate


def _share(column: str, *within: str):
    """Share of a group's total; the input is already one row per label."""
    total = F.sum(column).over(Window.partitionBy(*within))
    return F.try_divide(F.col(column), total)


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Customers and their share per risk level."""
    counts = scored.groupBy("risk_level").agg(F.count("*").alias("n_customers"))
    return counts.withColumn("share", _share("n_customers"))


def top_risk(scored: DataFrame, k: int = 20, level: str = "High") -> DataFrame:
    """The ``k`` customers of a level with the highest score, lowest id first on ties."""
    chosen = scored.filter(F.col("risk_level") == level)
    return chosen.orderBy(F.col("churn_score").desc(), "customer_id").limit(k)


def score_trend(scored: DataFrame, width: str = "1 day", time: str = "event_time") -> DataFrame:
    """Mean score and number of scores per tumbling window."""
    return (
        scored.groupBy(F.window(time, width).alias("w"))
        .agg(F.avg("churn_score").alias("avg_score"), F.count("*").alias("n_scores"))
        .select(F.col("w.start").alias("window_start"), "avg_score", "n_scores")
    )


def issue_resolution(calls: DataFrame) -> DataFrame:
    """Anger, duration and resolution per issue type."""
    return calls.groupBy("issue_type").agg(
        F.count("*").alias("n_calls"),
        F.avg("anger_rate").alias("avg_anger_rate"),
        F.avg("call_duration_sec").alias("avg_call_duration_sec"),
        conditional_rate(F.col("resolved") == "Yes").alias("resolution_rate"),
    )


def network_trend(network: DataFrame, width: str = "1 day", time: str = "event_time") -> DataFrame:
    """Signal, speed, dropped calls and outage share per tumbling window."""
    return (
        network.groupBy(F.window(time, width).alias("w"))
        .agg(
            F.count("*").alias("n_events"),
            F.avg("signal_strength").alias("avg_signal_strength"),
            F.avg("internet_speed").alias("avg_internet_speed"),
            F.sum("dropped_calls").alias("dropped_calls"),
            conditional_rate(F.col("outage_flag") == 1).alias("outage_share"),
        )
        .select(F.col("w.start").alias("window_start"), "*")
        .drop("w")
    )


def segment_churn(
    silver: DataFrame, segments: Sequence[str] = ("customer_loyalty", "clv_segment")
) -> DataFrame:
    """Customers and churn rate per segment."""
    return silver.groupBy(*segments).agg(
        F.count("*").alias("n_customers"), F.avg("churn").alias("churn_rate")
    )


def churn_drivers(silver: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Churn rate per level of every attribute, from one pass."""
    levels = silver.select("churn", *[F.col(a).cast("string").alias(a) for a in attributes]).unpivot(
        ["churn"], list(attributes), "attribute", "level"
    )
    return levels.groupBy("attribute", "level").agg(
        F.count("*").alias("n_customers"), F.avg("churn").alias("churn_rate")
    )


def revenue_at_risk(silver: DataFrame, segment: str = "clv_segment") -> DataFrame:
    """Mean revenue of churned customers summed per segment, and the share of all such revenue."""
    lost = silver.groupBy(segment).agg(
        F.sum(F.when(F.col("churn") == 1, F.col("avgrev")).otherwise(0.0)).alias("revenue_at_risk"),
        F.sum("avgrev").alias("revenue"),
    )
    return lost.withColumn("share_of_risk", _share("revenue_at_risk"))


def area_quality(silver: DataFrame, quality: str = "network_quality") -> DataFrame:
    """Customers, their share and mean data failure rate per area and quality label."""
    counts = silver.groupBy("area", quality).agg(
        F.count("*").alias("n_customers"), F.avg("data_failure_rate").alias("avg_data_failure_rate")
    )
    return counts.withColumn("share_in_area", _share("n_customers", "area"))
