"""Counts, profiles, modes and gates; each reads the table once for all columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.operators.ranks import quantiles


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or empty if the column holds text."""
    c = F.col(name)
    return c.isNull() | (c == "") if isinstance(df.schema[name].dataType, T.StringType) else c.isNull()


def has_values(df: DataFrame, name: str) -> Column:
    """Neither null nor empty text."""
    return ~is_missing(df, name)


def row_counts(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    return {name: df.count() for name, df in frames.items()}


def require_rows(df: DataFrame, name: str) -> int:
    """Row count, or an error if there is none."""
    n = df.count()
    if n == 0:
        raise ValueError(f"{name} holds no rows")
    return n


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of missing values of each column."""
    names = columns or df.columns
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in names])


def any_negative(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at least one value below zero, found in one pass."""
    seen = df.agg(*[F.coalesce(F.max(F.col(c) < 0), F.lit(False)).alias(c) for c in columns]).first()
    return [c for c in columns if seen[c]]


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent non-missing text of each column, the lowest one on ties.

    Counts combine before the shuffle and the winner is an aggregate too, so no task sees all
    values of a column at once.
    """
    if not columns:
        return {}
    counts = (
        df.select(*columns)
        .unpivot([], list(columns), "name", "value")
        .filter(F.col("value").isNotNull() & (F.col("value") != ""))
        .groupBy("name", "value")
        .agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))
    return {r["name"]: r["value"] for r in best.select("name", "best.value").collect()}


def outside_share(name: str, low: float, high: float) -> Column:
    """Share of all rows, nulls included, that lie outside the bounds."""
    c = F.col(name)
    return F.avg(F.when((c < low) | (c > high), 1).otherwise(0))


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    rel_error: float = 0.01,
) -> DataFrame:
    """Count, mean, deviation, minimum, quantiles and maximum of each numeric column, a row each."""
    names = list(columns or numeric_columns(df))
    marks = quantiles(df, names, probs, rel_error)

    def line(name: str) -> Column:
        c = F.col(name).cast("double")
        cuts = marks[name] or [None] * len(probs)
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).alias("min"),
            *[F.lit(v).cast("double").alias(f"p{p * 100:g}") for p, v in zip(probs, cuts)],
            F.max(c).alias("max"),
        )

    return df.agg(F.array(*[line(c) for c in names]).alias("lines")).select(F.inline("lines"))


def means_by_key(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Mean of each measure per key; ``means`` maps output name to measure."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(name) for name, c in means.items()])


def conditional_rate(condition: Column) -> Column:
    """Share of rows for which the condition holds; unknown counts as not."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def topic_counts(df: DataFrame, topic: str = "topic", key: str = "customer_id") -> DataFrame:
    """Rows and distinct keys per topic in one aggregation."""
    return df.groupBy(topic).agg(
        F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_customers")
    )


def event_rate(df: DataFrame, time: str, width: str, seconds: int, by: Sequence[str] = ()) -> DataFrame:
    """Events per tumbling window and group, with the rate per second; for tables and streams."""
    return (
        df.groupBy(F.window(time, width).alias("w"), *by)
        .agg(F.count("*").alias("n_events"))
        .select(
            F.col("w.start").alias("window_start"),
            *by,
            "n_events",
            (F.col("n_events") / F.lit(float(seconds))).alias("events_per_sec"),
        )
    )
