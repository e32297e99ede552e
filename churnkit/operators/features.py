"""Features that need table-wide statistics, and the risk label of a score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.rules import tier
from churnkit.operators.ranks import quantiles


def quantile_bins(
    df: DataFrame,
    column: str,
    target: str,
    labels: Sequence[str] = ("Low", "Mid-Low", "Mid-High", "High"),
    rel_error: float = 0.01,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Label by equal-share bins: below the first cut the first label, and so on; null gets the last.

    ``cuts`` that are known already spare the pass that finds them.
    """
    if cuts is None:
        probs = [i / len(labels) for i in range(1, len(labels))]
        cuts = quantiles(df, [column], probs, rel_error)[column]
    if not cuts:
        return df.withColumn(target, F.lit(labels[-1]))
    steps = [("<", cut, label) for cut, label in zip(cuts, labels)]
    return df.withColumn(target, tier(column, steps, labels[-1]))


def risk_level(score: Column | str, steps: Sequence[tuple[str, int, str]], otherwise: str) -> Column:
    return tier(score, steps, otherwise)
