"""One row per key, by an order the caller spells out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    The rank filter lets Spark keep one row per key and task before the shuffle, so a key that
    holds most of the table costs no more there than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """Newest row of each key; equal times are settled by ``ties`` descending.

    Without ``ties`` all other columns decide, so the result never depends on the shuffle.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in (*keys, time)]
    order = [F.col(c).desc_nulls_last() for c in (time, *ties)]
    return first_per_key(df, keys, order)
