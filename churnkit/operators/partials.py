"""Sums that are kept per increment, so that new rows are added up without reading the old ones again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.sinks.ledger import Ledger, numbered


def store_increment(sums: DataFrame, root: str, increment: int) -> None:
    """Keep the sums of one increment. Storing it again replaces it, so a retried increment counts once."""
    folded = _folded(Ledger(sums.sparkSession, f"{root}/base"))
    if increment <= folded:
        raise ValueError(f"increment {increment} is already part of the base, which reaches to {folded}")
    Ledger(sums.sparkSession, f"{root}/increments").commit(sums, numbered(increment))


def merged_sums(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Sums over all increments by ``keys``; every other column is a sum or a count."""
    base, increments = Ledger(spark, f"{root}/base"), Ledger(spark, f"{root}/increments")
    folded = _folded(base)
    parts = [base.read([numbered(folded)]), increments.read(e for e in increments.commits() if int(e) > folded)]
    parts = [p for p in parts if p is not None]
    if not parts:
        raise ValueError(f"{root} holds no increment")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])


def fold_increments(spark: SparkSession, root: str, keys: Sequence[str], tasks: int | None = None) -> int:
    """Merge all increments so far into one base, which readers then take in their place; the last increment in it."""
    upto = max(map(int, Ledger(spark, f"{root}/increments").commits()))
    rows = merged_sums(spark, root, keys)
    Ledger(spark, f"{root}/base").commit(rows.repartition(tasks, *keys) if tasks else rows, numbered(upto))
    return upto


def _folded(base: Ledger) -> int:
    """Last increment in the newest base, -1 without one."""
    return max(map(int, base.commits()), default=-1)
