"""Register a query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables hold them."""
    zoned = {n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain_times(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, whose last bits depend on the order of summation."""
    doubles = {n: F.round(n, digits) for n, t in df.dtypes if t == "double"}
    return df.withColumns(doubles) if doubles else df
