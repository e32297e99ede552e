"""Projection, renaming, run columns and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.names import snake_case


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project early so that every later shuffle carries only these columns."""
    return df.select(*columns)


def rename_snake_case(df: DataFrame) -> DataFrame:
    """All column names to snake_case in one projection."""
    names = [snake_case(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"renaming would make these names ambiguous: {clash}")
    return df.toDF(*names)


def add_run_columns(
    df: DataFrame,
    version: str,
    source: str,
    run_ts: datetime | None = None,
    zone: str = "Africa/Cairo",
    names: tuple[str, str, str] = ("_pipeline_run_ts", "_pipeline_version", "_source_system"),
) -> DataFrame:
    """Add run time as wall time in ``zone``, code version and source tag.

    Give ``run_ts`` (taken as UTC if it names no zone) to make a run repeatable.
    """
    if run_ts is not None and run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    started = F.lit(run_ts) if run_ts is not None else F.current_timestamp()
    values = (F.from_utc_timestamp(started, zone), F.lit(version), F.lit(source))
    return df.withColumns(dict(zip(names, values)))


def distinct_union(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION DISTINCT``; one aggregation, combined before the shuffle."""
    return reduce(DataFrame.union, frames).distinct()


def append_rows(df: DataFrame, *more: DataFrame) -> DataFrame:
    """Rows of all frames by column name; columns one of them lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), more, df)
