"""Sinks for whole tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from churnkit.sources.topics import as_messages


def write_silver(df: DataFrame, path: str, fmt: str = "parquet", **options: str | bool) -> None:
    """Replace the silver files; as many files as tasks, Parquet unless CSV is asked for."""
    if fmt == "csv":
        # Keep text as it is: blanks at the ends matter to the cleaning steps.
        keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        options = {"header": True} | keep_blanks | options
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


def full_refresh(df: DataFrame, table: str, fmt: str = "parquet") -> int:
    """Replace a table and report the number of rows it holds."""
    df.write.mode("overwrite").format(fmt).saveAsTable(table)
    return df.sparkSession.table(table).count()


def publish(models: Mapping[str, DataFrame], as_tables: tuple[str, ...] = ("mart_",)) -> None:
    """Save marts as tables and offer every other model as a view."""
    for name, df in models.items():
        if name.startswith(as_tables):
            full_refresh(df, name)
        else:
            df.createOrReplaceTempView(name)


def write_messages(df: DataFrame, key: str, topic: str, fmt: str = "kafka", **options: str) -> None:
    """Send rows as keyed JSON messages."""
    as_messages(df, key, topic).write.format(fmt).options(**options).mode("append").save()
