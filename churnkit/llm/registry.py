"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@functools.lru_cache(8)
def _shipped(application: str) -> str:
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="churnkit-")) / "churnkit.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    return str(archive)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application; Spark serves the file to executors."""
    context = spark.sparkContext
    before = _shipped.cache_info().misses
    archive = _shipped(context.applicationId)
    if _shipped.cache_info().misses > before:
        context.addPyFile(archive)


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
