"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(
    spark: SparkSession, tasks: Mapping[str, Callable[[], T]], at_once: int = 8
) -> dict[str, T]:
    """Run the tasks at the same time and give their results by name; the first error is raised.

    Spark takes jobs from several threads, so small ones need not wait for one another.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
        return {name: job.result() for name, job in running.items()}
