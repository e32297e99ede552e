"""Sinks for micro-batches: functions ``(batch, batch_id) -> None``.

Written rows carry the run and the batch they came with. A run is a streaming query with its checkpoint, however
often it restarts, or one batch copy. A retried batch replaces its own rows; other runs are never touched.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]
ClearBatch = Callable[[str, int], None]
RUN = "run_id"
BATCH = "batch_id"
STAMPS = (RUN, BATCH)
# Formats that keep rows in folders, which can be replaced one by one.
FOLDER_FORMATS = ("parquet", "orc", "json", "csv", "avro")
# Spark names the running streaming query in this property of the thread that runs a batch.
_QUERY_ID = "sql.streaming.queryId"


class SinkError(RuntimeError):
    """At least one sink failed; ``failures`` maps its name to the error."""

    def __init__(self, failures: Mapping[str, Exception]):
        self.failures = dict(failures)
        super().__init__("; ".join(f"{name}: {error}" for name, error in self.failures.items()))


def run_of(batch: DataFrame) -> str:
    """Id of the streaming query whose batch this is; a batch outside of one is a run of its own."""
    return batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or str(uuid.uuid4())


def stamped(batch: DataFrame, run: str, batch_id: int) -> DataFrame:
    return batch.withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long")})


def folder_sink(path: str, fmt: str = "parquet", **options: str) -> Sink:
    """One folder per run and batch, replaced as a whole, so a retried batch never doubles."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = stamped(batch, run_of(batch), batch_id).write.format(fmt).options(**options)
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*STAMPS).mode("overwrite").save(path)

    return write


def parquet_sink(path: str) -> Sink:
    return folder_sink(path)


def jdbc_clear(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> ClearBatch:
    """Delete the rows of a batch from a database table, before it is written (again)."""

    def clear(run: str, batch_id: int) -> None:
        jvm = spark.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for name, value in properties.items():
            settings.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            *schema, name = table.split(".")
            if not connection.getMetaData().getTables(None, schema[-1] if schema else None, name, None).next():
                return  # the first write makes the table
            statement = connection.prepareStatement(f"DELETE FROM {table} WHERE {RUN} = ? AND {BATCH} = ?")
            statement.setString(1, run)
            statement.setLong(2, batch_id)
            statement.executeUpdate()
        finally:
            connection.close()

    return clear


def jdbc_sink(
    url: str,
    table: str,
    properties: Mapping[str, str],
    rows_per_insert: int = 1000,
    partitions: int = 4,
    clear_batch: ClearBatch | None = None,
) -> Sink:
    """Append to a database table.

    The database commits per task, so a retried batch may find some of its rows in place: rows of that run
    and batch are deleted first, by ``clear_batch`` or else by ``jdbc_clear``.
    """
    options = dict(properties) | {"batchsize": str(rows_per_insert), "numPartitions": str(partitions)}

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        (clear_batch or jdbc_clear(batch.sparkSession, url, table, properties))(run, batch_id)
        stamped(batch, run, batch_id).write.jdbc(url, table, mode="append", properties=options)

    return write


def format_sink(
    fmt: str, clear_batch: ClearBatch | None = None, at_least_once: bool = False, **options: str
) -> Sink:
    """Append with any data source, such as a warehouse connector.

    Formats kept in folders replace the folder of a retried batch. For others ``clear_batch(run, batch_id)`` is
    called first and should delete what is there of that batch; without it ``at_least_once`` has to say that
    a retried batch may be there twice, under the same run and batch ids.
    """
    if fmt in FOLDER_FORMATS and "path" in options:
        options = dict(options)
        return folder_sink(options.pop("path"), fmt, **options)
    if clear_batch is None and not at_least_once:
        raise ValueError(f"{fmt}: name clear_batch, or accept repeated rows with at_least_once")

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        if clear_batch is not None:
            clear_batch(run, batch_id)
        stamped(batch, run, batch_id).write.format(fmt).options(**options).mode("append").save()

    return write


def counts_sink(path: str, by: Sequence[str] = ("topic",)) -> Sink:
    """Row counts of each batch, kept for good beside its run and batch ids.

    They are counted from the batch itself and a retry replaces them, so nothing is counted twice or lost.
    """
    write = folder_sink(path)

    def count(batch: DataFrame, batch_id: int) -> None:
        write(batch.groupBy(*by).agg(F.count("*").alias("n_rows")).coalesce(1), batch_id)

    return count


def write_to_all(batch: DataFrame, batch_id: int, sinks: Mapping[str, Sink]) -> None:
    """Try every sink even if one fails, then raise, so that the batch is run again and no row is lost."""
    failures: dict[str, Exception] = {}
    for name, sink in sinks.items():
        try:
            sink(batch, batch_id)
        except Exception as error:  # a sink may fail in any way; the others still get their turn
            log.exception("sink %s failed for batch %d", name, batch_id)
            failures[name] = error
    if failures:
        raise SinkError(failures)
