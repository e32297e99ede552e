"""Rows that come behind the watermark, kept apart instead of dropped, with an account of every batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.plans import values as v
from churnkit.sinks.batches import Sink, run_of, write_to_all
from churnkit.sinks.ledger import Ledger, numbered
from churnkit.streaming.queries import BatchWriter

_ACCOUNT = "run_id string, batch_id long, mark timestamp, newest timestamp, n_taken long, n_late long"


def flagged(rows: DataFrame, time: str, mark: int | None, width: str | None = None) -> DataFrame:
    """Rows with ``_late``: behind the mark (microseconds), or with ``width``, in a window that has ended by then.

    Rows without a time are not late, and before the first mark none is.
    """
    if mark is None:
        return rows.withColumn("_late", F.lit(False))
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    if width is None:
        behind = micros < mark
    else:
        span = _micros(rows.sparkSession, width)
        behind = micros - F.pmod(micros, F.lit(span)) + span <= mark
    return rows.withColumn("_late", F.coalesce(behind, F.lit(False)))


def late_writer(
    taken: Mapping[str, Sink],
    late: Mapping[str, Sink],
    account: str,
    time: str = "event_time",
    delay: str = v.WATERMARK,
    width: str | None = None,
    lag: int = 1,
) -> BatchWriter:
    """Send rows behind the watermark to the ``late`` sinks and all others to the ``taken`` ones; no row is lost.

    The mark of a batch is ``delay`` behind the newest time of the batches up to ``lag`` before it. Spark's stateful
    operators judge lateness with a lag of 2, so with the ``width`` of a windowed summary ``late`` gets just what it drops. ``account``
    is the folder of a ledger with one row a batch; it is written last, and a batch that is run again finds
    the mark it had before, as its own entry and later ones are not looked at.
    """
    if lag < 1:
        raise ValueError("a batch cannot be judged by itself")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_of(batch)
        ledger = Ledger(spark, account)
        newest_before = _newest(ledger, run, batch_id - 1)
        judged_by = newest_before if lag == 1 else _newest(ledger, run, batch_id - lag)
        mark = None if judged_by is None else judged_by - _micros(spark, delay)
        rows = flagged(batch, time, mark, width).persist()
        try:
            seen = rows.agg(
                F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("newest"),
                F.count_if(~F.col("_late")).alias("n_taken"),
                F.count_if("_late").alias("n_late"),
            ).first()
            sinks = {f"taken {n}": _only(s, "NOT _late") for n, s in taken.items() if seen["n_taken"]}
            sinks |= {f"late {n}": _only(s, "_late") for n, s in late.items() if seen["n_late"]}
            write_to_all(rows, batch_id, sinks)
            newest = max((x for x in (seen["newest"], newest_before) if x is not None), default=None)
            row = spark.range(1).select(
                F.lit(run).alias("run_id"),
                F.lit(batch_id).cast("long").alias("batch_id"),
                *[F.timestamp_micros(F.lit(x).cast("long")).alias(n) for n, x in (("mark", mark), ("newest", newest))],
                F.lit(seen["n_taken"]).cast("long").alias("n_taken"),
                F.lit(seen["n_late"]).cast("long").alias("n_late"),
            )
            ledger.commit(row, f"{run}-{numbered(batch_id)}")
        finally:
            rows.unpersist()

    return write


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {interval})").first()[0]


def _only(sink: Sink, which: str) -> Sink:
    return lambda rows, batch_id: sink(rows.where(which).drop("_late"), batch_id)


def _newest(ledger: Ledger, run: str, upto: int) -> int | None:
    """Newest time, in microseconds, of the batches of a run up to one; each entry holds that of all before it."""
    names = [e for e in ledger.commits() if e.startswith(f"{run}-") and e <= f"{run}-{numbered(upto)}"] if upto >= 0 else []
    if not names:
        return None
    return ledger.read([max(names)], _ACCOUNT).select(F.unix_micros("newest")).first()[0]


def late_account(spark: SparkSession, account: str) -> DataFrame:
    """One row per run and batch: the mark it was judged by, the newest time so far, and how many rows were taken and late."""
    rows = Ledger(spark, account).read(schema=_ACCOUNT)
    return spark.createDataFrame([], _ACCOUNT) if rows is None else rows
