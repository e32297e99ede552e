"""Distinct counts that add up: sketches of every batch are kept and merged when a count is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.sinks.batches import Sink, run_of
from churnkit.sinks.ledger import Ledger, numbered

# Standard error 0.8 %; a sketch takes at most 16 KB.
PRECISION = 14


def distinct_sketches(df: DataFrame, by: Sequence[str], key: str, precision: int = PRECISION) -> DataFrame:
    """Rows and a sketch of the distinct keys of each group: (by, n_rows, sketch). Null keys are rows, but no keys."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(key, precision).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n_rows, n_distinct) over the sketches of finer groups, such as batches or days."""
    total = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), total)


def distinct_sink(spark: SparkSession, root: str, by: Sequence[str], key: str, precision: int = PRECISION) -> Sink:
    """Keep the sketches of each micro-batch in a ledger; a batch that is run again replaces its own."""
    ledger = Ledger(spark, root)

    def write(batch: DataFrame, batch_id: int) -> None:
        ledger.commit(distinct_sketches(batch, by, key, precision), f"{run_of(batch)}-{numbered(batch_id)}")

    return write


def kept_distinct(spark: SparkSession, root: str, by: Sequence[str]) -> DataFrame:
    """``merged_distinct`` over all batches of a ``distinct_sink``; no event is read again."""
    sketches = Ledger(spark, root).read()
    if sketches is None:
        raise ValueError(f"{root} holds no batch")
    return merged_distinct(sketches, by)
