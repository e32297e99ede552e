"""Work that needs one total order of a table: dense keys and id continuation.

A window without partitions would pull the table into one task. Instead rows are range-partitioned,
sorted and written once; each row remembers its part and its place in it, and a small table of
part sizes turns these into global positions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.scratch import materialize

PART = "_part"
POS = "_pos"
_ROW = "_row"
_COPY = "_copy"
_START = "_start"
# monotonically_increasing_id holds the task's partition above these bits, the row number below.
_ROW_BITS = 33


def place_in_order(
    df: DataFrame,
    order_by: Sequence[str],
    path: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Write ``df`` range-sorted (nulls first), adding the part and the 0-based place in the part.

    The table is written because part borders are sampled anew by every plan: part sizes and
    rows have to come from the same run.
    """
    kept = list(keep) if keep is not None else df.columns
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_ROW, F.monotonically_increasing_id())
        .select(
            *kept,
            F.shiftright(_ROW, _ROW_BITS).cast("int").alias(PART),
            F.col(_ROW).bitwiseAND((1 << _ROW_BITS) - 1).alias(POS),
        )
    )
    return materialize(placed, "placed", path)


def part_starts(sizes: Mapping[int, int]) -> list[int]:
    """Rows before each part, by part number."""
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    return starts


def dense_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    ties: Sequence[str] | None = None,
    distinct: bool = False,
    start: int = 1,
    keep: Sequence[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Number rows ``start, start+1, ..`` by ``order_by``, then by ``ties`` (default: the other columns).

    ``distinct`` states that no two rows agree in all order columns. Otherwise their place in the input
    splits equal rows, so that many copies of one row do not end up in one task; rows that come out of a shuffle
    are written first, since their place is certain only then. ``keep`` names the columns of the result, ``path`` a lasting place for the table.
    """
    kept = list(keep) if keep is not None else df.columns
    if ties is None:
        ties = [c for c in df.columns if c not in order_by]
    order = [*order_by, *ties]
    if not distinct:
        if moves_rows(df):
            df = materialize(df, "unkeyed")
        df = df.withColumn(_COPY, F.monotonically_increasing_id())
        order.append(_COPY)
    placed = place_in_order(df, order, path, keep=kept)
    # One row per range partition, written so that every use of the keys sees the same small table.
    sizes = placed.groupBy(PART).agg(F.count("*").alias("n"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_START))
    starts = F.broadcast(materialize(starts, "starts"))
    numbered = placed.join(starts, PART)
    return numbered.select((F.col(_START) + F.col(POS) + start).alias(key), *kept)


def moves_rows(df: DataFrame) -> bool:
    """Whether rows arrive in an order that may change when a task is run again; plain scans keep theirs."""
    return re.search(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()) is not None


def continue_ids(
    existing: DataFrame, new: DataFrame, id_col: str, order_by: Sequence[str], distinct: bool = False
) -> DataFrame:
    """Give ``new`` rows the ids that follow the highest one in ``existing``."""
    highest = existing.agg(F.max(id_col)).first()[0]
    rows = new.drop(id_col)
    return dense_key(rows, id_col, order_by, distinct=distinct, start=(highest or 0) + 1)
