"""All rows in the order of their ids, so that a task also sees the row after its last one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.scratch import materialize

_LOWEST = np.iinfo(np.int64).min


def part_bounds(rows: DataFrame, parts: int) -> list[tuple[int | None, int]]:
    """The least (_id, _mark) of each of at most ``parts`` ranges of about as many rows, in order.

    Ranges are written once, without texts, so that every later use sees the same; at most ``parts`` rows reach the driver.
    """
    keys = rows.select("_id", "_mark").repartitionByRange(parts, "_id", "_mark")
    placed = materialize(keys.select(F.spark_partition_id().alias("part"), "_id", "_mark"), "ranges")
    least = placed.groupBy("part").agg(F.min(F.struct("_id", "_mark")).alias("least")).orderBy("part")
    return [(r["least"]["_id"], r["least"]["_mark"]) for r in least.collect()]


def in_order(rows: DataFrame, parts: int) -> DataFrame:
    """Rows (_id, _mark, and others), a range of (_id, _mark) a task, in order, with ``guard`` as a further column.

    After each range comes, as a guard, the row that begins the next one; after the last, the very first. Guards add a row
    for each range. Nulls come first. The texts are shuffled once.
    """
    bounds = part_bounds(rows, parts)
    known = np.array([i is not None for i, _ in bounds])
    ids = np.array([_LOWEST if i is None else i for i, _ in bounds], np.int64)
    marks = np.array([m for _, m in bounds], np.int64)
    n = len(bounds)
    columns = rows.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            there = batch.column("_id").is_valid().to_numpy(zero_copy_only=False)
            these = [there, batch.column("_id").fill_null(_LOWEST).to_numpy(), batch.column("_mark").to_numpy()]
            has, key, mark = (np.concatenate(x) for x in zip((known, ids, marks), these, strict=True))
            order = np.lexsort((np.arange(len(key)) >= n, mark, key, has))  # bounds before equal rows
            part = np.empty(len(key), np.int64)
            part[order] = np.cumsum(order < n) - 1
            part = part[n:]
            head = (has[part] == these[0]) & (ids[part] == these[1]) & (marks[part] == these[2])
            yield marked(batch, part, False)
            if head.any():
                yield marked(batch.filter(pa.array(head)), (part[head] - 1) % n, True)

    def marked(batch: pa.RecordBatch, part: np.ndarray, guard: bool) -> pa.RecordBatch:
        arrays = [*batch.columns, pa.array(part.astype(np.int32)), pa.array(np.full(len(part), guard))]
        return pa.RecordBatch.from_arrays(arrays, [*columns, "part", "guard"])

    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("guard", T.BooleanType())])
    dealt = rows.mapInArrow(deal, schema).repartitionById(max(n, 1), "part")
    return dealt.sortWithinPartitions("part", "guard", "_id", "_mark")
