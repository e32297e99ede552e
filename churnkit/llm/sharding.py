"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-partitioned by id and written once with their place. The totals of the written parts,
summed in order, give each part its base; a running sum inside the part gives every row the number of
bytes before it. Equal targets cut that scale, so all shards differ by about one row at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.frames import text_or_empty
from churnkit.scratch import materialize

ROW_OVERHEAD = 16


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = ROW_OVERHEAD,
) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard (from 0), slot (place in the shard, gapless from 0).

    Size is the text in UTF-8 plus ``overhead``; a null text has no bytes. Rows follow each other by id
    (nulls first), then by checksum; equal rows follow each other in any order, which does not show. A row belongs to the
    shard that holds its middle byte. Shards may be empty if there are fewer rows than shards. Other
    columns are not read. An empty table gives an empty one.
    """
    text = text_or_empty(text_col)
    sized = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).cast("long").alias("_crc"),
        # Splits repeated rows among partitions; they are alike in all that is returned.
        F.monotonically_increasing_id().alias("_copy"),
    )
    order = ["_id", "_crc", "_size", "_copy"]
    placed = sized.repartitionByRange(*order).select(*order, F.spark_partition_id().alias("_part"))
    placed = materialize(placed, "shards")
    totals = placed.groupBy("_part").agg(F.sum("_size").alias("_sum"))
    # One row a part: as many as there are tasks, and summed in their order.
    bases = totals.select(
        "_part",
        (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_base"),
        F.sum("_sum").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    running = placed.withColumn("_end", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # Whole numbers: 2 * bytes * shards stays below 2**63 up to 100 PB in 40 shards.
    middle = F.expr(f"(2 * (_base + _end) - _size) * {int(shards)} div (2 * _total)")
    sharded = running.join(F.broadcast(bases), "_part").withColumn(
        "_shard", F.least(F.greatest(middle, F.lit(0)), F.lit(shards - 1)).cast("int")
    )
    placed_rows = sharded.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
    # Rows of a shard before this part: from the counts per (part, shard), again in order.
    counts = placed_rows.groupBy("_part", "_shard").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first")
    )
    earlier = Window.partitionBy("_shard").orderBy("_part")
    starts = counts.select(
        "_part", "_shard", (F.sum("_n").over(earlier) - F.col("_n") - F.col("_first")).alias("_shift")
    )
    return placed_rows.join(F.broadcast(starts), ["_part", "_shard"]).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("_row") + F.col("_shift")).alias("slot"),
    )
