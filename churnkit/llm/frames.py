"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.scratch import materialize

# Broadcast only what has been measured to be at most this.
BROADCAST_BYTES = 32 << 20
# Least bytes that a row of a broadcast counts for: the driver holds its hashed relation and the blocks sent. Measured:
# 122 a row with one long as the key, 217 with three.
RELATION_ROW = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Column, row_bytes: int = 64, salts: int = 32
) -> DataFrame:
    """Left join of many rows with a table that has at most one row a key.

    ``right`` is written and counted first. Up to BROADCAST_BYTES, a row counting as ``row_bytes`` and
    RELATION_ROW at least, it is broadcast; beyond that its rows are
    repeated over ``salts`` and the left rows dealt among them by ``spread_by``, so that no key, however
    frequent, meets in one task. The choice changes the plan, never the result.
    """
    right = materialize(right, "spread")
    if right.count() * max(row_bytes, RELATION_ROW) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), list(on), "left")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return salted.join(right.withColumn("_salt", every), [*on, "_salt"], "left").drop("_salt")
