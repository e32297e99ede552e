"""Tables from files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.scratch import new_path

CORRUPT = "_corrupt"
MALFORMED = "malformed"


def read_csv(
    spark: SparkSession,
    path: str,
    fields: str,
    header: bool = True,
    mode: str = "PERMISSIVE",
    corrupt: str | None = None,
    **options: str | bool,
) -> DataFrame:
    """CSV with a declared schema (``fields`` as DDL); a header that differs from it fails.

    ``corrupt`` adds a text column with the raw line of rows that do not fit.
    """
    if corrupt:
        fields = f"{fields}, {corrupt} string"
        options["columnNameOfCorruptRecord"] = corrupt
    reader = spark.read.schema(T.StructType.fromDDL(fields)).option("header", header)
    return reader.option("mode", mode).option("enforceSchema", False).options(**options).csv(path)


def split_malformed(df: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw lines of those that do not.

    The reader judges a line by the columns a query asks for. A hash over all of them, compared
    with the lowest number there is, makes every query ask for all.
    """
    data = [c for c in df.columns if c != corrupt]
    reads_all = F.xxhash64(*data) >= F.lit(-(1 << 63))
    good = df.filter(reads_all & F.col(corrupt).isNull()).drop(corrupt)
    bad = df.filter(reads_all & F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"))
    return good, bad


def split_once(df: DataFrame, path: str | None = None, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """As ``split_malformed``, but the file is parsed only once.

    Rows and raw lines are written to one table, told apart by its partition ``malformed``; both results read their own
    partition. ``path`` is a lasting place for the table.
    """
    spark, path = df.sparkSession, path or new_path(df.sparkSession, "parsed")
    flagged = df.withColumn(MALFORMED, F.col(corrupt).isNotNull())
    flagged.write.mode("overwrite").partitionBy(MALFORMED).parquet(path)
    parsed = spark.read.schema(flagged.schema).parquet(path)
    good = parsed.where(~F.col(MALFORMED)).drop(MALFORMED, corrupt)
    return good, parsed.where(F.col(MALFORMED)).select(F.col(corrupt).alias("line"))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver Parquet folder; stays distributed and is pruned by the queries on it."""
    return spark.read.parquet(path)


def register_staging(frames: Mapping[str, DataFrame], prefix: str = "stg_") -> list[str]:
    """Make frames available to SQL as ``stg_<name>``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in frames]


def require_inputs(spark: SparkSession, inputs: Mapping[str, tuple[str, str]]) -> dict[str, list[str]]:
    """Fail before a run if an input ``name: (format, path)`` cannot be read; gives its columns."""
    return {
        name: spark.read.format(kind).option("header", True).load(path).columns
        for name, (kind, path) in inputs.items()
    }
