"""Exact deduplication by skew-safe combining.

Copies are combined in three steps, each of which compares the whole text and not only its digest:
inside each task (the partial aggregation before the shuffle), inside each (digest, salt) group, and
among the winners of the salts. No task sees more rows of one text than there are salts and tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.frames import spread_join, text_or_empty

_KEYS = ["_sha", "_bytes", "_mark"]


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("_id"),
        text.alias("_text"),
        F.sha2(text, 256).alias("_sha"),
        F.octet_length(text).alias("_bytes"),
        F.xxhash64(text).alias("_mark"),
    )


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """One row per text: the largest id and the number of rows."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
    local = salted.groupBy("_sha", "_salt", "_text", "_bytes", "_mark").agg(
        F.max("_id").alias("_keep"), F.count("*").alias("_n")
    )
    return local.groupBy("_sha", "_text", "_bytes", "_mark").agg(
        F.max("_keep").alias("keep_id"), F.sum("_n").alias("group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. The row with the largest id stays. Of rows
    that repeat both id and text one is kept. Rows without an id stay only if no row of their text has
    one. Other columns are not read, so their names cannot clash. An empty table gives an empty one.
    """
    rows = _digested(docs, id_col, text_col)
    # Texts that occur once need no partner; only repeated ones are looked up.
    repeated = _combined(rows, salts).where("group_size > 1").drop("_text")
    same = rows.drop("_text").groupBy("_id", *_KEYS).agg(F.count("*").alias("_same"))
    found = spread_join(same, repeated, _KEYS, F.col("_id"), row_bytes=160)
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("_id")).otherwise(F.col("keep_id"))
    numbered = found.withColumn("keep_id", keep).withColumn(
        "group_size", F.coalesce("group_size", F.lit(1))
    )
    copies = numbered.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_same"))))
    return copies.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        ((F.col("_copy") == 1) & F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with all their columns, in two aggregations.

    The other columns travel with the id, so that the winner needs no join. Rows that repeat id and text
    but differ elsewhere give the one that is larger in the remaining columns, in their order.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    text = text_or_empty(text_col)
    # Position-named fields: columns of any name fit. A missing text stays missing in the row that stays.
    fields = [F.col(id_col).alias("f0"), F.col(text_col).isNull().alias("f1")]
    fields += [F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(others, 2)]
    rows = docs.select(text.alias("_text"), F.sha2(text, 256).alias("_sha"), F.struct(*fields).alias("_row"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_row.f0"), F.lit(salts)).cast("int"))
    local = salted.groupBy("_sha", "_salt", "_text").agg(F.max("_row").alias("_row"))
    won = local.groupBy("_sha", "_text").agg(F.max("_row").alias("_row"))
    named = {c: F.col(f"_row.f{i}") for i, c in enumerate(others, 2)}
    named |= {id_col: F.col("_row.f0"), text_col: F.when(~F.col("_row.f1"), F.col("_text"))}
    return won.select(*[named[c].alias(c) for c in docs.columns])
