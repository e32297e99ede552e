import zlib
from collections import defaultdict

import cases
from pyspark.sql import functions as F

from churnkit.llm.sharding import shard_by_bytes


def check(rows, docs, shards):
    size = lambda t: len((t or "").encode()) + 16
    key = lambda i: (i is not None, i or 0)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((i, size(t), zlib.crc32((t or "").encode())) for i, t in docs), key=str
    )
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    total, before = sum(r.size for r in rows), 0
    last = None
    for shard in sorted(by):
        held = sorted(by[shard], key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        for r in held:
            # Contiguous by id, and cut where the middle byte passes a target.
            assert last is None or key(last) <= key(r.doc_id)
            assert shard == min(shards - 1, (2 * before + r.size) * shards // (2 * total))
            before, last = before + r.size, r.doc_id


def test_odd_rows(spark):
    df = cases.frame(spark)
    check(shard_by_bytes(df, 7).collect(), [(r.doc_id, r.text) for r in df.collect()], 7)


def test_more_shards_than_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    check(shard_by_bytes(df, 40).collect(), [(1, "a"), (2, None)], 40)


def test_balance(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a"), (F.col("id") % 50).cast("int")).alias("text"))
    rows = shard_by_bytes(df, 40).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    sizes = [r.s for r in rows]
    assert len(sizes) == 40 and max(sizes) - min(sizes) <= 2 * (49 + 16)


def test_empty(spark):
    assert shard_by_bytes(cases.empty(spark)).collect() == []
