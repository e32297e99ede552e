import hashlib
from collections import Counter, defaultdict

import cases
from pyspark.sql import functions as F

from churnkit.llm import frames
from churnkit.llm.exact_dedup import drop_exact_copies, exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            stays = i == keep and not kept
            kept |= stays
            out[i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def test_decisions(spark):
    df = cases.frame(spark)
    found = Counter(map(tuple, exact_dedup(df).collect()))
    assert found == expected([(r.doc_id, r.text) for r in df.collect()])


def test_decisions_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(frames, "BROADCAST_BYTES", -1)
    df = cases.frame(spark)
    assert Counter(map(tuple, exact_dedup(df).collect())) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_rows_that_stay_keep_their_columns(spark):
    df = cases.frame(spark)
    found = drop_exact_copies(df)
    assert found.columns == df.columns
    kept = [k for k, n in expected([(r.doc_id, r.text) for r in df.collect()]).items() if k[3] for _ in range(n)]
    rows = found.collect()
    assert Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows) == Counter((k[0], k[4]) for k in kept)
    assert {r._text for r in rows} == {"t"} and {r.n for r in rows} == {5}


def test_one_text_in_most_rows(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    rows = exact_dedup(df).groupBy("keep_id", "group_size", "kept").count().collect()
    assert {tuple(r) for r in rows} == {(29_999, 30_000, True, 1), (29_999, 30_000, False, 29_999)}


def test_empty(spark):
    assert exact_dedup(cases.empty(spark)).collect() == []
    assert drop_exact_copies(cases.empty(spark)).collect() == []
