import math
import re
import zlib

import cases
import numpy as np
import pyarrow as pa

from churnkit.llm.boosted_trees import fit_forest
from churnkit.llm.catalog import QUERIES
from churnkit.llm.quality_model import STATISTICS, keep_good, score, statistics, train, training_sample
from churnkit.llm.words import text_groups

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_quality_classifier"](spark, SF_DIR).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = np.array([s for s, y in judged if y])
    bad = np.array([s for s, y in judged if not y])
    assert (good[:, None] > bad).mean() > 0.97
    assert np.mean([(s >= 0.7) == bool(y) for s, y in judged]) > 0.95


def test_held_out_labels_are_never_learned(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    x, y = training_sample(docs, labels)
    assert len(y) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    assert len(training_sample(docs, labels, rows=11)[1]) == 11 and x.shape[1] == len(STATISTICS)


def test_odd_rows(spark):
    df = cases.frame(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    forest = train(df, labels)
    rows = score(df, forest).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    # The score depends on the text alone.
    alone = score(spark.createDataFrame([(None, t) for t in cases.texts()], "doc_id long, text string"), forest)
    assert sorted({round(r.score, 9) for r in alone.collect()}) == sorted({round(r.score, 9) for r in score(cases.distinct_frame(spark), forest).collect()})
    kept = keep_good(df, forest)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in rows)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {r.score for r in score(docs, train(docs, none)).collect()} == {0.5}
    one_class = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r.score > 0.7 for r in score(docs, train(docs, one_class)).collect())
    assert score(cases.empty(spark), train(cases.empty(spark), none)).collect() == []


def test_forest_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = fit_forest(x, y)
    fresh = rng.random((1000, 5))
    assert np.mean((forest.scores(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.3))) > 0.97
    # Flat arrays walked at once give what a walk node by node gives.
    for row in fresh[:20]:
        margin = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            margin += leaf[node - len(feature)]
        assert abs(forest.scores(row[None])[0] - 1 / (1 + np.exp(-margin))) < 1e-12


def plain_statistics(text):
    """The statistics of one text, word by word and byte by byte."""
    raw = text.encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", raw) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    lines = [x for x in raw.split(b"\n") if len(x) > 1]
    share = lambda part, whole: part / max(whole, 1)
    repeats = lambda items: len(items) - len(set(items))
    count = lambda members: share(sum(raw.count(bytes([b])) for b in members), len(raw))
    return [
        math.log1p(len(raw)), math.log1p(len(words)), share(sum(map(len, words)), len(words)),
        count(range(65, 91)), count(range(48, 58)), count(b"#*$%&<>@^~=+{}[]\\"), count(b".,;:?'\"-()/"), count(b"!"), count(b"|"),
        count(range(128, 256)), count(b"\n"),
        share(sum(len(w) <= 3 for w in words), len(words)), share(sum(len(w) > 15 for w in words), len(words)),
        share(sum(2 * sum(65 <= b < 91 for b in w) > len(w) for w in words), len(words)),
        1 - share(repeats(words), len(words)), share(repeats(windows), len(words)), share(repeats(lines), len(lines)),
        share(len(words), raw.count(b"\n") + 1),
    ]


def test_statistics_against_plain_python():
    odd = ["", "\n", "a\n", "\n\nab\nab\n", "ab", "AB Cd\x0b!!", "ab\nab\nx\nab", "a\n\n", " \t"]
    texts = [t or "" for t in cases.texts()] + odd
    found = []
    for group in text_groups(pa.array([t.encode() for t in texts], pa.large_binary()), budget=3000):
        found += list(statistics(group))
    assert len(found) == len(texts)
    for text, row in zip(texts, found, strict=True):
        expected = plain_statistics(text) if text else [0.0] * 14 + [row[14]] + [0.0] * 3
        assert np.allclose(row, expected), (text[:40], row, expected)
