import hashlib
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from churnkit.llm import fingerprints
from churnkit.llm.fingerprints import containment, document_fingerprints, fingerprint_edits, hashes_of, merge_fingerprints
from churnkit.llm.words import text_groups

SF_DIR = "/root/testdata/sf0.001"


def shingles(text, size=5):
    w = cases.words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain(texts, scale=8):
    """Kept hashes of each text: those of every shingle, each hashed as a text of its own."""
    import pyarrow as pa

    every = sorted({s for t in texts for s in shingles(t)})
    alone = pa.array([" ".join(s).encode() for s in every], pa.large_binary())
    hash_of = {}
    for group in text_groups(alone):
        hashes, bounds = fingerprints.sketches(group, 5, 1)
        hash_of |= {s: int(h) for s, h in zip(every[group.rows], hashes, strict=True)}
        assert (bounds[1:] - bounds[:-1] == 1).all()
    out = []
    for t in texts:
        found = {hash_of[s] for s in shingles(t)}
        out.append({h for h in found if h < 2**64 // scale} or ({min(found)} if found else set()))
    return out


def spelt(hashes):
    return "".join(f"{h:016x}" for h in sorted(hashes))


def likeness(a, b):
    least = min(len(a), len(b))
    return len(a & b) / least if least else float(not a and not b)


def edits(docs):
    """docs: (id, text) in order; (id, n_chars, edited text, next text)."""
    out = []
    for k, (i, t) in enumerate(docs):
        t, after = t or "", docs[(k + 1) % len(docs)][1] or ""
        gone = len(t) // 4
        out.append((i, len(t), t[: len(t) - gone] + after[:gone], after))
    return out


def expected(docs):
    rows = edits(docs)
    sets = plain([t or "" for _, t in docs] + [r[2] for r in rows])
    own, changed = sets[: len(docs)], sets[len(docs) :]
    return [
        (i, n, hashlib.sha256(e.encode()).hexdigest(), spelt(own[k]), spelt(changed[k]), likeness(own[k], changed[k]), likeness(own[k], own[(k + 1) % len(docs)]))
        for k, (i, n, e, _) in enumerate(rows)
    ]


@pytest.mark.parametrize("width", [1, 3, 8, 50])
def test_edits_against_plain_python(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = cases.distinct_frame(spark)
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        found = fingerprint_edits(df.repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    docs = sorted((r.doc_id, r.text) for r in df.collect())
    assert sorted(map(tuple, found)) == expected(docs)


def test_odd_ids(spark):
    df = cases.frame(spark)
    rows = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")).collect()
    docs = [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.mark))]
    assert Counter(map(tuple, fingerprint_edits(df.repartition(6)).collect())) == Counter(expected(docs))


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(7, "aé漢b cdef")], "doc_id long, text string")
    (row,) = fingerprint_edits(df).collect()
    assert (row.n_chars, row.near_next) == (9, 1.0)
    assert row.edited_sha256 == hashlib.sha256("aé漢b cdaé".encode()).hexdigest()


def test_empty(spark):
    assert fingerprint_edits(cases.empty(spark)).collect() == []
    assert document_fingerprints(cases.empty(spark)).collect() == []


def test_fingerprints_alone(spark):
    df = cases.frame(spark)
    found = Counter(map(tuple, document_fingerprints(df).collect()))
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert found == Counter((i, spelt(s)) for (i, _), s in zip(docs, plain([t for _, t in docs]), strict=True))


def test_merged_fingerprint_is_that_of_all_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("_hash", F.lit(1))
    prints = document_fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    merged = {r.source: r.fingerprint for r in merge_fingerprints(prints, ["source"]).collect()}
    by = {}
    for r in prints.collect():
        by.setdefault(r.source, set()).update(r.fingerprint[k : k + 16] for k in range(0, len(r.fingerprint), 16))
    assert merged == {s: "".join(sorted(h)) for s, h in by.items()}


def test_containment_of_very_unequal_texts(spark):
    """A text of 600 words inside one of 12 000, another half inside."""
    import random

    rng = random.Random(8)
    large, small, other = (cases.prose(rng, n) for n in (12_000, 600, 600))
    half = " ".join(small.split()[:300]) + " " + other
    rows = [(1, large + " " + small), (2, small), (3, half), (4, other)]
    df = document_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    prints = {r.doc_id: r.fingerprint for r in df.collect()}
    one = spark.createDataFrame([tuple(prints[i] for i in (1, 2, 3, 4))], "a string, b string, c string, d string")
    inside, part, apart, share = one.select(
        containment("b", "a"), containment("c", "a"), containment("d", "a"), F.size(hashes_of("a"))
    ).first()
    assert inside == 1 and abs(part - 1 / 3) < 0.12 and apart == 0
    assert abs(share - 12_600 / 8) < 5 * (12_600 / 8) ** 0.5


def test_likeness_estimates_containment(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r for r in fingerprint_edits(docs).collect()}
    rows = sorted(map(tuple, docs.collect()))
    errors, nearer, seen = [], 0, 0
    for (i, text), (_, n, edited, after) in zip(rows, edits(rows), strict=True):
        if n < 1000:
            continue
        own, seen = shingles(text), seen + 1
        exact = [likeness(own, shingles(t)) for t in (edited, after)]
        errors += [found[i].near_edited - exact[0], found[i].near_next - exact[1]]
        nearer += found[i].near_edited > found[i].near_next
    assert seen > 300 and nearer > 0.97 * seen
    # The smaller of two estimated sizes is a little too small, so the likeness is a little too large.
    assert abs(sum(errors)) / len(errors) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.08
