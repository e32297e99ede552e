import random

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnkit.llm import components as cc
from churnkit.llm import count_tree, frames, ngram_join, substrings
from churnkit.llm.ngram_join import ngram_jaccard_components, ngram_jaccard_degrees, ngram_jaccard_links
from churnkit.llm.substrings import remove_repeats


def test_near_components_of_odd_rows(spark):
    df = cases.frame(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    expected = cases.near_components([d for d in docs if d[0] is not None])
    found = ngram_jaccard_components(df).collect()
    assert sorted(((r.doc_id, r.n_shingles) for r in found), key=str) == sorted(((i, len(cases.shingles(t))) for i, t in docs), key=str)
    assert {(r.doc_id, r.component_id) for r in found} == {*expected.items(), (None, None)}


def mutated(rng, groups, each, length, rate):
    rows = []
    for _ in range(groups):
        base = cases.prose(rng, length, "abcdefghij").split()
        for _ in range(each):
            rows.append(" ".join(w if rng.random() > rate else cases.prose(rng, 1, "xyz") for w in base))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("cell", "limit"), [(ngram_join.CELL, frames.BROADCAST_BYTES), (20, frames.BROADCAST_BYTES), (20, -1)])
def test_near_components_of_mutated_groups(spark, monkeypatch, cell, limit):
    """Groups with links at all strengths around the threshold; split cells and shuffled joins give the same."""
    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(frames, "BROADCAST_BYTES", limit)
    rng = random.Random(11)
    docs = mutated(rng, 3, 40, 60, 0.012) + [(1000 + i, t) for i, t in mutated(rng, 12, 6, 25, 0.02)]
    shared = cases.prose(rng, 30)
    docs += [(5000 + i, shared + " " + cases.prose(rng, 40)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in ngram_jaccard_components(df).collect()}
    assert found == cases.near_components(docs)


def test_all_links_of_three_alike(spark):
    """The link that components can do without is there as well, and so are those of a copy."""
    words = cases.prose(random.Random(4), 200).split()
    a, b, c = " ".join(words), " ".join(words[:-1] + ["x"]), " ".join(words[:-1] + ["y"])
    df = spark.createDataFrame([(1, a), (2, b), (3, c), (4, c), (5, "alone")], "doc_id long, text string")
    links = {(r.a, r.a_copies, r.b, r.b_copies) for r in ngram_jaccard_links(df).collect()}
    assert links == {(1, 1, 2, 1), (1, 1, 3, 2), (2, 1, 3, 2)}
    assert {r.doc_id: r.n_links for r in ngram_jaccard_degrees(df).collect()} == {1: 3, 2: 3, 3: 3, 4: 3, 5: 0}


@pytest.mark.parametrize(("piece", "columns"), [(ngram_join.PIECE, ngram_join._COLUMNS), (7, 50)])
def test_all_links_of_mutated_groups(spark, monkeypatch, piece, columns):
    monkeypatch.setattr(ngram_join, "PIECE", piece)
    monkeypatch.setattr(ngram_join, "_COLUMNS", columns)
    rng = random.Random(11)
    docs = mutated(rng, 3, 40, 60, 0.012) + [(1000 + i, t) for i, t in mutated(rng, 12, 6, 25, 0.02)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    pairs = cases.near_links(docs)
    degrees = {i: 0 for i, _ in docs}
    for x, y in pairs:
        degrees[docs[x][0]] += 1
        degrees[docs[y][0]] += 1
    assert {r.doc_id: r.n_links for r in ngram_jaccard_degrees(df).collect()} == degrees
    first = {}
    for i, t in sorted(docs):
        first.setdefault(frozenset(cases.shingles(t)), i)
    named = {i: first[frozenset(cases.shingles(t))] for i, t in docs}
    expected = {tuple(sorted((named[docs[x][0]], named[docs[y][0]]))) for x, y in pairs}
    found = [(r.a, r.b) for r in ngram_jaccard_links(df).collect()]
    assert len(found) == len(set(found)) and set(found) == {p for p in expected if p[0] != p[1]}


def test_degrees_of_odd_rows(spark):
    """Repeated ids count each row; rows without an id link with nothing."""
    df = cases.frame(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    with_id = [d for d in docs if d[0] is not None]
    degrees = [0] * len(with_id)
    for x, y in cases.near_links(with_id):
        degrees[x] += 1
        degrees[y] += 1
    expected = [(i, len(cases.shingles(t)), n) for (i, t), n in zip(with_id, degrees, strict=True)]
    expected += [(None, len(cases.shingles(t)), None) for i, t in docs if i is None]
    found = [(r.doc_id, r.n_shingles, r.n_links) for r in ngram_jaccard_degrees(df).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_split_cells_of_chained_copies_stay_few_pairs(spark, monkeypatch):
    """A third of the rows are one group whose copies are alike by chance only: some in one component, many alone."""
    monkeypatch.setattr(ngram_join, "CELL", 100)
    tried = []
    search = ngram_join.candidate_pairs
    monkeypatch.setattr(ngram_join, "candidate_pairs", lambda *a, **k: tried.append(ngram_join.materialize(search(*a, **k))) or tried[-1])
    rng = random.Random(6)
    base = cases.prose(rng, 150, "abcdefghij").split()
    docs = []
    for i in range(900):
        words = list(base)
        for k in rng.sample(range(150), rng.choice([0, 1, 1, 2, 2, 3, 4, 6, 9, 14])):
            words[k] = cases.prose(rng, 1, "xyz") + str(rng.randrange(30))
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, cases.prose(rng, 60)) for i in range(1800)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in ngram_jaccard_components(df).collect()}
    assert found == cases.near_components(docs[:900]) | {i: i for i, _ in docs[900:]}
    assert sum(t.count() for t in tried) < 16 * 900


def test_tree_leaves_out_boxes_of_other_groups():
    """Groups of copies of different texts of one length: a search visits few leaves besides those of its own group."""
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2)
        for _ in range(32):
            sets.append(np.unique(np.where(rng.random(200) < 0.03, rng.integers(0, 1 << 63, 200, dtype=np.uint64), base)))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    vectors = count_tree.count_vectors(np.concatenate(sets), owner, len(sets))
    sizes, like = np.array([len(s) for s in sets]), count_tree.Likeness()
    tree = count_tree.CountTree(vectors, sizes, np.arange(len(sets)))
    high, low_n = tree.levels[0][:2]
    visited = [int(like.enough(count_tree.shared_at_most(high, v), n, low_n).sum()) for v, n in zip(vectors, sizes, strict=True)]
    assert np.mean(visited) < 0.3 * len(high)


def test_bound_never_drops_a_link():
    rng = np.random.default_rng(4)
    like = count_tree.Likeness()
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
    sets = []
    for i in range(300):
        keep = base if i % 3 else rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
        sets.append(np.unique(np.where(rng.random(400) < rng.random() * 0.2, rng.integers(0, 1 << 63, 400, dtype=np.uint64), keep)))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    vectors = count_tree.count_vectors(np.concatenate(sets), owner, len(sets))
    sizes = np.array([len(s) for s in sets])
    links = {
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if like.enough(len(np.intersect1d(sets[i], sets[j])), sizes[i], sizes[j])
    }
    found = set(count_tree.all_partners(vectors, sizes, np.arange(len(sets)), like))
    assert links <= found and len(found) < 3 * len(links)
    labels = np.zeros(len(sets), np.int64)
    labels[:50] = 1
    across = set(count_tree.all_partners(vectors, sizes, labels, like))
    assert across == {p for p in found if labels[p[0]] != labels[p[1]]}


def test_counts_beyond_the_vector_bound_nothing():
    a = np.full((1, count_tree.GROUPS), 0xFFFF, np.uint16)
    assert count_tree.shared_at_most(a, a)[0] > 1 << 40


@pytest.mark.parametrize(("n", "sent"), [(1_000, True), (140_000, False)])
def test_joins_send_no_more_than_the_driver_holds(spark, n, sent):
    """140 000 rows are 2 MB of values, but 17 MB of a hashed relation, held by the driver with the blocks it sends."""
    right = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    left = spark.range(2 * n).select((F.col("id") * 3).alias("k"))
    met = frames.spread_join(left, right, ["k"], F.col("k"), row_bytes=16)
    assert ("strategy=broadcast" in met._jdf.queryExecution().analyzed().toString()) == sent
    there = range(0, n, 3)
    assert met.agg(F.count("*"), F.count("v"), F.sum("v")).first() == (2 * n, len(there), 2 * sum(there))


def test_keys_are_told_exactly(monkeypatch):
    """Ids that repeat with other marks, ids of one fingerprint, and null ids."""
    monkeypatch.setattr(ngram_join, "_named", lambda ids, marks: ((ids % 3) * 1000 + marks).astype(np.uint64))
    rng = random.Random(8)
    pairs = [(i, m) for i in range(-20, 40) for m in range(5)]
    rng.shuffle(pairs)
    kept = sorted(pairs[:120])
    keys = ngram_join.Keys(*np.array(kept, np.int64).T)
    rows = pairs + pairs[::3] + [(None, m) for m in range(5)]
    part = pa.record_batch([pa.array([r[c] for r in rows], pa.int64()) for c in (0, 1)], ["_id", "_mark"])
    assert keys.among(part).tolist() == [r in set(kept) for r in rows]
    none = ngram_join.Keys(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert not none.among(part).any() and not keys.among(part.slice(0, 0)).any()


def test_sketch_reaches_the_driver_in_few_jobs(spark, monkeypatch):
    """As many jobs as the sketch has parts, not one for each shuffle partition."""
    monkeypatch.setattr(ngram_join, "shuffle_width", lambda _: 60)
    rng = random.Random(9)
    docs = [(i, cases.prose(rng, 40)) for i in range(50)]
    rows = ngram_join._rows(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), "doc_id", "text")
    bits = ngram_join._FEWEST
    described = ngram_join.materialize(ngram_join.describe(rows, 5, bits))
    spark.sparkContext.setJobGroup("sketch", "sketch")
    try:
        found = ngram_join.frequency_classes(described, bits)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("sketch")
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    texts = pa.array([t.encode() for _, t in docs], pa.binary())
    counts = np.zeros(1 << bits, np.int64)
    for group in ngram_join.text_groups(texts):
        np.add.at(counts, (ngram_join.gram_sets(group, 5)[0] >> np.uint64(64 - bits)).astype(np.int64), 1)
    assert (found == [int(c).bit_length() for c in counts]).all()
    assert 0 < len(jobs) < 20


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a <> 150")
    found = {r.node: r.component for r in cc.components(edges).collect()}
    assert found == {n: 0 if n <= 150 else 151 for n in range(301)}
    assert cc.components(edges.limit(0)).collect() == []


def test_repeats_of_odd_rows(spark):
    df = cases.distinct_frame(spark)
    expected = cases.without_repeats([(r.doc_id, r.text) for r in df.collect()])
    found = {r.doc_id: r for r in remove_repeats(df, carry=["_id", "label"]).collect()}
    assert {i: r.kept for i, r in found.items()} == {i: " ".join(w) for i, w in expected.items()}
    for i, text in enumerate(cases.texts()):
        n = len(cases.words(text))
        assert (found[i].n_words, found[i].n_removed) == (n, n - len(expected[i]))
        assert (found[i]._id, found[i].label) == (-1, 1)


def test_rows_that_repeat_ids_or_have_none(spark):
    rng = random.Random(2)
    one, two = cases.prose(rng, 30), cases.prose(rng, 30)
    rows = [(None, one), (1, one), (2, two), (2, two), (3, two + " " + one)]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in found), key=str) == sorted([(None, 0), (1, 30), (2, 0), (2, 0), (3, 60)], key=str)


@pytest.mark.parametrize("together", [substrings._TOGETHER, 50])
def test_repeats_of_random_texts(spark, monkeypatch, together):
    """Few different words, so that windows repeat within, across and around each other."""
    monkeypatch.setattr(substrings, "_TOGETHER", together)
    rng = random.Random(9)
    docs = [(i, cases.prose(rng, rng.randint(0, 60), "ab")) for i in rng.sample(range(-500, 500), 150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    for window in (1, 2, 5, 20):
        expected = cases.without_repeats(docs, window)
        found = {r.doc_id: r.kept for r in remove_repeats(df, window).collect()}
        assert found == {i: " ".join(w) for i, w in expected.items()}


def test_texts_that_lose_nothing_stay_as_they_are(spark):
    text = "a\n b  c"
    found = remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string"), keep_whole=True).first()
    assert (found.kept, found.n_words, found.n_removed) == (text, 3, 0)


def test_sketch_never_underestimates():
    rng = random.Random(8)
    from churnkit.llm.words import text_groups
    import pyarrow as pa

    text = cases.prose(rng, 4000, "abc")
    group = next(text_groups(pa.array([text.encode()])))
    at, anchor, grams = substrings.anchored(group, 6)
    words, places = text.split(), {}
    for s, a in zip(at, anchor, strict=True):
        assert s <= a <= s + 4
        places.setdefault(tuple(words[s : s + 6]), set()).add(int(a))
    starts = {}
    for s in at:
        starts.setdefault(tuple(words[s : s + 6]), []).append(s)
    assert all(len(places[k]) == len(v) for k, v in starts.items())


def test_empty(spark):
    assert ngram_jaccard_components(cases.empty(spark)).collect() == []
    assert ngram_jaccard_degrees(cases.empty(spark)).collect() == []
    assert ngram_jaccard_links(cases.empty(spark)).collect() == []
    assert remove_repeats(cases.empty(spark)).collect() == []


def test_anchors_depend_on_the_window_alone(monkeypatch):
    """With fingerprints of six bits many grams tie; what stands before a window must not change its choice."""
    import pyarrow as pa

    whole = substrings.mix
    monkeypatch.setattr(substrings, "mix", lambda x: whole(x) >> np.uint64(58))
    rng = random.Random(9)
    tail = cases.prose(rng, 300)
    chosen = []
    for before in (0, 1, 63, 5000):
        text = (cases.prose(rng, before) + " " + tail).encode()
        (group,) = substrings.text_groups(pa.array([text], pa.large_binary()))
        at, anchor, _ = substrings.anchored(group, 20)
        chosen.append((anchor - at)[before:].tolist())
    assert len(chosen[0]) == 281 and all(c == chosen[0] for c in chosen)


def test_rows_without_an_id_are_spread(spark):
    """A third of all rows has no id: their texts are dealt among all tasks of the last shuffle."""
    rng = random.Random(3)
    rows = [(None if i % 3 == 0 else i, cases.prose(rng, 30)) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = remove_repeats(df)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1200 and max(sizes) < 2 * np.median(sizes)


def test_carried_columns_may_not_clash(spark):
    with pytest.raises(ValueError, match="clash"):
        remove_repeats(cases.frame(spark), carry=["kept"])
