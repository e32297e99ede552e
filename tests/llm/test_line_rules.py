import random

import cases
from pyspark.sql import functions as F

from churnkit.llm import frames
from churnkit.llm.line_rules import quality_rules, text_counts


def test_odd_rows(spark):
    df = cases.frame(spark)
    rows = quality_rules(df).collect()
    assert len(rows) == df.count()
    for r in (r for r in rows if r.doc_id is not None and r.doc_id != 8):
        text = cases.texts()[r.doc_id] or ""
        w = cases.words(text)
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        lines = [x for x in text.split("\n") if cases.words(x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))


def lined(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(15))
    footer = "Read MORE  on our site today and tomorrow and then some more of it please do so now"
    rows = []
    for i in range(300):
        source = None if i % 3 == 0 else f"h{i % 3}"
        text = own(i)
        if i % 4 == 0:
            text += "\n" + (footer if i % 8 else footer.lower().replace("  ", "\t"))
        if i % 20 == 0:
            text = footer + "\n" + " ".join(f"v{i}x{k}" for k in range(9))
        rows.append((i, text, source))
    return rows


def test_frequent_lines(spark, monkeypatch):
    rows = lined(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    expected = cases.line_verdicts(rows)
    assert {kept for _, kept, _ in expected.values()} == {True, False} and any(g for _, _, g in expected.values())
    for limit in (frames.BROADCAST_BYTES, -1):
        monkeypatch.setattr(frames, "BROADCAST_BYTES", limit)
        found = {r.doc_id: (r.base_failed, r.kept, r.n_line_words_removed) for r in quality_rules(df).collect()}
        assert found == expected


def test_no_python_on_the_way(spark):
    plan = quality_rules(cases.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert quality_rules(cases.empty(spark)).collect() == []


def test_long_text_of_many_repeats(spark):
    """A text said twice, so that every window repeats: in proportion to its length, not to the square."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    texts = [" ".join(words + words), " ".join(words + ["x", "y"] + words[:7]), " ".join(words[:20_000])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(text_counts(F.col("t"))["_counts"]["n_repeat_words"]).collect()]
    assert found == [60_000, 14, 0]
