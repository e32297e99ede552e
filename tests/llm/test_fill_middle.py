import hashlib
import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from churnkit.llm.fill_middle import fill, fill_in_middle, restore_texts, unfill

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc, text, seed="1"):
    """The contract, text by text: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def with_marks(spark):
    more = ["<P>", "a <S> b", "<M", "P> <", "<", ">", "<X> <P", "S> x <M<", "<<P>>", "<P", ">", "é<S>漢"]
    rows = [(1000 + i, t, "s", -1, "t", 5, "k", 3, 9, 1) for i, t in enumerate(more)]
    return cases.frame(spark).unionAll(spark.createDataFrame(rows, cases.SCHEMA))


@pytest.mark.parametrize("parts", [1, 6])
def test_against_plain_python(spark, parts):
    df = with_marks(spark)
    found = restore_texts(fill_in_middle(df.repartition(parts))).collect()
    docs = [(r.doc_id, r.text) for r in df.collect()]
    columns = ("n", "form", "prefix_chars", "middle_chars")
    assert Counter((r.doc_id, *(r[c] for c in columns), bytes(r.output).decode(), bytes(r.restored).decode()) for r in found) == Counter(
        (i, *plain(i, t), t or "") for i, t in docs
    )
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_other_parameters(spark):
    df = with_marks(spark)
    found = fill_in_middle(df, seed=9, plain_from=100, spm_below=100).collect()
    assert {r.form for r in found if r.output and "<P>" in bytes(r.output).decode()} == {"spm", "plain"}
    assert all(bytes(r.output).decode() == plain(r.doc_id, "", "9")[4] for r in found if not r.n)


def test_random_batches_there_and_back():
    rng = random.Random(4)
    parts = ["a", "bc", " ", "é", "漢", "\U0001f600", "<", ">", "P", "S", "<P>", "\n", "Z", "0"]
    for _ in range(400):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(rng.randint(1, 9))]
        raw = [t.encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        draws = np.array([[rng.randrange(1 << 32) for _ in range(4)] for _ in texts])
        out, bounds, n, form, prefix, middle = fill(data, offsets, draws, 90, 20)
        assert n.tolist() == [len(UNIT.findall(t)) for t in texts]
        assert (bounds[1:] - bounds[:-1]).tolist() == [len(r) + 9 * (f > 0) for r, f in zip(raw, form, strict=True)]
        back, starts = unfill(out, bounds, form)
        assert back.tobytes() == data.tobytes() and starts.tolist() == offsets.tolist()


def test_output_without_its_marks_is_refused():
    out = np.frombuffer(b"<P>a<M>b", np.uint8)
    with pytest.raises(ValueError, match="lacks the marks"):
        unfill(out, np.array([0, 8]), np.array([1]))


def test_restoring_odd_rows(spark):
    rows = [(None, None, 1), ("psm", "<P>a<S>c<M>b", 2), ("spm", "<S>c<P>a<M>b", 3), ("plain", "<P>", 4), (None, "x", 5)]
    df = spark.createDataFrame(rows, "form string, output string, restored int")
    assert sorted((r.form or "", bytes(r.restored)) for r in restore_texts(df).collect()) == [
        ("", b""), ("", b"x"), ("plain", b"<P>"), ("psm", b"abc"), ("spm", b"abc"),
    ]


def test_empty(spark):
    assert restore_texts(fill_in_middle(cases.empty(spark))).collect() == []
