"""Rows with everything that can be odd, and plain Python versions of the operators."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns whose names are also used inside operators.
SCHEMA = "doc_id long, text string, source string, _id long, _text string, n long, kept string, bucket long, cell long, label int"


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(n))


def texts(seed=7):
    rng = random.Random(seed)
    base, other = prose(rng, 120), prose(rng, 60)
    words = base.split()
    near = [" ".join(words[:k] + ["x%d" % k] + words[k + 1 :]) for k in (3, 50, 119)]
    found = [
        None, "", " \n\t ", "one", "one two three", base, base, base.upper(), *near, other + " " + base[:200], other,
        other + "\n" + other, "Ünï çödé ß Ω 漢字 \U0001f600 á", "a " * 500, "x" * 70_000, prose(rng, 6000),
        "line one here\nline one here\n\nLINE one  here", "'s 't don't 12 3,4 #*$%&|<> <|endoftext|>", "\x0b\x0c\r\nb\x1cc\x85d",
    ]
    return found + [prose(rng, rng.randint(0, 40), "ab") for _ in range(20)]


def frame(spark, ids=True):
    """Null and repeated ids, repeated rows, null sources, clashing columns."""
    found = texts()
    rows = [(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(found)]
    rows += [rows[5], rows[5], (8, "another text for an id", "s1"), (None, found[5], None), (None, None, None), (None, "free of ids", "s0")]
    return spark.createDataFrame([(*r, -1, "t", 5, "k", 3, 9, 1) for r in rows], SCHEMA)


def distinct_frame(spark):
    """As ``frame``, with one row for each id."""
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, -1, "t", 5, "k", 3, 9, 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, size=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_components(docs, part=80, size=5):
    """docs: (id, text) pairs; component of every id."""
    sets = [(i, shingles(t, size)) for i, t in docs]
    links = [
        (i, j)
        for x, (i, a) in enumerate(sets)
        for j, b in sets[:x]
        if a and b and 100 * len(a & b) >= part * len(a | b)
    ]
    return components(links, {i for i, _ in docs})


def near_links(docs, part=80, size=5):
    """docs: (id, text) pairs; places in ``docs`` of every two rows whose sets are alike."""
    sets = [shingles(t, size) for _, t in docs]
    return [
        (x, y) for x, a in enumerate(sets) for y, b in enumerate(sets[:x]) if a and b and 100 * len(a & b) >= part * len(a | b)
    ]


def without_repeats(docs, window=20):
    """docs: (id, text) pairs with one row an id; kept words by id."""
    first, out = {}, {}
    lists = {i: words(t) for i, t in docs}
    for i in sorted(lists):
        for s in range(len(lists[i]) - window + 1):
            first.setdefault(tuple(lists[i][s : s + window]), (i, s))
    for i, w in lists.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (i, s):
                gone.update(range(s, s + window))
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def line_verdicts(rows, line_docs=20, line_share=0.02):
    """rows: (id, text, source) with one row an id; (base_failed, kept, removed words) by id."""
    plain = lambda line: " ".join(words(line.lower()))
    lines = {i: [plain(x) for x in (t or "").split("\n") if words(x)] for i, t, _ in rows}
    docs, hosts = Counter(), Counter(s for _, _, s in rows)
    for i, _, s in rows:
        docs.update((s, x) for x in set(lines[i]))
    out = {}
    for i, t, s in rows:
        w = words(t)
        at = defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        again = {k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(5)}
        gone = sum(len(x.split()) for x in lines[i] if docs[s, x] > line_docs and docs[s, x] > hosts[s] * line_share)
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        left = len(w) - gone
        out[i] = (failed, not failed and left >= 10 and 100 * left >= 50 * len(w), gone)
    return out
