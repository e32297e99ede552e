import hashlib
import random
import re
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from churnkit.llm import alignment
from churnkit.llm.alignment import align_tokenizers, encode_both, pair_counts
from churnkit.llm.catalog import QUERIES
from churnkit.llm.token_pairs import TokenPair

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in LETTERS} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in LETTERS)}


@pytest.fixture(scope="module")
def libraries():
    """Tokens (id, bytes) of a text by either library as it comes, or none of either."""
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    def tokens(text):
        text = text or ""
        a = [(i, bytes(BYTE[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in second.encode(text)]
        whole = (" " + text).encode()
        good = text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b)
        return (a, b) if good else ([], [])

    return tokens


def spans(tokens):
    at, out = 0, []
    for i, spelt in tokens:
        out.append((i, at, at + len(spelt)))
        at += len(spelt)
    return out


def plain(texts, tokens):
    """The contract, token by token: a row for each text."""
    found, counts = [], Counter()
    for text in texts:
        a, b = (spans(x) for x in tokens(text))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        cuts = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups = []
        for low, high in zip([0, *cuts], cuts, strict=False):
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < high) for side in (a, b)))
        counts.update(set(links))
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(top.get(i, 0), n)
    return [
        (n_a, n_b, n_groups, len(links), groups, sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links))
        for n_a, n_b, n_groups, links, groups in found
    ]


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


def check(spark, df, libraries, found):
    docs = [(r.doc_id, r.text) for r in df.collect()]
    expected = Counter((i, *p) for (i, _), p in zip(docs, plain([t for _, t in docs], libraries), strict=True))
    assert Counter((r.doc_id, *(r[c] for c in NUMBERS)) for r in found.collect()) == expected


def short_frame(spark):
    """All odd rows, the two longest texts cut for the sake of the plain version."""
    return cases.frame(spark).selectExpr("doc_id", "substring(text, 1, 3000) AS text", "n", "label", "bucket", "_id")


def test_encoding_as_the_libraries(libraries):
    rng = random.Random(3)
    letters = "abcXYZé ÉßŒıİſΣσ́ẞ0123!?#'’ \n\n\t\r \x85\x1c\x00<|>漢字\U0001f600ǅŉž  ▁.,;-а\xa0​"
    pair = TokenPair(A, B)
    odd = ["'s'T don't <|endoftext|>x", "</s><unk><s> <0x41>", "  lead  and trail  ", "\n\n a \n", "x\n y", "▁", "", "a" * 400, "²." * 3, "  \n 　b"]
    for text in ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(1500)] + odd + [t for t in cases.texts() if t]:
        a, b = pair.encode(text)
        theirs = libraries(text)
        assert (a.tolist(), b.tolist()) == tuple([i for i, _ in x] for x in theirs), repr(text)


def test_the_longer_way_gives_the_same(libraries):
    pair = TokenPair(A, B)
    assert pair.a_ranked is not None and pair.b_ranked is not None
    pair.a_ranked = pair.b_ranked = None
    for text in cases.texts():
        assert tuple(x.tolist() for x in pair.encode(text)) == tuple([i for i, _ in x] for x in libraries(text))


def test_against_every_two_tokens(spark, libraries):
    df = short_frame(spark)
    check(spark, df, libraries, align_tokenizers(df.repartition(5), A, B))


def test_counts_in_small_portions_and_joined_by_shuffle(spark, libraries, monkeypatch):
    df = short_frame(spark)
    monkeypatch.setattr(alignment, "_HELD", 50)
    monkeypatch.setattr(alignment, "_TOGETHER", 100)
    monkeypatch.setattr("churnkit.llm.frames.BROADCAST_BYTES", 0)
    check(spark, df, libraries, align_tokenizers(df.repartition(5), A, B))


def test_regular_pairs_have_equal_bytes(spark):
    pair = TokenPair(A, B)
    rows = pair_counts(encode_both(cases.frame(spark), A, B), A, B).collect()
    assert len({r.pair for r in rows}) == len(rows) and any(r.same for r in rows) and not all(r.same for r in rows)
    for r in rows:
        if r.same:
            assert pair.a_bytes[r.a] == pair.b_bytes[r.b]
    known = np.flatnonzero(pair.same >= 0)
    assert all(pair.a_bytes[i] == pair.b_bytes[pair.same[i]] for i in known)


def test_query_on_a_given_table(spark, libraries):
    rows = {r.doc_id: r for r in QUERIES["op11_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert sorted(rows) == sorted(r.doc_id for r in docs)
    for r in docs[:25]:
        (expected,) = plain([r.text], libraries)
        found = rows[r.doc_id]
        assert (found.n_a, found.n_b, found.n_groups, found.n_links) == expected[:4]
        assert found.groups_sha256 == (hashlib.sha256(expected[4].encode()).hexdigest() if expected[2] else "")


def test_empty(spark):
    assert align_tokenizers(cases.empty(spark), A, B).collect() == []
