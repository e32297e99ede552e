import base64
import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from churnkit.llm import rank_bpe as rank_bpe_module
from churnkit.llm.packing import OpenSequences, pack_documents
from churnkit.llm.rank_bpe import chunks_of, decode_ids, encode_stretch, encode_texts, rank_bpe, stitch
from churnkit.llm.token_files import read_token_files, write_token_files
from churnkit.llm.word_tokens import WordTokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


SPECIAL = [
    "abc <|endoftext|> def", "<|startoftext|>", "a<|startoftext|>b<|endoftext|>", "A <|ENDOFTEXT|> b", "<|endoftext|", "x <|End", "<|endoftext|><|endoftext|> Ü",
]


@pytest.fixture(scope="module")
def word_ids():
    library = Tokenizer.from_file(WORDS)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rank_ids():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: encoding.encode_ordinary(text or "")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_as_the_library(word_ids):
    rng = random.Random(3)
    letters = "abcXYZé ÉßŒıİſΣσ́ẞ0123!?#'’ \n\t \x85\x1c <|>漢字\U0001f600ǅŉž"
    words = WordTokens(WORDS, limit=50)
    for text in ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(800)] + ["'s'T don't <|endoftext|>x", "ΑΣ ΑΣΑ", *SPECIAL]:
        assert np.frombuffer(words.ids(text.encode()), words.kind).tolist() == word_ids(text), repr(text)


def with_special(spark):
    rows = [(1000 + i, t, "s", -1, "t", 5, "k", 3, 9, 1) for i, t in enumerate(SPECIAL)]
    return cases.frame(spark).unionAll(spark.createDataFrame(rows, cases.SCHEMA))


def test_token_files(spark, word_ids):
    df = with_special(spark)
    found = read_token_files(write_token_files(df.repartition(5), WORDS, end_id=2)).collect()
    rows = sorted(found, key=lambda r: r.start)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(
        (i, len(word_ids(t)) + 1, crc(word_ids(t) + [2])) for i, t in docs
    )
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)


def test_packing(spark, word_ids):
    df = with_special(spark)
    rows = pack_documents(df.repartition(4), WORDS, size=256, most_open=3, with_ids=True).collect()
    expected, found = Counter(), Counter()
    for r in df.collect():
        ids = word_ids(r.text) + [0]
        for k, low in enumerate(range(0, len(ids), 256)):
            part = ids[low : low + 256]
            expected[r.doc_id, k, low, len(part), crc(part)] += 1
    by = defaultdict(list)
    for r in rows:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        by[r.sequence_id].append(r)
        assert crc(np.frombuffer(r.ids, "<u2")) == r.ids_crc32
    assert found == expected
    for held in by.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == np.cumsum([0, *[r.length for r in held]])[:-1].tolist()
        assert sum(r.length for r in held) <= 256
    assert len(by) <= 1.1 * sum(r.length for r in rows) / 256 + 1


def test_best_fit_against_a_plain_list():
    rng = random.Random(5)
    bins, free, seen = OpenSequences(100, 4), {}, 0
    for _ in range(3000):
        n = rng.randint(1, 100)
        sequence, offset, closed = bins.place(n)
        fits = [f for f in free.values() if f >= n]
        if fits:
            assert free[sequence] == min(fits) and closed is None
        else:
            if len(free) == 4:
                assert free[closed] == min(free.values())
                del free[closed]
            else:
                assert closed is None
            assert sequence == seen
            free[sequence], seen = 100, seen + 1
        assert offset == 100 - free[sequence]
        free[sequence] -= n
        if not free[sequence]:
            del free[sequence]
        assert len(free) <= 4


def test_rank_encoding_and_decoding(spark, rank_ids):
    df = cases.frame(spark)
    docs = [(r.doc_id, r.text or "") for r in df.collect()]
    for chunk, overlap in ((1 << 15, 1 << 9), (64, 8), (1000, 100)):
        encoded = encode_texts(df, RANKS, PATTERN, chunk=chunk, overlap=overlap)
        bpe = rank_bpe(RANKS, PATTERN)
        found = Counter((r.doc_id, r.n_tokens, tuple(np.frombuffer(r.ids, bpe.kind).tolist())) for r in encoded.collect())
        assert found == Counter((i, len(rank_ids(t)), tuple(rank_ids(t))) for i, t in docs)
    plain = Counter((r.doc_id, bytes(r.decoded)) for r in decode_ids(encoded, RANKS, PATTERN).collect())
    assert plain == Counter((i, t.encode()) for i, t in docs)


def test_stitching_random_texts(rank_ids):
    rng, bpe = random.Random(1), rank_bpe(RANKS, PATTERN)
    parts = ["a", " ", "  \n", "'s", "12", "é!", "?", "\t", " b", "漢字", " "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) * rng.choice([1, 1, 1, 9, 40]) for _ in range(rng.randint(1, 50)))
        chunk, overlap = rng.choice([(7, 3), (20, 10), (3, 1), (50, 5)])
        made = stitch(bpe, (encode_stretch(bpe, piece, at) for at, piece in chunks_of(text, chunk, overlap)))
        assert np.frombuffer(made, bpe.kind).tolist() == rank_ids(text), (text, chunk, overlap)


def test_a_run_over_many_chunks_is_encoded_once(rank_ids, monkeypatch):
    """Pre-tokens of many chunks, alone and among others; the work is that of the text, not of its square."""
    bpe = rank_bpe(RANKS, PATTERN)
    for text in ("a" * 9000, "x y " + "b" * 5000 + " c " + "é" * 3000 + "\n", " " * 4000 + "a", "ab " * 900 + "z" * 2000):
        chunks = [encode_stretch(bpe, piece, at) for at, piece in chunks_of(text, 256, 16)]
        sizes = []
        whole = rank_bpe_module.encode_stretch
        monkeypatch.setattr(rank_bpe_module, "encode_stretch", lambda b, t, s: sizes.append(len(t)) or whole(b, t, s))
        made = stitch(bpe, iter(chunks))
        monkeypatch.undo()
        assert np.frombuffer(made, bpe.kind).tolist() == rank_ids(text)
        assert sum(sizes) < 1.3 * len(text) + 600


def test_empty(spark):
    none = cases.empty(spark)
    assert encode_texts(none, RANKS, PATTERN).collect() == []
    assert pack_documents(none, WORDS).collect() == []
    assert read_token_files(write_token_files(none, WORDS, end_id=2)).collect() == []
