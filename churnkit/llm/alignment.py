"""Alignment of the tokens of two tokenizers over a corpus.

Most groups are one token of each with the same bytes. Those are never shuffled as pairs: a table by A id, made once, names the
B id, and the documents of each are counted in a vector as long as the vocabulary. Only pairs of
irregular groups are counted by a shuffle, after every task has added up its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.byte_batches import binary_array
from churnkit.llm.frames import spread_join, text_or_empty
from churnkit.llm.token_pairs import Alignment, TokenPair, align, groups_as_text, token_pair
from churnkit.scratch import materialize

# A pair of ids as one number, below that of the text: ids are under 2**20, texts aligned together under 2**23.
_SHIFT = 20
# Pairs that a task holds before it sends their counts on.
_HELD = 2_000_000
# Bytes of packed ids that are aligned together.
_TOGETHER = 1 << 20


def encode_both(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """A written table with a row per input row: row (a number of its own), id, a_ids, b_ids (packed little-endian integers), n_a,
    n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``, or the SHA-256 of that if ``digest``; empty without tokens).

    Null and empty texts, and those that either tokenizer spells differently from a space and the text, have no tokens.
    Rows may repeat or lack ids. Other columns are not read. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    names = ["id", "a_ids", "b_ids", "n_a", "n_b", "n_groups", "groups"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(a_path, b_path)
        for batch in batches:
            for low, high in portions(pc.binary_length(batch.column(1))):
                part = batch.slice(low, high - low)
                a, b = zip(*[pair.encode(t.as_py()) for t in part.column(1)], strict=True)
                found = align(pair, a, b)
                groups = binary_array(*groups_as_text(pair, found))
                if digest:
                    groups = pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups.to_pylist()])
                packed = (pa.array([x.tobytes() for x in ids], pa.binary()) for ids in (a, b))
                counts = [len(x) for x in a], [len(x) for x in b], np.bincount(found.groups()[0], minlength=len(a))
                columns = [part.column(0), *packed, *(pa.array(n, pa.int64()) for n in counts), groups.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(encode, f"id {kind}, a_ids binary, b_ids binary, n_a long, n_b long, n_groups long, groups string")
    n_links = (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links")
    columns = [F.monotonically_increasing_id().alias("row"), F.col("id").alias(id_col), *names[1:6], n_links, "groups"]
    return materialize(found.select(*columns), "ids")


def portions(sizes: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows (low, high) of about ``most`` bytes; a larger row is a run of its own."""
    ends = sizes.to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    low = 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, "right")))
        yield low, high
        low = high


def _aligned(batches: Iterator[pa.RecordBatch], pair: TokenPair) -> Iterator[tuple[pa.RecordBatch, Alignment]]:
    """Rows with a_ids and b_ids in portions, each with its alignment."""
    for batch in batches:
        for low, high in portions(pc.binary_length(batch.column("a_ids")), _TOGETHER):
            part = batch.slice(low, high - low)
            ids = (
                [np.frombuffer(x, kind) for x in part.column(c).to_pylist()]
                for c, kind in (("a_ids", pair.a_kind), ("b_ids", pair.b_kind))
            )
            yield part, align(pair, *ids)


def _pairs_of(found: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair) of the links, and how often each occurs."""
    text, a, b = found.links()
    keys = np.sort((text << (2 * _SHIFT)) | (a << _SHIFT) | b)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first] >> (2 * _SHIFT), keys[first] & ((1 << (2 * _SHIFT)) - 1), np.diff(np.append(first, len(keys)))


def pair_counts(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(pair, a, b, same, n_docs): documents that hold each linked pair of ids; ``same`` marks pairs of equal bytes.

    ``tokens`` is a table of ``encode_both``. Pairs of equal bytes are added up in a vector by A id in each task, others in sorted
    arrays of bounded length; what the tasks send is their sums.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(a_path, b_path)
        regular = np.zeros(len(pair.same), np.int64)
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh, n_fresh = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            one = np.concatenate(fresh)
            keys, at = np.unique(np.concatenate([codes, one]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([counts, np.ones(len(one))])).astype(np.int64)

        def rows(code: np.ndarray, n: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
            for low in range(0, len(code), 1 << 16):
                k = slice(low, low + (1 << 16))
                columns = code[k], np.full(len(code[k]), same), n[k]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pair", "same", "n_docs"])

        for _, found in _aligned(batches, pair):
            _, code, _ = _pairs_of(found)
            a = code >> _SHIFT
            same = pair.same[a] == code & ((1 << _SHIFT) - 1)
            regular += np.bincount(a[same], minlength=len(regular))
            fresh.append(code[~same])
            n_fresh += len(fresh[-1])
            if n_fresh >= _HELD:
                codes, counts = summed()
                fresh, n_fresh = [], 0
                if len(codes) >= _HELD:
                    yield from rows(codes, counts, False)
                    codes, counts = codes[:0], counts[:0]
        if fresh:
            yield from rows(*summed(), False)
        seen = np.flatnonzero(regular)
        yield from rows((seen << _SHIFT) | pair.same[seen], regular[seen], True)

    sent = tokens.select("a_ids", "b_ids").mapInArrow(count, "pair long, same boolean, n_docs long")
    a, b = F.shiftright("pair", _SHIFT).cast("int"), F.col("pair").bitwiseAND((1 << _SHIFT) - 1).cast("int")
    return sent.groupBy("pair", "same").agg(F.sum("n_docs").alias("n_docs")).select("pair", a.alias("a"), b.alias("b"), "same", "n_docs")


def link_scores(tokens: DataFrame, pairs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(row, n_best, count_sum): links of each row whose pair is in most documents for its A id (ties included), and the sum of
    the documents of all its links' pairs.

    ``pairs`` is a table of ``pair_counts`` over the same rows. Two vectors by A id reach the driver and the tasks, of at most as many
    numbers as the vocabulary has entries: the documents of the regular pair, and the most of any. A pair that is missing
    from the table of those in several documents is in one.
    """
    pairs = materialize(pairs, "pairs")
    size = len(token_pair(a_path, b_path).same)
    regular, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    most = F.max("n_docs").alias("top"), F.max(F.when(F.col("same"), F.col("n_docs"))).alias("regular")
    for r in pairs.groupBy("a").agg(*most).collect():
        top[r["a"]], regular[r["a"]] = r["top"], r["regular"] or 0
    vectors = tokens.sparkSession.sparkContext.broadcast((regular, top))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(a_path, b_path)
        regular, top = vectors.value
        names = ["row", "pair", "times", "top", "n_best", "count_sum"]
        for part, found in _aligned(batches, pair):
            row = part.column("row").to_numpy()
            text, code, times = _pairs_of(found)
            a = code >> _SHIFT
            same = pair.same[a] == code & ((1 << _SHIFT) - 1)
            n = regular[a[same]]
            best = np.bincount(text[same], times[same] * (n == top[a[same]]), len(row)).astype(np.int64)
            total = np.zeros(len(row), np.int64)
            np.add.at(total, text[same], times[same] * n)
            none = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row), none, none, none, pa.array(best), pa.array(total)], names)
            rest = np.flatnonzero(~same)
            for low in range(0, len(rest), 1 << 16):
                k = rest[low : low + (1 << 16)]
                none = pa.nulls(len(k), pa.int64())
                columns = row[text[k]], code[k], times[k], top[a[k]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), none, none], names)

    sent = tokens.select("row", "a_ids", "b_ids").mapInArrow(
        score, "row long, pair long, times long, top long, n_best long, count_sum long"
    )
    several = pairs.where("not same and n_docs > 1").select("pair", "n_docs")
    met = spread_join(sent, several, ["pair"], F.col("row"), row_bytes=16)
    n = F.when(F.col("pair").isNotNull(), F.coalesce("n_docs", F.lit(1)))
    best = F.coalesce("n_best", F.when(n == F.col("top"), F.col("times")).otherwise(0))
    total = F.coalesce("count_sum", n * F.col("times"))
    return met.groupBy("row").agg(F.sum(best).alias("n_best"), F.sum(total).alias("count_sum"))


def with_scores(tokens: DataFrame, scores: DataFrame) -> DataFrame:
    """Columns of ``tokens`` (with ``row``, which is left out) and n_best and count_sum."""
    named = [F.col(f"`{c}`") for c in tokens.columns if c != "row"]
    sums = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return tokens.join(scores, "row", "left").select(*named, *sums)


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum, as told by the functions above."""
    tokens = encode_both(docs, a_path, b_path, id_col, text_col, digest)
    scores = link_scores(tokens, pair_counts(tokens, a_path, b_path), a_path, b_path)
    return with_scores(tokens.drop("a_ids", "b_ids"), scores)
