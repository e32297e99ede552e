"""Removal of word windows that occur earlier in the corpus, behind a count-min prefilter.

Every window of (say) 20 words is keyed by its anchor: of the shorter grams inside it, the one with the
smallest fingerprint. Equal windows have equal anchors, at places of their own, so the number of places of an
anchor is never less than that of any window with it. Pass one counts the places of anchors in count-min sketches,
one per partition, and merges them; the merged sketch overestimates window counts. Pass two groups, exactly,
only windows whose estimate is two or more; none that repeats is lost. Each task first settles the
repeats it sees itself and asks only about its own first ones, so a window that is everywhere costs one
entry per task. Pass three brings what is to go to the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.blobs import (
    BLOB_DDL,
    BUCKETS_PER_TASK,
    batch,
    blob_rows,
    dealt,
    exchanged,
    gathered,
    joined,
    pack,
    unpack,
)
from churnkit.llm.frames import shuffle_width, text_or_empty
from churnkit.llm.words import Lane, Texts, mix, range_sums, text_groups
from churnkit.scratch import materialize

WINDOW = 20
NO_ID = -(1 << 63)
# Counters for each document in each of the two rows of the sketch, and the limits of a row, as powers of two.
COUNTERS_PER_DOC = 256
FEWEST, MOST = 20, 29
_BLOCK = 20  # a block of a row is merged at a time
# Windows that a task gathers before it settles them among themselves.
_TOGETHER = 2_000_000
_ONE, _TWO = Lane(501), Lane(502)
_ROW_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def anchored(texts: Texts, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every window, the word where its anchor begins, and fingerprints of all grams."""
    gram = max(1, window * 2 // 5)
    words = texts.word_hashes(_ONE)
    at = texts.window_starts(window)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    forward, back = _ONE.powers(_ONE.word_base, len(words))
    first = np.arange(len(words) - gram + 1)
    grams = mix(range_sums(words * forward, first, first + gram) * back[first])
    # The least gram of each window and its leftmost place, kept apart so that the choice depends on the window alone.
    least, place = grams, first
    span, reach = window - gram + 1, 1
    while 2 * reach <= span:
        least, place = _lesser(least, place, reach, len(least) - reach)
        reach *= 2
    if reach < span:
        least, place = _lesser(least, place, span - reach, len(least) - (span - reach))
    return at, place[at], grams


def _lesser(least: np.ndarray, place: np.ndarray, ahead: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each of the first ``n`` values and the one so far ahead, the smaller, the first of equal ones, and its place."""
    later = least[ahead : ahead + n] < least[:n]
    return np.where(later, least[ahead : ahead + n], least[:n]), np.where(later, place[ahead : ahead + n], place[:n])


def counters(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    """The counter of each anchor in each row."""
    return [(mix(anchors ^ seed) >> np.uint64(64 - bits)).astype(np.int64) for seed in _ROW_SEEDS]


def sketch_bits(rows: int) -> int:
    return min(MOST, max(FEWEST, int(rows * COUNTERS_PER_DOC - 1).bit_length() if rows else FEWEST))


def repeated_counters(texts: DataFrame, window: int, bits: int) -> np.ndarray:
    """Merged sketch as bitmaps: whether a counter of a row reached two. Its size is bounded by 2**MOST bits a row."""
    block = min(_BLOCK, bits)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[list[np.ndarray]] = [[], []]
        held = 0

        def merged() -> Iterator[tuple[int, bytes]]:
            for row, parts in enumerate(seen):
                at, n = np.unique(np.concatenate(parts), return_counts=True)
                for b, part in dealt(at >> block):
                    inside = (at[part] & ((1 << block) - 1)).astype(np.uint32)
                    yield (row << 32) + b, pack(inside[n[part] == 1], inside[n[part] > 1])

        for rows in batches:
            for texts_ in text_groups(rows.column(rows.num_columns - 1)):
                _, anchor, grams = anchored(texts_, window)
                # A place counts once, however many windows have it.
                places = anchor[np.append(True, anchor[1:] != anchor[:-1])] if len(anchor) else anchor
                for row, found in enumerate(counters(grams[places], bits)):
                    seen[row].append(found)
                held += len(places)
                if held >= 2 * _TOGETHER:
                    yield from blob_rows(merged())
                    seen, held = [[], []], 0
        if held:
            yield from blob_rows(merged())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple[int, bytes]]:
            for bucket, blobs in gathered(batches):
                count = np.zeros(1 << block, np.uint8)
                for blob in blobs:
                    once, more = unpack(blob)
                    count[once] = np.minimum(count[once] + 1, 2)
                    count[more] = 2
                yield bucket, np.packbits(count == 2).tobytes()

        yield from blob_rows(blocks())

    sketches = texts.mapInArrow(sketch, BLOB_DDL)
    width = shuffle_width(texts.sparkSession)
    bitmap = np.zeros((2, (1 << bits) >> 3), np.uint8)
    step = (1 << block) >> 3
    for row in exchanged(sketches, width).mapInArrow(merge, BLOB_DDL).toLocalIterator():
        level, b = divmod(row["bucket"], 1 << 32)
        bitmap[level, b * step : (b + 1) * step] = np.frombuffer(row["blob"], np.uint8)
    return bitmap


class _Documents:
    """Ids, marks and buckets of documents; equal ids are told apart by the hash of the text."""

    def __init__(self, ids: np.ndarray, marks: np.ndarray, buckets: np.ndarray):
        self.ids, self.marks, self.buckets = ids, marks, buckets

    def ranks(self) -> np.ndarray:
        """Place in the order by (id, mark); equal ones share it."""
        order = np.lexsort((self.marks, self.ids))
        ids, marks = self.ids[order], self.marks[order]
        new = np.append(False, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])) if len(ids) else np.zeros(0, bool)
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out


def _not_first(docs: _Documents, of: np.ndarray, at: np.ndarray, anchor: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether each window has an equal one that starts earlier."""
    place = (docs.ranks()[of] << 32) + at
    order = np.lexsort((place, anchor, digest))
    d, a, p = digest[order], anchor[order], place[order]
    same = (d[1:] == d[:-1]) & (a[1:] == a[:-1])
    # The first place of each group; a repeated row has the same place, and is not later than itself.
    starts = np.flatnonzero(np.append(True, ~same))
    first = np.repeat(p[starts], np.diff(np.append(starts, len(p))))
    out = np.empty(len(order), bool)
    out[order] = p != first
    return out


def _runs(*keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of windows begin whose keys agree and whose starts follow each other, and their lengths."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = at[1:] != at[:-1] + 1
    for key in keys:
        new |= key[1:] != key[:-1]
    begin = np.flatnonzero(np.append(True, new))
    return begin, np.diff(np.append(begin, len(at)))


def _removals(docs: _Documents, of: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Windows to remove, as runs, by bucket of their document; below zero so as not to meet questions."""
    begin, length = _runs(of, at=at)
    doc = of[begin]
    for bucket, part in dealt(docs.buckets[doc]):
        yield -1 - bucket, pack(docs.ids[doc[part]], docs.marks[doc[part]], at[begin[part]].astype(np.int32), length[part].astype(np.int32))


def _questions(docs: _Documents, of, at, anchor, digest, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Windows to be settled with those of other tasks, by bucket of their anchor."""
    for bucket, part in dealt((anchor % np.uint64(buckets)).astype(np.int64)):
        begin, length = _runs(of[part], anchor[part], at=at[part])
        used, doc = np.unique(of[part][begin], return_inverse=True)
        yield bucket, pack(
            docs.ids[used], docs.marks[used], docs.buckets[used], np.array([len(used)]), doc.astype(np.int32),
            np.array([len(doc)]), at[part][begin].astype(np.int32), length.astype(np.int32), anchor[part][begin], digest[part],
        )


def mark_repeated_windows(texts: DataFrame, window: int, bitmap: np.ndarray, bits: int, buckets: int) -> DataFrame:
    """Runs of windows that start earlier elsewhere, as blobs by bucket of the document."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(bitmap)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = shared.value
        held: list[tuple[np.ndarray, ...]] = []
        docs: list[tuple[np.ndarray, ...]] = []
        n_docs = n_windows = 0

        def settle() -> Iterator[tuple[int, bytes]]:
            of, at, anchor, digest = (np.concatenate(x) for x in zip(*held, strict=True))
            known = _Documents(*(np.concatenate(x) for x in zip(*docs, strict=True)))
            later = _not_first(known, of, at, anchor, digest)
            yield from _removals(known, of[later], at[later])
            yield from _questions(known, of[~later], at[~later], anchor[~later], digest[~later], buckets)

        for rows in batches:
            ids = rows.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            marks, homes = (rows.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            for group in text_groups(rows.column(3)):
                at, anchor, grams = anchored(group, window)
                here = grams[anchor]
                often = np.ones(len(at), bool)
                for row, c in enumerate(counters(here, bits)):
                    often &= (rows_of[row][c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
                if not often.any():
                    continue
                digest, _ = group.window_hashes(_TWO, window)
                of = np.searchsorted(group.first, at, "right") - 1
                chosen = np.flatnonzero(often)
                held.append((of[chosen] + n_docs, (at - group.first[of])[chosen], here[chosen], digest[chosen]))
                docs.append((ids[group.rows], marks[group.rows], homes[group.rows]))
                n_docs += len(docs[-1][0])
                n_windows += len(chosen)
                if n_windows >= _TOGETHER:
                    yield from blob_rows(settle())
                    held, docs, n_docs, n_windows = [], [], 0, 0
        if held:
            yield from blob_rows(settle())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def later() -> Iterator[tuple[int, bytes]]:
            for _, blobs in gathered(batches):
                ids, marks, homes, n_docs, doc, n_runs, at, length, anchor, digest = joined(blobs)
                doc = doc + np.repeat(np.cumsum(n_docs) - n_docs, n_runs)
                step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                of, start = np.repeat(doc, length), np.repeat(at, length) + step
                known = _Documents(ids, marks, homes)
                gone = _not_first(known, of, start, np.repeat(anchor, length), digest)
                yield from _removals(known, of[gone], start[gone])

        yield from blob_rows(later())

    asked = materialize(texts.mapInArrow(ask, BLOB_DDL), "windows")
    settled = asked.where("bucket < 0")
    answered = exchanged(asked.where("bucket >= 0"), shuffle_width(spark)).mapInArrow(answer, BLOB_DDL)
    return settled.unionAll(answered).select((-1 - F.col("bucket")).alias("bucket"), "blob")


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    keep_whole: bool = False,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (words joined by one space), and the ``carry`` columns.

    With ``keep_whole`` a text that loses nothing stays as it is, white space included. Carried columns must have other
    names than the four above.

    A word goes if a window over it, in its document, also starts earlier in the corpus: in a document with a
    smaller id, or further ahead in the same. Windows are judged on the input. Null texts count as empty.
    A missing id is the smallest. Rows that repeat an id are ordered by a hash of their text; rows that repeat id
    and text count as one and are treated alike. Window equality is that of 128 bits of fingerprints. An empty table
    gives an empty one.
    """
    carry = carry or []
    clashing = {id_col, "n_words", "n_removed", "kept"} & set(carry)
    if clashing:
        raise ValueError(f"carried columns clash with those of the result: {sorted(clashing)}")
    spark = docs.sparkSession
    width = shuffle_width(spark)
    buckets = BUCKETS_PER_TASK * width
    text, number = text_or_empty(text_col), F.col(id_col).cast("long")
    # Rows without an id, or with one that repeats, are spread by their texts.
    home = F.pmod(F.xxhash64(number, F.xxhash64(text)), F.lit(buckets))
    texts = docs.select(number.alias("_id"), F.xxhash64(text).alias("_mark"), home.alias("_home"), text.cast("binary").alias("_text"))
    bits = sketch_bits(docs.count())
    bitmap = repeated_counters(texts.select("_text"), window, bits)
    marked = mark_repeated_windows(texts, window, bitmap, bits, buckets)
    rest = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(carry)])
    rows = docs.select(
        home.alias("bucket"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("blob"), number.alias("_id"),
        F.xxhash64(text).alias("_mark"), text.cast("binary").alias("_text"), rest.alias("_rest"),
    )
    rest_type = rows.schema["_rest"].dataType
    notes = marked.select(
        "bucket", F.lit(0).alias("kind"), "blob", F.lit(None).cast("long").alias("_id"), F.lit(None).cast("long").alias("_mark"),
        F.lit(None).cast("binary").alias("_text"), F.lit(None).cast(rest_type).alias("_rest"),
    )
    met = notes.unionAll(rows).repartitionById(width, F.pmod("bucket", F.lit(width)).cast("int")).sortWithinPartitions("bucket", "kind")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs, runs = None, [], None
        for rows in batches:
            kinds, homes = rows.column("kind").to_pylist(), rows.column("bucket").to_pylist()
            out: list[tuple] = []
            taken: list[int] = []
            size = 0
            for i, (kind, bucket) in enumerate(zip(kinds, homes, strict=True)):
                if bucket != now:
                    now, blobs, runs = bucket, [], None
                if kind == 0:
                    blobs.append(rows.column("blob")[i].as_py())
                    continue
                if runs is None:
                    runs, blobs = _by_document(blobs), []
                doc = rows.column("_id")[i].as_py()
                words = rows.column("_text")[i].as_py().split()
                found = runs.get((NO_ID if doc is None else doc, rows.column("_mark")[i].as_py()))
                kept = words if found is None else _uncovered(words, *found, window)
                left = rows.column("_text")[i].as_py() if keep_whole and len(kept) == len(words) else b" ".join(kept)
                out.append((doc, len(words), len(words) - len(kept), left.decode("utf-8", "replace")))
                taken.append(i)
                size += len(out[-1][3])
                if size >= 4 << 20:
                    yield result(rows, out, taken)
                    out, taken, size = [], [], 0
            if out:
                yield result(rows, out, taken)

    kinds = {"_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}

    def result(rows: pa.RecordBatch, out: list[tuple], taken: list[int]) -> pa.RecordBatch:
        made = batch(kinds, *zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([*made.columns, rows.column("_rest").take(pa.array(taken))], [*kinds, "_rest"])

    schema = f"_id long, n_words long, n_removed long, kept string, _rest {rest_type.simpleString()}"
    done = met.select("bucket", "kind", "blob", "_id", "_mark", "_text", "_rest").mapInArrow(cut, schema)
    extra = [F.col(f"_rest.f{i}").alias(c) for i, c in enumerate(carry)]
    return done.select(F.col("_id").alias(id_col), "n_words", "n_removed", "kept", *extra)


def _by_document(blobs: list[bytes]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Runs of each (id, mark)."""
    if not blobs:
        return {}
    ids, marks, at, length = joined(blobs)
    order = np.lexsort((marks, ids))
    ids, marks, at, length = ids[order], marks[order], at[order], length[order]
    begin = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])))
    ends = np.append(begin[1:], len(ids))
    return {(int(ids[a]), int(marks[a])): (at[a:b], length[a:b]) for a, b in zip(begin, ends, strict=True)}


def _uncovered(words: list[bytes], at: np.ndarray, length: np.ndarray, window: int) -> list[bytes]:
    """Words that no window of the runs covers."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + length - 1 + window, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
