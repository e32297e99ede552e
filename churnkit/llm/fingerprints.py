"""Document fingerprints as threshold-scaled sketches of word shingles.

A fingerprint keeps every shingle hash below a fixed fraction of the hash space, so it grows with its text and the
union of two fingerprints is the fingerprint of both texts together. The share of the smaller one's hashes that the larger
one holds estimates containment, however unequal the two documents are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.byte_batches import lead_bytes
from churnkit.llm.frames import shuffle_width, text_or_empty
from churnkit.llm.id_order import in_order
from churnkit.llm.words import Lane, Texts, text_groups

SHINGLE = 5
SCALE = 8
_LANE = Lane(2203)
_DIGITS = 16


def sketches(texts: Texts, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept shingle hashes of each text, distinct and in rising order, and where each text's begin (and the end).

    A text with fewer than ``size`` words is one shingle. If no hash of a text lies below the threshold, its least one
    is kept, so that only texts without words have an empty sketch.
    """
    hashes, at = texts.window_hashes(_LANE, size)
    short = np.flatnonzero((texts.n_words > 0) & (texts.n_words < size))
    owner = np.concatenate([np.searchsorted(texts.first, at, "right") - 1, short])
    hashes = np.concatenate([hashes, texts.span_hashes(_LANE)[short]])
    kept = hashes <= np.uint64((1 << 64) // scale - 1)
    bare = texts.n_words > 0
    bare[owner[kept]] = False
    least = np.full(len(bare), np.iinfo(np.uint64).max)
    of_bare = bare[owner]
    np.minimum.at(least, owner[of_bare], hashes[of_bare])
    hashes = np.concatenate([hashes[kept], least[bare]])
    owner = np.concatenate([owner[kept], np.flatnonzero(bare)])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
        hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(bare) + 1))


def sketched(texts: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``sketches`` of a whole binary column."""
    found = [sketches(group, size, scale) for group in text_groups(texts)]
    counts = [np.diff(bounds) for _, bounds in found]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *(h for h, _ in found)]), np.append(0, np.cumsum(np.concatenate([none.astype(int), *counts])))


def written(hashes: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Each sketch as text: its hashes in rising order, sixteen hexadecimal digits each."""
    digits = hashes.astype(">u8").tobytes().hex()
    return [digits[_DIGITS * a : _DIGITS * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def contained(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each text of two equally long lists, the share of the smaller sketch that is in the larger one.

    Two empty sketches are alike, an empty one and another are not.
    """
    sizes = [np.diff(bounds) for _, bounds in (a, b)]
    owner = np.concatenate([np.repeat(np.arange(len(n)), n) for n in sizes])
    hashes = np.concatenate([a[0], b[0]])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    both = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
    shared = np.bincount(owner[both], minlength=len(sizes[0]))
    least = np.minimum(*sizes)
    return np.where(least > 0, shared / np.maximum(least, 1), np.maximum(*sizes) == 0)


def document_fingerprints(
    docs: DataFrame, size: int = SHINGLE, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, fingerprint.

    Words are runs without white space, unchanged. Null texts count as empty; texts without words have an empty fingerprint. Rows may
    repeat or lack ids. Other columns are not read. An empty table gives an empty one.
    """
    schema = f"`{id_col}` long, fingerprint string"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in text_groups(batch.column(1)):
                found = pa.array(written(*sketches(group, size, scale)), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[group.rows], found], [id_col, "fingerprint"])

    text = text_or_empty(text_col).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text")).mapInArrow(measure, schema)


def hashes_of(fingerprint: str | Column) -> Column:
    """The hashes of a fingerprint as an array of texts; null counts as empty."""
    c = F.coalesce(F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint, F.lit(""))
    return F.regexp_extract_all(c, F.lit(f"[0-9a-f]{{{_DIGITS}}}"), F.lit(0))


def containment(small: str | Column, large: str | Column) -> Column:
    """Estimated share of the shingles behind ``small`` that ``large`` holds; 1 for an empty ``small``."""
    a, b = hashes_of(small), hashes_of(large)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merge_fingerprints(rows: DataFrame, keys: Sequence[str], fingerprint: str = "fingerprint") -> DataFrame:
    """The fingerprint of all texts of each group together: keys, fingerprint.

    Hashes are made distinct before they meet. A group of nulls and empty fingerprints has an empty one. A group's fingerprint is one
    value, so a group may hold at most what a row can: some hundred million words.
    """
    hashes = rows.select(*keys, F.explode_outer(hashes_of(fingerprint)).alias("_hash")).distinct()
    joined = F.concat_ws("", F.sort_array(F.collect_list("_hash")))
    return hashes.groupBy(*keys).agg(joined.alias("fingerprint"))


def fingerprint_edits(
    docs: DataFrame, size: int = SHINGLE, scale: int = SCALE, part: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document beside an edited version of itself and the document after it.

    One row per input row: id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited text has its last n_chars // ``part`` code points replaced by the first as many of the next document's (all, if
    it has fewer), in ascending order of ids, the first following the last. The two likenesses are those of ``contained``.

    Null texts count as empty. Rows without an id come first, rows that repeat one follow each other by a hash of
    their texts; rows that repeat both meet in one task. Other columns are not read. An empty table gives an empty one.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_mark"), text.cast("binary").alias("_text"))
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = ["long", "long", "string", "string", "string", "double", "double"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.RecordBatch] = []
        for batch in batches:
            size_at = pc.binary_length(batch.column("_text")).to_numpy().cumsum()
            low = 0
            while low < batch.num_rows:
                # About a megabyte of texts, after the last row of those before.
                done = size_at[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(size_at, done + (1 << 20), "right")))
                block = pa.Table.from_batches([*last, batch.slice(low, high - low)]).combine_chunks()
                if block.num_rows > 1:
                    yield compared(block)
                last = block.slice(block.num_rows - 1).to_batches()
                low = high

    def compared(block: pa.Table) -> pa.RecordBatch:
        """Every row but the last with the one after it; guards are only looked at."""
        texts = [t.as_py() for t in block.column("_text")]
        ids = block.column("_id").combine_chunks()
        real = ~block.column("guard").to_numpy()[:-1]
        own = sketched(block.column("_text"), size, scale)
        n_chars, edited = [], []
        for here, after in zip(texts[:-1], texts[1:], strict=True):
            lead = np.flatnonzero(lead_bytes(np.frombuffer(here, np.uint8)))
            gone = len(lead) // part
            kept = here[: lead[len(lead) - gone]] if gone else here
            n_chars.append(len(lead))
            edited.append(kept + after[:4 * gone].decode("utf-8", "ignore")[:gone].encode())
        others = sketched(pa.array(edited, pa.large_binary()), size, scale)
        hashes, bounds = own
        mine = hashes[: bounds[-2]], bounds[:-1]
        following = hashes[bounds[1] :], bounds[1:] - bounds[1]
        columns = [
            ids[:-1],
            pa.array(n_chars, pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
            pa.array(written(*mine), pa.string()),
            pa.array(written(*others), pa.string()),
            pa.array(contained(mine, others), pa.float64()),
            pa.array(contained(mine, following), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(real))

    ordered = in_order(rows, shuffle_width(docs.sparkSession))
    return ordered.mapInArrow(compare, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))
