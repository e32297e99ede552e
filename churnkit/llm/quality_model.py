"""Quality scores of documents from statistics of their texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.boosted_trees import Forest, fit_forest
from churnkit.llm.frames import text_or_empty
from churnkit.llm.words import Lane, Texts, range_sums, text_groups

TRAINING_ROWS = 20_000

# Statistics, in the order in which ``statistics`` returns them.
STATISTICS = """
log_bytes log_words word_bytes upper digits symbols marks exclaims bars beyond_ascii breaks
short_words long_words upper_words distinct_words repeated_windows repeated_lines line_words
""".split()

_LANE = Lane(71)
_CLASSES = {
    "upper": range(65, 91),
    "digits": range(48, 58),
    "symbols": b"#*$%&<>@^~=+{}[]\\",
    "marks": b".,;:?'\"-()/",
    "exclaims": b"!",
    "bars": b"|",
    "beyond_ascii": range(128, 256),
    "breaks": b"\n",
}
_CLASS_OF = np.zeros((len(_CLASSES), 256), np.int32)
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[_i, list(_members)] = 1


def _repeats(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """How many values of each text are equal to another one before them."""
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    again = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
    return np.bincount(t[1:][again], minlength=texts)


def statistics(texts: Texts) -> np.ndarray:
    """One row of STATISTICS per text; an empty text has zeros."""
    n = len(texts.offsets) - 1
    size = np.diff(texts.offsets)
    words = texts.n_words
    share = lambda part, whole: part / np.maximum(whole, 1)
    low, high = texts.offsets[:-1], texts.offsets[1:]
    by_class = [range_sums(table[texts.data], low, high) for table in _CLASS_OF]
    lengths = texts.ends - texts.starts
    of = np.repeat(np.arange(n), words)
    uppers = range_sums(_CLASS_OF[0][texts.data], texts.starts, texts.ends)
    count = lambda chosen: np.bincount(of[chosen], minlength=n)
    windows, at = texts.window_hashes(_LANE, 3)
    # Lines end at a break or with their text; a break belongs to no line.
    is_break = np.append(texts.data == 10, False)
    ends = np.union1d(np.flatnonzero(is_break), high[size > 0])
    starts = np.concatenate([[0], ends[:-1] + is_break[ends[:-1]]]).astype(np.int64)[: len(ends)]
    powers, back = _LANE.powers(_LANE.byte_base, len(texts.data) + 1)
    lines = range_sums(_LANE.byte_values[texts.data] * powers[: len(texts.data)], starts, ends) * back[starts]
    long_line = ends - starts > 1
    line_of = np.searchsorted(texts.offsets, starts, "right") - 1
    columns = [
        np.log1p(size),
        np.log1p(words),
        share(np.bincount(of, lengths, n), words),
        *(share(c, size) for c in by_class),
        share(count(lengths <= 3), words),
        share(count(lengths > 15), words),
        share(count(uppers * 2 > lengths), words),
        1 - share(_repeats(texts.word_hashes(_LANE), of, n), words),
        share(_repeats(windows, of[at], n), words),
        share(_repeats(lines[long_line], line_of[long_line], n), np.bincount(line_of[long_line], minlength=n)),
        share(words, by_class[-1] + 1),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


def in_held_out_fold(id_col: str) -> Column:
    """Whether crc32 of the id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    rows: int = TRAINING_ROWS,
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled rows outside the held-out fold, chosen by a hash of the id.

    Labels other than 0 and 1 and labels without an id are left out; a document that has several labels is there once for each. Null
    texts count as empty. Empty tables give arrays without rows.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~in_held_out_fold(id_col))
    chosen = (
        usable.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(rows)
    )
    # At most ``rows`` rows are broadcast.
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).cast("binary").alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in text_groups(batch.column(2)):
                found = statistics(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[group.rows.start : group.rows.stop],
                        batch.column(1)[group.rows.start : group.rows.stop],
                        pa.array(list(found), pa.list_(pa.float64())),
                    ],
                    ["_id", "_label", "x"],
                )

    found = joined.mapInArrow(measure, "_id long, _label int, x array<double>").orderBy("_id", "_label").collect()
    x = np.array([r["x"] for r in found], np.float64).reshape(-1, len(STATISTICS))
    return x, np.array([r["_label"] for r in found], np.float64)


def train(docs: DataFrame, labels: DataFrame, **columns) -> Forest:
    """Fit a forest; the rows collected for it are bounded by TRAINING_ROWS."""
    return fit_forest(*training_sample(docs, labels, **columns))


def score(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per input row: id, held_out, score, predicted (1 at ``threshold`` or more).

    Null texts count as empty and are scored like any other. Rows without an id are scored and not held out. Rows
    that repeat an id are scored one by one. Only id and text are read. An empty table gives an empty one.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), in_held_out_fold(id_col).alias("held_out"), text_or_empty(text_col).cast("binary").alias("_text")
    )
    kind = dict(rows.dtypes)["_id"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in text_groups(batch.column(2)):
                found = forest.scores(statistics(group))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[group.rows.start : group.rows.stop],
                        batch.column(1)[group.rows.start : group.rows.stop],
                        pa.array(found),
                        pa.array((found >= threshold).astype(np.int32)),
                    ],
                    [id_col, "held_out", "score", "predicted"],
                )

    return rows.mapInArrow(judge, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, forest: Forest, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns, without a shuffle.

    Null texts count as empty when they are scored and stay null. Rows may repeat or lack ids. An empty table gives an empty one.
    """
    # The text is last and appears once; the other columns pass through as they are.
    names = [c for c in docs.columns if c != text_col] + [text_col]
    columns = [F.col(f"`{c}`") for c in names]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1).cast(pa.large_binary()).fill_null(b"")
            for group in text_groups(text):
                good = pa.array(forest.scores(statistics(group)) >= threshold)
                yield batch.slice(group.rows.start, group.rows.stop - group.rows.start).filter(good)

    rows = docs.select(*columns)
    return rows.mapInArrow(judge, rows.schema).select(*[F.col(f"`{c}`") for c in docs.columns])
