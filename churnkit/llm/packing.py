"""Packing of token pieces into sequences by bounded-space online best-fit.

Each task keeps a fixed number of open sequences in a bitset over free space: bit f is set while some
open sequence has f places left. A piece goes where the least space is left that holds it. If none does, a new
sequence opens; at the limit the fullest one closes first. What is open at the end of a task is packed
once more, together with the rest of other tasks, longest pieces first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.frames import text_or_empty
from churnkit.llm.word_tokens import word_tokens
from churnkit.scratch import materialize

_PIECE = "`{id}` long, piece int, start long, length long, ids_crc32 long"
_ROUND = 1 << 62  # sequence numbers of the second round lie above
_PART = 1 << 31
# Left-over pieces that one task of the second round packs.
_PIECES_TOGETHER = 20_000


class OpenSequences:
    """Best fit over at most ``most`` open sequences of ``size`` places."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.by_free: dict[int, list[int]] = {}
        self.bits = 0  # bit f: there is an open sequence with f free places
        self.n_open = self.opened = 0

    def _take(self, free: int) -> int:
        group = self.by_free[free]
        sequence = group.pop()
        if not group:
            self.bits &= ~(1 << free)
        return sequence

    def place(self, length: int) -> tuple[int, int, int | None]:
        """Sequence and offset of a piece of 1 to ``size`` ids, and the sequence that closed for it, if any."""
        fitting = self.bits >> length
        closed = None
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.n_open == self.most:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
                self.n_open -= 1
            free, sequence = self.size, self.opened
            self.opened += 1
            self.n_open += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(sequence)
            self.bits |= 1 << left
        else:
            self.n_open -= 1
        return sequence, self.size - free, closed


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    size: int = 2048,
    most_open: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for).

    A document is its ids and then ``end_id``, so null and empty texts are one id long. Only documents
    longer than ``size`` are cut, every ``size`` ids. Rows without an id or with a repeated one are packed like others. Other
    columns are not read. An empty table gives an empty one. ``ids`` are packed little-endian integers.
    """
    schema = _PIECE.format(id=id_col) + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"

    def finish(rows: list[tuple], sequences: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(5 + with_ids)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays.append(pa.array(sequences, pa.int64(), mask=~known))
        arrays.append(pa.array(offsets, pa.int64(), mask=~known))
        names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids + ["sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(arrays, names)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer_path)
        end = np.array([end_id], words.kind).tobytes()
        bins = OpenSequences(size, most_open)
        waiting: dict[int, list[tuple]] = {}  # pieces of sequences that are open
        base = TaskContext.get().partitionId() * _PART
        done: list[tuple] = []
        ready: list[tuple[int, int]] = []

        def emit() -> pa.RecordBatch:
            marks = np.array(ready, np.int64).reshape(-1, 2)
            batch = finish(done, marks[:, 0] + base, marks[:, 1], np.ones(len(ready), bool))
            done.clear()
            ready.clear()
            return batch

        def close(sequence: int) -> None:
            for offset, row in waiting.pop(sequence):
                done.append(row)
                ready.append((sequence, offset))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = words.ids(text.as_buffer().to_pybytes()) + end
                ids = np.frombuffer(packed, words.kind)
                for piece, low in enumerate(range(0, len(ids), size)):
                    part = ids[low : low + size]
                    row = (doc, piece, low, len(part), zlib.crc32(part.astype("<u4")))
                    if with_ids:
                        row += (part.tobytes(),)
                    sequence, offset, closed = bins.place(len(part))
                    if closed is not None:
                        close(closed)
                    waiting.setdefault(sequence, []).append((offset, row))
                    if offset + len(part) == size:
                        close(sequence)
                if len(done) >= 5000:
                    yield emit()
        yield emit()
        rest = [row for pieces in waiting.values() for _, row in pieces]
        none = np.zeros(len(rest), np.int64)
        yield finish(rest, none, none, np.zeros(len(rest), bool))

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenSequences(size, 64 * most_open)
        base = _ROUND + TaskContext.get().partitionId() * _PART
        for batch in batches:
            placed = [bins.place(n)[:2] for n in batch.column("length").to_pylist()]
            both = np.array(placed, np.int64).reshape(-1, 2)
            out = batch.set_column(batch.num_columns - 2, "sequence_id", pa.array(both[:, 0] + base))
            yield out.set_column(batch.num_columns - 1, "offset", pa.array(both[:, 1]))

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).cast("binary").alias("_text"))
    first = materialize(rows.mapInArrow(first_round, schema), "packed")
    rest = first.where("sequence_id is null")
    tasks = 1 + rest.count() // _PIECES_TOGETHER
    again = (
        rest.repartition(tasks)
        .sortWithinPartitions(F.desc("length"), id_col, "piece", "ids_crc32")
        .mapInArrow(second_round, schema)
    )
    return first.where("sequence_id is not null").unionAll(again)
