"""Byte-level BPE by rank files, with chunks of long texts pre-tokenised in parallel.

A text is cut by a pattern into pre-tokens and each piece is merged by ranks. Long texts are first cut
into chunks that overlap. A chunk's first pre-tokens may be cut wrongly, but the pattern looks only
ahead: once its boundaries meet those of the chunk before, both agree from there on. The chunks are
stitched at the first such boundary. Where a pre-token is longer than the overlap, the open end and the chunks up to
one that holds a boundary are cut again as one text, once.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.frames import shuffle_width, text_or_empty

CHUNK = 1 << 15
OVERLAP = 1 << 9


class RankBpe(dict):
    """Maps a pre-token to its packed ids; keeps up to ``limit`` of them, then starts anew."""

    def __init__(self, path: str, pattern: str, limit: int = 300_000):
        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(pattern).findall
        self.limit = limit
        most = max(ranks.values())
        self.kind = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.bytes_of: list[bytes] = [b""] * (most + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        packed = np.array(self.bpe.encode_ordinary(piece), self.kind).tobytes()
        if len(piece) <= 64:
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.cut(text)))

    def decode(self, packed: bytes) -> bytes:
        """The raw bytes of the ids, one after another."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, self.kind).tolist()))


@functools.lru_cache(2)
def rank_bpe(path: str, pattern: str) -> RankBpe:
    """One table per worker and file."""
    return RankBpe(path, pattern)


class Encoded(NamedTuple):
    """A stretch of text from ``start``: the lengths of its pre-tokens, their numbers of ids, and the ids."""

    start: int
    lengths: np.ndarray
    counts: np.ndarray
    ids: bytes

    def bounds(self) -> np.ndarray:
        return self.start + np.concatenate([[0], np.cumsum(self.lengths)])

    def between(self, low: int, high: int, width: int) -> bytes:
        """Ids of the pre-tokens between two boundaries."""
        bounds = self.bounds()
        before = np.concatenate([[0], np.cumsum(self.counts)])
        first, last = before[np.searchsorted(bounds, [low, high])]
        return self.ids[width * first : width * last]


def encode_stretch(bpe: RankBpe, text: str, start: int = 0) -> Encoded:
    pieces = bpe.cut(text)
    packed = [bpe[p] for p in pieces]
    width = bpe.kind.itemsize
    return Encoded(
        start,
        np.array([len(p) for p in pieces], np.int64),
        np.array([len(p) // width for p in packed], np.int64),
        b"".join(packed),
    )


def stitch(bpe: RankBpe, chunks: Iterator[Encoded]) -> bytes:
    """Ids of the text that overlapping chunks cover."""
    width = bpe.kind.itemsize
    chunks = iter(chunks)
    here, at, out = next(chunks), 0, []
    raw: list[str] = []  # text from ``at`` on, where its pre-tokens aren't known
    covered = 0
    for after in chunks:
        if not raw:
            bounds = here.bounds()
            end = covered = int(bounds[-1])
            # A pre-token that ends with its chunk may go on in the text.
            known = bounds[(bounds >= at) & (bounds < end)]
            meeting = np.intersect1d(known[known >= after.start], after.bounds(), assume_unique=True)
            cut = int(meeting[0]) if len(meeting) else int(known[-1])
            out.append(here.between(at, cut, width))
            at = cut
            if len(meeting):
                here = after
                continue
            raw.append(bpe.decode(here.between(cut, end, width)).decode())
        raw.append(bpe.decode(after.ids).decode()[covered - after.start :])
        covered = int(after.bounds()[-1])
        # A chunk that is all one pre-token adds no boundary: it waits for more.
        if len(after.lengths) > 1:
            here, raw = encode_stretch(bpe, "".join(raw), at), []
    if raw:
        here = encode_stretch(bpe, "".join(raw), at)
    out.append(here.between(at, int(here.bounds()[-1]), width))
    return b"".join(out)


def chunks_of(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    for start in range(0, max(len(text), 1), chunk):
        yield start, text[start : start + chunk + overlap]
        if start + chunk + overlap >= len(text):
            return


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per input row: id, n_tokens, ids (packed little-endian unsigned integers, two bytes if ranks allow).

    A null text counts as empty and has no ids. Rows are told apart by themselves, so ids may be missing
    or repeat. Texts longer than ``chunk`` characters are cut and their chunks dealt among all tasks.
    Other columns are not read. An empty table gives an empty one.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"))
    schema = f"`{id_col}` long, n_tokens long, ids binary"

    def answer(ids: list, packed: list[bytes], width: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(p) // width for p in packed], pa.int64()),
                pa.array(packed, pa.binary()),
            ],
            [id_col, "n_tokens", "ids"],
        )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_bpe(ranks_path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                packed = [bpe.encode(t.as_py()) for t in part.column(1)]
                yield answer(part.column(0).to_pylist(), packed, bpe.kind.itemsize)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                for start, piece in chunks_of(text.as_py(), chunk, overlap):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array([row.as_py()], pa.int64()),
                            "doc": pa.array([doc.as_py()], pa.int64()),
                            "start": pa.array([start], pa.int64()),
                            "piece": [piece],
                        }
                    )

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_bpe(ranks_path, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                done = encode_stretch(bpe, one.column("piece")[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(one.column(c) for c in ("row", "doc", "start")),
                        pa.array([done.lengths.astype("<u4").tobytes()], pa.binary()),
                        pa.array([done.counts.astype("<u4").tobytes()], pa.binary()),
                        pa.array([done.ids], pa.binary()),
                    ],
                    ["row", "doc", "start", "lengths", "counts", "ids"],
                )

    def join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_bpe(ranks_path, pattern)
        row, doc, held = None, None, []

        def joined() -> pa.RecordBatch:
            return answer([doc], [stitch(bpe, iter(held))], bpe.kind.itemsize)

        for batch in batches:
            for x in batch.to_pylist():
                if held and x["row"] != row:
                    yield joined()
                    held = []
                row, doc = x["row"], x["doc"]
                sizes = (np.frombuffer(x[c], "<u4").astype(np.int64) for c in ("lengths", "counts"))
                held.append(Encoded(x["start"], *sizes, x["ids"]))
        if held:
            yield joined()

    short = rows.where(F.char_length("_text") <= chunk).mapInArrow(whole, schema)
    width = shuffle_width(docs.sparkSession)
    long = (
        rows.where(F.char_length("_text") > chunk)
        .select(F.monotonically_increasing_id().alias("row"), "_id", "_text")
        .mapInArrow(cut, "row long, doc long, start long, piece string")
        .repartition(width, "row", "start")
        .mapInArrow(encode_chunks, "row long, doc long, start long, lengths binary, counts binary, ids binary")
        .repartition(width, "row")
        .sortWithinPartitions("row", "start")
        .mapInArrow(join_chunks, schema)
    )
    return short.unionAll(long)


def decode_ids(
    encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """One row per input row: id and the decoded bytes; null ids decode to no bytes."""
    schema = f"`{id_col}` long, decoded binary"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_bpe(ranks_path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                plain = [bpe.decode(x.as_py() or b"") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(plain, pa.binary())], [id_col, "decoded"])

    return encoded.select(F.col(id_col).cast("long").alias(id_col), ids_col).mapInArrow(decode, schema)
