"""Token ids as flat binary files with 64-bit document offsets, read back through memory maps.

Documents are range-partitioned by id, and each task writes one part: ``.ids`` (unsigned integers, two bytes if the
vocabulary allows), ``.offsets`` (64-bit, one more than there are documents, from 0) and ``.docs`` (their ids).
The manifest has a row per part; prefix sums over it give each part the number of ids before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm import shared_files
from churnkit.llm.frames import text_or_empty
from churnkit.llm.word_tokens import word_tokens
from churnkit.scratch import materialize, new_path

# Written in place of a missing document id.
NO_ID = -(1 << 63)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents in ascending id order; the manifest: part, path, n_docs, n_ids, id_bytes, base.

    Every document ends with ``end_id``; null and empty texts consist of it alone. Documents without an id come first.
    Rows that repeat an id follow each other in no stated order. Other columns are not read. An
    empty table gives an empty manifest and no files. ``folder`` is a new folder below the shared
    scratch folder unless named.
    """
    folder = folder or new_path(docs.sparkSession, "tokens")
    shared_files.make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        words = word_tokens(tokenizer_path)
        path = shared_files.own_name(folder, f"part-{TaskContext.get().partitionId():06d}", "")
        end = np.array([end_id], words.kind).tobytes()
        lengths, ids = [0], []
        with shared_files.writer(path + ".ids") as out:
            for batch in (b for part in ([first], batches) for b in part):
                ids += [NO_ID if i is None else i for i in batch.column(0).to_pylist()]
                for text in batch.column(1):
                    packed = words.ids(text.as_buffer().to_pybytes())
                    out.write(packed + end)
                    lengths.append(len(packed) // words.kind.itemsize + 1)
        offsets = np.cumsum(np.array(lengths, "<i8"))
        for suffix, values in ((".offsets", offsets), (".docs", np.array(ids, "<i8"))):
            with shared_files.writer(path + suffix) as out:
                out.write(values.tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "path": [path],
                "n_docs": pa.array([len(ids)], pa.int64()),
                "n_ids": pa.array([int(offsets[-1])], pa.int64()),
                "id_bytes": pa.array([words.kind.itemsize], pa.int32()),
            }
        )

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).cast("binary").alias("_text"))
    # The row number splits rows that repeat an id among parts.
    ordered = (
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange("_id", "_row")
        .sortWithinPartitions("_id", "_row")
        .select("_id", "_text")
    )
    parts = materialize(
        ordered.mapInArrow(write, "part int, path string, n_docs long, n_ids long, id_bytes int"), "manifest"
    )
    # One row a task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files: id, start (ids before it in all files), n_tokens, ids_crc32, part, path.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (row for batch in batches for row in batch.to_pylist()):
            with (
                shared_files.reader(part["path"] + ".ids") as ids,
                shared_files.reader(part["path"] + ".offsets") as offsets,
                shared_files.reader(part["path"] + ".docs") as docs,
            ):
                width = part["id_bytes"]
                for low in range(0, part["n_docs"], 4096):
                    n = min(4096, part["n_docs"] - low)
                    at = np.frombuffer(offsets.read_at(8 * (n + 1), 8 * low), "<i8")
                    names = np.frombuffer(docs.read_at(8 * n, 8 * low), "<i8")
                    block = ids.read_at(width * int(at[-1] - at[0]), width * int(at[0]))
                    wide = np.frombuffer(block, f"<u{width}").astype("<u4")
                    sums = [zlib.crc32(wide[a:b]) for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            id_col: pa.array(names, mask=names == NO_ID),
                            "start": pa.array(at[:-1] + part["base"]),
                            "n_tokens": pa.array(np.diff(at)),
                            "ids_crc32": pa.array(sums, pa.int64()),
                            "part": pa.array([part["part"]] * n, pa.int32()),
                            "path": [part["path"]] * n,
                        }
                    )

    return manifest.repartition("part").mapInArrow(
        read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long, part int, path string"
    )
