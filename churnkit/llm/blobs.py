"""Arrays that travel between tasks as one binary value per bucket instead of one row per item."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS_PER_TASK = 3


def pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps([np.ascontiguousarray(a) for a in arrays], protocol=5)


def unpack(blob: bytes) -> list[np.ndarray]:
    return pickle.loads(blob)


def joined(blobs: Iterable[bytes]) -> list[np.ndarray]:
    """The arrays of several blobs, each joined with its like."""
    return [np.concatenate(part) for part in zip(*map(unpack, blobs), strict=True)]


def dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every bucket that occurs, with the indexes of its items in their order."""
    if len(bucket):
        order = np.argsort(bucket, kind="stable")
        sorted_ = bucket[order]
        cuts = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
        for part in np.split(order, cuts):
            yield int(bucket[part[0]]), part


def batch(schema: dict[str, pa.DataType], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, schema.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(schema))


BLOB = {"bucket": pa.int64(), "blob": pa.binary()}
BLOB_DDL = "bucket long, blob binary"


def blob_rows(pairs: Iterable[tuple[int, bytes]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of (bucket, blob), each of about ``most`` bytes."""
    buckets, held, size = [], [], 0
    for bucket, blob in pairs:
        buckets.append(bucket)
        held.append(blob)
        size += len(blob)
        if size >= most:
            yield batch(BLOB, buckets, held)
            buckets, held, size = [], [], 0
    if held:
        yield batch(BLOB, buckets, held)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blobs by bucket, from rows sorted by bucket; one bucket is held at a time."""
    now, held = None, []
    for rows in batches:
        for bucket, blob in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
            if held and bucket != now:
                yield now, held
                held = []
            now = bucket
            held.append(blob.as_py())
    if held:
        yield now, held


def exchanged(blobs: DataFrame, tasks: int) -> DataFrame:
    """All blobs of a bucket in one task, in a row; buckets are dealt to tasks by number, equally many to each."""
    return blobs.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("bucket")
