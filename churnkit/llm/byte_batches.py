"""Binary columns of Arrow batches as flat byte arrays, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20


def byte_groups(column: pa.Array, budget: int = GROUP_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``budget`` bytes: (rows, bytes, offsets); a longer value is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + budget, "right")) - 1
        high = min(n, max(high, low + 1))
        yield slice(low, high), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The values between ``offsets`` as a binary column, without copying them one by one."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def owners(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The value that each byte place belongs to; values may be empty."""
    return np.searchsorted(offsets, at, "right") - 1


def lead_bytes(data: np.ndarray) -> np.ndarray:
    """Where a code point of UTF-8 begins."""
    return (data & 0xC0) != 0x80
