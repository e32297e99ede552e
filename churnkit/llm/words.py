"""Words and rolling fingerprints of whole batches of texts, in numpy.

A word is a run of bytes other than space and the five ASCII controls 0x09-0x0D; none of these bytes
occurs inside a longer UTF-8 character, so texts are cut as bytes. Fingerprints are polynomials modulo
2**64 over random byte values, mixed afterwards; two independent lanes give 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK_BYTES = 1 << 20


class Lane:
    """One 64-bit polynomial fingerprint: byte values, a base for bytes and one for words."""

    def __init__(self, seed: int, fold_case: bool = False):
        rng = np.random.default_rng(seed)
        self.byte_values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold_case:
            self.byte_values[65:91] = self.byte_values[97:123]
        self.byte_base = int(rng.integers(1 << 62, dtype=np.int64)) * 8 + 5
        self.word_base = int(rng.integers(1 << 62, dtype=np.int64)) * 8 + 3
        self._powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n powers of the base and of its inverse modulo 2**64."""
        have = self._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(n, CHUNK_BYTES)
            have = tuple(_powers(b, size) for b in (base, pow(base, -1, 1 << 64)))
            if size <= 4 * CHUNK_BYTES:  # tables for a giant text aren't kept
                self._powers[base] = have
        return have[0][:n], have[1][:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end], modulo 2**64."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


class Texts:
    """Adjacent texts of a batch: their bytes, and the words in them."""

    def __init__(self, rows: slice, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets
        inner = ~SPACE[data]
        before, after = np.empty_like(inner), np.empty_like(inner)
        if len(data):
            before[0] = after[-1] = False
            before[1:], after[:-1] = inner[:-1], inner[1:]
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            before[edges] = False
            after[edges - 1] = False
        self.starts = np.flatnonzero(inner & ~before)
        self.ends = np.flatnonzero(inner & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each text, and the end
        self.n_words = np.diff(self.first)

    def word_hashes(self, lane: Lane) -> np.ndarray:
        forward, back = lane.powers(lane.byte_base, len(self.data))
        sums = range_sums(lane.byte_values[self.data] * forward, self.starts, self.ends)
        return mix(sums * back[self.starts])

    def window_hashes(self, lane: Lane, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all runs of ``size`` words inside one text, and each one's first word."""
        words = self.word_hashes(lane)
        at = self.window_starts(size)
        forward, back = lane.powers(lane.word_base, len(words))
        return mix(range_sums(words * forward, at, at + size) * back[at]), at

    def window_starts(self, size: int) -> np.ndarray:
        n = np.maximum(self.n_words - size + 1, 0)
        return spans(self.first[:-1], n)

    def span_hashes(self, lane: Lane) -> np.ndarray:
        """Fingerprint of the whole word sequence of each text."""
        words = self.word_hashes(lane)
        forward, back = lane.powers(lane.word_base, len(words) + 1)
        sums = range_sums(words * forward[:-1], self.first[:-1], self.first[1:])
        return mix(sums * back[self.first[:-1]] + self.n_words.astype(np.uint64))


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, .. (counts[0] of them), then those of the next."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)


def text_groups(column: pa.Array, budget: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Cut a binary column into runs of rows of about ``budget`` bytes; a longer text is one run."""
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
        yield Texts(slice(low, high), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high
