"""64-bit hashes of words and byte strings over flat numpy arrays.

A hash of the bytes [s, e) is the difference of two prefix sums of ``code(byte) * BASE**i``, moved
back to position 0 and mixed, so any substring costs the same few operations.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A flat array holds about this many bytes, or one longer document.
FLAT_BYTES = 1 << 21
#: Texts of about so many bytes are objects of a task at once, or one longer text.
SLICE_BYTES = 1 << 22

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1), modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, FLAT_BYTES + 4096), base, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if n <= 4 * FLAT_BYTES:
            _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finish of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class FlatHash:
    """Hashes of substrings of one flat byte array."""

    def __init__(self, flat: np.ndarray) -> None:
        self.sums = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum(CODES[flat] * powers(BASE, len(flat)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = powers(UNBASE, len(self.sums))
        return mixed((self.sums[ends] - self.sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    def of_length(self, k: int) -> np.ndarray:
        """Of every substring of ``k`` bytes, by start."""
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * powers(UNBASE, n) + np.uint64(k))


def word_bounds(flat: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that break no word; without ``breaks``, white space does."""
    inside = np.zeros(len(flat) + 2, dtype=bool)
    inside[1:-1] = ~breaks[flat]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words, a bounded stretch of bytes at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + 2 * FLAT_BYTES, side="right")))
        base = starts[i]
        out[i:j] = FlatHash(flat[base : ends[j - 1]]).of(starts[i:j] - base, ends[i:j] - base)
        i = j
    return out


def give_back() -> None:
    """Returns memory that a task no longer uses to the system, where the C library can: Spark keeps its Python workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose ``column`` has about ``limit`` bytes, or one row; Spark cuts them by rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // limit, prepend=-1)).tolist()
        for i, j in zip(starts, [*starts[1:], len(sizes)]):
            yield batch.slice(i, j - i)
    give_back()


def packs(texts: list[bytes], limit: int = FLAT_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of documents whose bytes fit one flat array."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) + 1 > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
