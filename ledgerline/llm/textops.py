"""Vectorised byte and word hashing for the operators that run numpy in tasks.

Hashes are polynomials over unsigned 64-bit numbers: with prefix sums of
``value * BASE**i`` the hash of any stretch is one subtraction and one
multiplication, so all words, shingles or windows of a block of texts are
hashed at once. Blocks are cut by size, so memory does not grow with a batch.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_rng = np.random.default_rng(20240607)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK_BYTES = 1 << 20

_powers: dict[str, np.ndarray] = {}


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, which at the end of a partition gives freed memory back to the
    system: Python workers stay, idle, beside those of the next stage."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            pa.default_memory_pool().release_unused()
            libc = ctypes.util.find_library("c")
            trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
            if trim is not None:
                trim(0)
    return wrapped


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of a polynomial hash over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Prefix:
    """Prefix sums over ``values``; ``span(a, b)`` hashes values[a:b]."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=self.sums[1:])

    def span(self, a, b) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """(first row, offsets, bytes) of blocks of whole texts of about ``limit``
    bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return
    offs = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offs, offs[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, offs[first:last + 1] - offs[first], data[offs[first]:offs[last]]
        first = last


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the word offsets of the texts."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool):
    """A 64-bit hash per word, the word offsets of the texts, word starts and ends."""
    starts, stops, woffs = word_bounds(data, offs)
    prefix = Prefix(BYTE_VALUES[LOWER[data] if lower else data])
    return mix(prefix.span(starts, stops) + (stops - starts).astype(np.uint64)), woffs, starts, stops
