"""Words and hashes of many texts at once, in numpy, for use inside Spark tasks.

A batch of texts is one byte buffer with document offsets (as Arrow stores it), so the cost is a few
passes over the bytes and not a Python call per word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

# Bytes looked at together: keeps the eight-byte work arrays small.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were ever needed."""

    up = _powers(_BASE, 1 << 16)
    down = _powers(_INVERSE, 1 << 16)

    @classmethod
    def need(cls, n: int) -> None:
        if len(cls.up) < n:
            n += n // 4
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RollingHash:
    """64-bit hashes of any byte ranges of a buffer after one pass over it. ``which`` (0 or 1) picks the function."""

    def __init__(self, buffer: np.ndarray, which: int = 0):
        _Powers.need(len(buffer) + 1)
        # in place: eight bytes per byte of text are the most that is held
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        part = self.sums[1:]
        np.take(_BYTE[which], buffer, out=part)
        part *= _Powers.down[: len(buffer)]
        np.cumsum(part, out=part)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * _Powers.up[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes each; a longer document is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def words(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words (maximal runs without the six ASCII spaces)."""
    if not len(buffer):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[buffer]
    before = np.empty(len(buffer), bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(buffer), bool)
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(buffer))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def window_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive numbers."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = np.uint64(0x9FB21C651E98DF25)
    for i in range(size):
        out *= factor
        out += hashes[i: i + n]
    return mix(out)
