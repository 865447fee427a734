"""Whole columns of texts as flat byte arrays, for vectorised work inside Spark tasks.

Arrow hands a task its texts as one byte buffer with offsets. The operators
work on slices of whole documents of a bounded number of bytes (one very long
document is a slice of its own), so a task's memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# An odd multiplier of the polynomial hash modulo 2^64, and its inverse.
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs, raw


def slices(column, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, offsets from 0, bytes)`` of runs of whole documents."""
    offs, raw = flat(column)
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, offs[i:j + 1] - offs[i], raw[offs[i]:offs[j]]
        i = j


class RollingHash:
    """64-bit hashes of any byte ranges of a slice, by prefix sums of a polynomial mod 2^64."""

    def __init__(self):
        self._pow = np.ones(1, np.uint64)
        self._inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._pow) >= n:
            return
        n = max(n, 2 * len(self._pow))
        with np.errstate(over="ignore"):
            base = np.full(n, _P, np.uint64)
            base[0] = 1
            self._pow = np.multiply.accumulate(base)
            base[1:] = _P_INV
            self._inv = np.multiply.accumulate(base)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums, one longer than ``data``."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._pow[:len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The mixed hash of each range ``[start, end)``, its length included."""
        with np.errstate(over="ignore"):
            h = (prefix[ends] - prefix[starts]) * self._inv[starts]
            return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``[start, start + length)``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
