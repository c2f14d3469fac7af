"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes, anchors.

Everything here is vectorized over a slice of whole texts of at most SLICE
bytes (a longer text is a slice of its own), so a task holds a few slices and
never its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20  # bytes of text worked on at once

_U64 = np.uint64
_FULL = (1 << 64) - 1


def _mix_int(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & _FULL
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _FULL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _FULL
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x + _U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_STEP_BITS = 14
_STEP = 1 << _STEP_BITS


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers up to 2**28 as products of one from each table."""
    low, high = np.full(_STEP, base, dtype=_U64), np.full(_STEP, pow(base, _STEP, 1 << 64), dtype=_U64)
    low[0] = high[0] = 1
    return np.cumprod(low, dtype=_U64), np.cumprod(high, dtype=_U64)


class Rolling:
    """Hashes of any ranges of a sequence, from one running sum.

    A range's hash is the sum of its scrambled items times powers of an odd
    base, modulo 2**64, shifted to the range's begin. `seed` picks the base,
    so that two instances are independent. A sequence has 2**28 items at most.
    """

    def __init__(self, seed: int):
        self.base = _mix_int(seed) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.table = np.array([_mix_int((seed << 8) + b + 1) for b in range(256)], dtype=_U64)
        self.up, self.down = _powers(self.base), _powers(self.inverse)

    @staticmethod
    def _power(table: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
        return table[0][at & (_STEP - 1)] * table[1][at >> _STEP_BITS]

    def sums(self, items: np.ndarray) -> np.ndarray:
        """Running sums of bytes (through the table) or of 64-bit hashes."""
        n = len(items)
        values = self.table[items] if items.dtype == np.uint8 else items
        high = self.up[1][:-(-n // _STEP)]
        power = (high[:, None] * self.up[0]).reshape(-1)[:n]
        out = np.zeros(n + 1, dtype=_U64)
        np.cumsum(values * power, out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * self._power(self.down, begin) + (end - begin).astype(_U64))


FIRST, SECOND = Rolling(1), Rolling(2)

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not glibc
    _trim = None


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.cast(column, pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last
    give_back()


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of member bytes; runs end with their text."""
    inside = member[data] if len(data) else np.empty(0, bool)
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, rolling: Rolling = FIRST) -> np.ndarray:
    return rolling.ranges(rolling.sums(data), begin, end)


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    total = int(length.sum())
    skip = np.cumsum(length) - length
    return np.repeat(begin - skip, length) + np.arange(total)


_PLACE = 30  # low bits of a sampling key that hold the position


def anchors(items: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Content-chosen positions such that equal windows have equal ones.

    `bounds` are the texts' begins in `items` (bytes or word hashes) and the
    last end. Of each window's grams the one with the least hash, the first
    of several, is its anchor. Returns anchor, first and last window of each
    run of windows with one anchor, and the text's number. A text shorter than
    a window has none.
    """
    sums = FIRST.sums(items)
    n = len(items) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4
    width = window - gram + 1
    starts = np.arange(len(items) - gram + 1)
    low = (FIRST.ranges(sums, starts, starts + gram) >> _U64(_PLACE) << _U64(_PLACE)) | starts.astype(_U64)
    step, least = 1, low
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        rest = width - step
        least = np.minimum(least[:-rest], least[rest:])
    chosen = (least[:n] & _U64((1 << _PLACE) - 1)).astype(np.int64)
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    at = spread(bounds[:-1], counts)  # the windows that lie in one text
    if not len(at):
        return (np.empty(0, np.int64),) * 4
    text = np.repeat(np.arange(len(counts)), counts)
    chosen = chosen[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    return chosen[begin], at[begin], at[end], text[begin]


def covered(length: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of `length` positions lie in one of the ranges."""
    change = np.zeros(length + 1, dtype=np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0
