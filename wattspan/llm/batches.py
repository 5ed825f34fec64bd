"""Texts of an Arrow batch as one byte array, cut into slices of bounded size, and what is counted on it.

Everything here works on whole slices with numpy: separators, words, lines and
their 64-bit hashes. Null texts are empty texts.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

# The separators of words, space and tab to carriage return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table_of(chars: bytes) -> np.ndarray:
    """Truth value per byte."""
    found = np.zeros(256, dtype=bool)
    found[list(chars)] = True
    return found


IS_SPACE = table_of(SPACES)


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; other bytes stay."""
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column, without a copy where there are no nulls."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[off[0]:off[-1]], off - off[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [lo, hi) with their bytes and offsets; a slice over ``size`` bytes holds one text."""
    data, off = text_buffer(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Powers:
    """Powers of the hash base and of its inverse, as long as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(0, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _BASE)]))
            self.down = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, inverse)]))
        return self.up[:n], self.down[:n]


POWERS = Powers()
# Emptied by ``release``: what a worker keeps from one task to the next.
HELD: list[dict] = []
_MOST_POWERS = 1 << 22


def release() -> None:
    """Frees what earlier tasks left in this worker and the coming one does not need."""
    if any(HELD) or len(POWERS.up) > _MOST_POWERS:
        for kept in HELD:
            kept.clear()
        POWERS.__init__()
        gc.collect()
    pa.default_memory_pool().release_unused()


class Prefix:
    """Polynomial prefix sums modulo 2^64: the hash of any substring in a few steps."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, self.down = POWERS.get(n + 1)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * up[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


_PLACES = 64
_BYTE_AT = mix(np.arange(1, _PLACES * 256 + 1, dtype=_U) * _BASE)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits per word: the sum of one fixed random number for each byte at its place in the word.

    A rolling polynomial gives some pairs of long words (a to ab, b to ba, repeated) one hash in any base; this does not.
    """
    length = ends - starts
    place = ragged(np.zeros(len(starts), np.int64), length)
    chars = data[ragged(starts, length)]
    far = place >= _PLACES
    values = _BYTE_AT[(place & (_PLACES - 1)) * 256 + chars]
    if far.any():
        values[far] = mix(values[far] + place[far].astype(_U) * _U(0xD6E8FEB86659FD93))
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values, out=total[1:])
    at = np.cumsum(length)
    return mix(total[at] - total[at - length])


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; no run crosses a text's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = off[:-1][off[:-1] < off[1:]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = off[1:][off[:-1] < off[1:]] - 1
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def bounds(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Index of the first run of each text, and the number of runs at the end."""
    return np.searchsorted(starts, off, side="left")


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` per text, where text i has [first[i], first[i + 1])."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
