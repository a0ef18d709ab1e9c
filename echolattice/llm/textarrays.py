"""Whole batches of texts as NumPy arrays: words and their fingerprints, spans and their fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
_RANDOM = np.random.default_rng(20240229)
#: A random number for each byte, and an odd base with its inverse modulo 2^64.
BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15 | 5
INVERSE = pow(BASE, -1, 2**64)
#: Space, and the control characters 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept and extended as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16) * 5 // 4, U(base), dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread every bit over all 64."""
    x = x ^ U(salt)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Spans:
    """Fingerprints of any spans of a sequence of units, from one running sum."""

    def __init__(self, units: np.ndarray):
        self.sums = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(units * powers(BASE, len(units)), out=self.sums[1:])
        self.inverse = powers(INVERSE, len(units) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def all_of(self, length: int) -> np.ndarray:
        """Of the spans of one length at every place."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.inverse[:n] if n > 0 else np.zeros(0, dtype=np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts, with the end of the last."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text."""
    inside = ~space[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


#: Longer words are hashed one by one.
_LONG_WORD = 64
_BYTES_OF = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def word_units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word: eight bytes at a time go through :func:`mix`, so words of up to eight bytes never share one."""
    size = ends - starts
    units = mix(size.astype(np.uint64), 11)
    if not len(size):
        return units
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live = np.flatnonzero(size <= _LONG_WORD)
    at = 0
    while len(live):
        part = eight[starts[live] + at] & _BYTES_OF[np.minimum(size[live] - at, 8)]
        units[live] = mix(units[live] ^ part, 12)
        at += 8
        live = live[size[live] > at]
    for k in np.flatnonzero(size > _LONG_WORD):
        units[k] ^= U(xxhash.xxh64_intdigest(data[starts[k] : ends[k]], seed=13))
    return units


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size :])


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
