"""Words, word hashes and shingles of whole text columns, in numpy over Arrow buffers.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Hashes are 64 bit and the same on every machine. A null text
counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = b" \t\n\v\f\r"
CHUNK_BYTES = 1 << 18

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACE)] = False
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTE_LOWER = _BYTE[_LOWER]


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and each row's start with the end as last entry."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not (wide or pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column, wide = column.cast(pa.string()), False
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), starts


class Words:
    """The words of the rows of one chunk.

    ``hashes``, ``starts`` and ``ends`` (byte offsets into ``data``) have one entry per
    word; row ``i`` owns the words ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, hashed: bool = True) -> None:
        first = int(offsets[0])
        self.data = data[first : int(offsets[-1])]
        rows = offsets - first
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = _IS_WORD[self.data]
        begins = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        cut = rows[(rows > 0) & (rows < len(self.data))]
        begins[cut] |= inside[cut + 1]
        stops[cut - 1] |= inside[cut]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.bounds = np.searchsorted(self.starts, rows)
        if hashed:
            sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.data] * powers(_BASE, len(self.data)), out=sums[1:])
            shift = powers(_BASE_INVERSE, len(self.data) + 1)
            self.hashes = mix((sums[self.ends] - sums[self.starts]) * shift[self.starts])

    def of(self, row: int) -> np.ndarray:
        return self.hashes[self.bounds[row] : self.bounds[row + 1]]


def chunks(column: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Rows ``first`` to ``last`` (exclusive) with their words, about ``size`` bytes at a time."""
    data, offsets = text_buffer(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last, Words(data, offsets[first : last + 1], lower)
        first = last


def shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    length = min(length, len(words))
    out = np.zeros(len(words) - length + 1, np.uint64)
    for k in range(length):
        out = out * np.uint64(0x9DDFEA08EB382D69) + words[k : k + len(out)]
        out ^= out >> np.uint64(29)
    return mix(out + np.uint64(length))


def shingle_set(words: np.ndarray, length: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingles(words, length))


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as empty."""
    return [x or "" for x in column.to_pylist()]
