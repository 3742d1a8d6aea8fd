"""Words of whole texts as arrays: byte spans and 64-bit hashes for a batch of documents at once.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D. Hashes route and count; where a result must not
depend on them, operators compare the words themselves.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: The white space between words, as the body of a regular-expression class.
SPACES = r"\x20\x09-\x0D"
#: Bytes handled at once; the arrays of one step take about forty times as much.
SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the base and of its inverse modulo 2^64, kept between calls."""
    global _powers, _inverse
    if len(_powers) < n:
        steps = np.full(2 * n, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        _inverse = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n], _inverse[:n]


class Words(NamedTuple):
    """Words of the documents ``first`` to ``first + len(bounds) - 2`` of a batch."""

    first: int
    data: np.ndarray    # the bytes of these documents
    starts: np.ndarray  # of each word, in data
    ends: np.ndarray
    bounds: np.ndarray  # document i has the words bounds[i] to bounds[i + 1] - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        power, inverse = _powers_to(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_LETTER[self.data] * power[:-1], out=sums[1:])
        return _mixed((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def text(self, i: int) -> list[bytes]:
        """The words of document i of the slice."""
        a, b = self.bounds[i], self.bounds[i + 1]
        if a == b:
            return []
        return self.data[self.starts[a]:self.ends[b - 1]].tobytes().split()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``most`` bytes; a longer document is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words_of(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a string column, slice by slice."""
    everything, offsets = utf8(column)
    for i, j in slices(offsets, most):
        data = everything[offsets[i]:offsets[j]]
        cuts = offsets[i:j + 1] - offsets[i]
        inner = np.zeros(len(data) + 2, dtype=bool)
        inner[1:-1] = ~_IS_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[cuts] = True
        starts = np.flatnonzero(inner[1:] & (~inner[:-1] | edge))
        ends = np.flatnonzero(inner[:-1] & (~inner[1:] | edge))
        yield Words(i, data, starts, ends, np.searchsorted(starts, cuts))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words; the last n - 1 positions have none."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15 | 1) + hashes[k:len(hashes) - n + 1 + k]
    return _mixed(out)
