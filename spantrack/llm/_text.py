"""Words of whole Arrow columns of text, as arrays of offsets and hashes.

A word is ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split()`` yields.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at a time; a longer text is handled alone.
SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_TABLE, _OTHER_TABLE = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), dtype=np.uint64) * U(2) + U(1)
_OTHER_BASE = 0xA24BAED4963EE407
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A polynomial hash of values[start:end] for each span, whatever its place."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mix((sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts] + (ends - starts).astype(U))


@dataclass
class Words:
    """Words of some texts: byte offsets, and for each text its first word and the one after its last."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: int
    bounds: np.ndarray

    def hashes(self, other: bool = False) -> np.ndarray:
        """A hash of each word, a stretch of the bytes at a time; ``other`` gives one that is independent of the first."""
        table, base = (_OTHER_TABLE, _OTHER_BASE) if other else (_TABLE, _BASE)
        out, at = np.empty(len(self.starts), U), 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + SLICE_BYTES)))
            begin, end = self.starts[at], self.ends[to - 1]
            out[at:to] = spans_hash(table[self.data[begin:end]], self.starts[at:to] - begin, self.ends[at:to] - begin, base)
            at = to
        return out

    def of(self) -> np.ndarray:
        """The text of each word, counted from 0."""
        return np.repeat(np.arange(len(self.first)), self.last - self.first)


def words_of(column: pa.Array) -> Iterator[Words]:
    """Words of a column of texts, in slices of whole texts; null is an empty text."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield _cut(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def _cut(data: np.ndarray, bounds: np.ndarray, row: int) -> Words:
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    begins = solid[1:] & ~solid[:-1]
    stops = solid[:-1] & ~solid[1:]
    inner = bounds[1:-1]  # a word never runs from one text into the next
    inner = inner[(inner > 0) & (inner < len(data))]
    both = inner[solid[inner] & solid[inner + 1]]
    begins[both] = stops[both] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return Words(data, starts, ends, np.searchsorted(starts, bounds[:-1]), np.searchsorted(starts, bounds[1:]), row, bounds[:-1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i:i+width] for each i where that fits."""
    size, have = 1, x
    while size * 2 <= width:
        have, size = np.minimum(have[:-size], have[size:]), size * 2
    rest = width - size
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have
