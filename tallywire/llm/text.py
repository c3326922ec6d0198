"""Words of whole texts as numpy arrays, for code that runs inside tasks.

A batch's texts are one byte array and its row borders; words are ranges of it. Nothing
here makes a Python object per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What separates words. SPACES are ASCII white space; PLAIN words are
# runs of ASCII letters, digits and all non-ASCII bytes.
SPACES = bytes([*range(0x09, 0x0E), 0x20])
NOT_PLAIN = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Arrays over a slab's bytes take some 40 times its size.
_SLAB_BYTES = 2 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and the offsets of the rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, borders, data = column.buffers()
    offsets = np.frombuffer(borders, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(offsets) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slabs(batches: Iterable[pa.RecordBatch], text: int, limit: int = _SLAB_BYTES
          ) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of about ``limit`` text bytes; a row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def in_slabs(apply: Callable[[pa.Array], pa.Array], column: pa.Array) -> pa.Array:
    """``apply`` to a text column, slab by slab."""
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    parts = [apply(slab.column(0)) for slab in slabs([batch], 0)]
    return pa.concat_arrays(parts) if parts else apply(column)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes stay."""
    return _LOWER[data]


def word_ranges(data: np.ndarray, offsets: np.ndarray, separators: bytes
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the offsets of the rows among the words."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    inside = inside[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """64-bit hashes of any ranges of a symbol sequence, by one pass of prefix sums.

    The hash of a range is the sum of its symbols' values times powers of an odd number,
    shifted to power 0, so that it depends on content and length only. Values must be
    spread over 64 bits (``byte_values``, ``mix``).
    """

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.full(n + 1, self._BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers[:-1], out=self._sums[1:])
        powers[1:] = pow(self._BASE, -1, 1 << 64)
        self._back = np.cumprod(powers, out=powers)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        content = (self._sums[ends] - self._sums[starts]) * self._back[starts]
        return mix(content + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed 64-bit number for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return RangeHash(byte_values(data)).of(starts, ends)


def list_column(values, offsets: np.ndarray) -> pa.Array:
    """Rows of a list column from their values, end to end, and their offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def strings(parts: Iterable[bytes]) -> pa.Array:
    return pa.array(list(parts), pa.binary()).cast(pa.string())
