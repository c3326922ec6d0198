"""Exact search for windows of a fixed size that repeat, in two rounds over chunks.

Both finders of repeated passages (``run_index``, ``recompression``) use it. A window has an
anchor, a place that follows from the window's content alone, and a name, the hash of a
range around the anchor that all windows of that anchor hold. Windows next to one another with one
anchor are a block. Equal windows have equal names, so a name that occurs once ends the search
for its block. Blocks with equal content are settled by their number; only where a name
has different blocks, as at the ends of a repeat, must single windows be compared, one copy
of each block. All decisions are exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.exchange import (
    CHUNK_SCHEMA, CHUNKS, answers, batch_of, chunk_row, column_texts, grouped, numbered_slabs,
    questions,
)
from tallywire.llm.text import RangeHash, mix
from tallywire.storage import materialize

_BLOCK = np.uint64(0x5851F42D4C957F2D)
_NAME = np.uint64(0x8CB92BA72F3D8DD7)
_WINDOW = np.uint64(0x14057B7EF767814F)


@dataclass
class Blocks:
    """A chunk's units (bytes or words) and its blocks of windows."""

    rows: np.ndarray      # offsets of the documents among the units
    hashes: RangeHash     # over the units
    first: np.ndarray     # first and last window start of each block
    last: np.ndarray
    anchor: np.ndarray
    name: np.ndarray
    window: int
    spans: tuple          # first byte and end of each unit, where units aren't bytes

    def doc(self) -> np.ndarray:
        return np.searchsorted(self.rows, self.first, "right") - 1

    def contents(self) -> np.ndarray:
        """Hash of each block: its units, and where the anchor lies in it."""
        content = self.hashes.of(self.first, self.last + self.window)
        return mix(content + (self.anchor - self.first).astype(np.uint64) * _BLOCK)

    def starts(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window starts of some blocks, and of which block each is."""
        sizes = self.last[blocks] - self.first[blocks] + 1
        of = np.repeat(blocks, sizes)
        within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.first[of] + within, of

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return mix(self.hashes.of(starts, starts + self.window) ^ _WINDOW)

    def covered(self, duplicate: np.ndarray) -> np.ndarray:
        """Which units lie in a window that starts at one of the given places."""
        edges = np.zeros(self.rows[-1] + self.window + 1, np.int32)
        np.add.at(edges, duplicate, 1)
        np.add.at(edges, duplicate + self.window, -1)
        return np.cumsum(edges)[:self.rows[-1]] > 0


def blocks_of(rows: np.ndarray, hashes: RangeHash, anchors: np.ndarray, name_from: int,
              name_sizes: np.ndarray | int, window: int, spans: tuple = ()) -> Blocks:
    """Blocks from the anchor of the window at each unit.

    Names are of the ranges that begin ``name_from`` units before the anchors.
    """
    n = int(rows[-1])
    fits = np.zeros(n + 1, np.int32)
    sizes = np.diff(rows)
    long = sizes >= window
    fits[rows[:-1][long]] += 1
    fits[rows[1:][long] - window + 1] -= 1
    fits = np.cumsum(fits)[:len(anchors)] > 0
    new, end = fits.copy(), fits.copy()
    new[1:] &= (anchors[1:] != anchors[:-1]) | ~fits[:-1]
    end[:-1] &= (anchors[1:] != anchors[:-1]) | ~fits[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    anchor = anchors[first]
    sizes = name_sizes if isinstance(name_sizes, int) else name_sizes[first]
    # Mixed again: anchors with least hashes would else have names in few buckets.
    name = mix(hashes.of(anchor - name_from, anchor - name_from + sizes) ^ _NAME)
    return Blocks(rows, hashes, first, last, anchor, name, window, spans)


@dataclass
class Keys:
    """Entries of a chunk in a round: distinct keys, and for each entry which one it is."""

    distinct: np.ndarray
    counts: np.ndarray
    lows: np.ndarray
    of: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, order: np.ndarray) -> Keys:
        by, firsts, of = grouped(keys)
        if not len(keys):
            return cls(keys, np.zeros(0, np.int64), np.zeros(0, np.int64), of)
        return cls(keys[by[firsts]], np.diff(np.append(firsts, len(keys))),
                   np.minimum.reduceat(order[by], firsts), of)


@dataclass
class Verdicts:
    """What the first round says of a chunk's blocks."""

    duplicate: np.ndarray   # all windows of the block are duplicates
    open: np.ndarray        # single windows must be compared; one copy for each content
    occurrences: np.ndarray


class Rule:
    """Which occurrences of equal content are duplicates.

    ``earlier``: those in a document whose id is not the smallest with the content.
    Otherwise all, if there are two or more.
    """

    def __init__(self, earlier: bool):
        self.earlier = earlier

    def order(self, chunk: int, ids: list, doc: np.ndarray) -> np.ndarray:
        """What is compared between occurrences; a null id is larger than all others."""
        if not self.earlier:
            return np.full(len(doc), chunk, np.int64)
        largest = np.iinfo(np.int64).max
        return np.array([largest if i is None else i for i in ids], np.int64)[doc]

    def duplicate(self, keys: Keys, order: np.ndarray, total: np.ndarray, lowest: np.ndarray
                  ) -> np.ndarray:
        if self.earlier:
            return (order > keys.lows[keys.of]) | ~lowest[keys.of]
        return total[keys.of] >= 2

    def first_keys(self, chunk: int, ids: list, blocks: Blocks) -> tuple[Keys, np.ndarray]:
        order = self.order(chunk, ids, blocks.doc())
        both = np.concatenate([blocks.name, blocks.contents()])
        return Keys.build(both, np.concatenate([order, order])), order

    def first_verdicts(self, keys: Keys, order: np.ndarray, replies: pa.Table) -> Verdicts:
        total, lowest = answers(replies, 1)
        n = len(order)
        by_name, content = keys.of[:n], keys.of[n:]
        duplicate = self.duplicate(Keys(keys.distinct, keys.counts, keys.lows, content), order,
                                   total, lowest)
        holds = lowest[content] & (order == keys.lows[content])
        if not self.earlier:
            # One of the chunk's copies.
            _, at = np.unique(content, return_index=True)
            once = np.zeros(n, bool)
            once[at] = True
            holds &= once
        several = (total[by_name] != total[content]) | (total[by_name] >= (1 << 31) - 1)
        return Verdicts(duplicate, holds & several, total[by_name])


Parse = Callable[[np.ndarray, np.ndarray], Blocks]


def ask_first(docs: DataFrame, rule: Rule, parse: Parse, bits: int, chunk_bytes: int) -> DataFrame:
    """Chunks and their first questions, stored; ``docs`` has (id, text)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, batch in numbered_slabs(batches, 1, chunk_bytes):
            ids, data, offsets = column_texts(batch)
            keys, _ = rule.first_keys(chunk, ids, parse(data, offsets))
            yield batch_of([chunk_row(chunk, ids, data, offsets),
                            *questions(chunk, keys.distinct, keys.counts, keys.lows, bits)],
                           CHUNK_SCHEMA)

    return materialize(docs.mapInArrow(encode, CHUNKS), "repeats", compression="zstd")


def window_keys(rule: Rule, chunk: int, ids: list, blocks: Blocks, chosen: np.ndarray
                ) -> tuple[Keys, np.ndarray, np.ndarray]:
    """Entries of the windows of chosen blocks, their order values and their starts."""
    starts, of = blocks.starts(chosen)
    order = rule.order(chunk, ids, np.searchsorted(blocks.rows, blocks.first[of], "right") - 1)
    return Keys.build(blocks.windows(starts), order), order, starts


def second_duplicates(rule: Rule, chunk: int, ids: list, blocks: Blocks, chosen: np.ndarray,
                      replies: pa.Table) -> np.ndarray:
    """Starts of the windows that the second round says are duplicates."""
    keys, order, starts = window_keys(rule, chunk, ids, blocks, chosen)
    total, lowest = answers(replies, 2)
    if not len(starts):
        return starts
    return starts[rule.duplicate(keys, order, total, lowest)]


def prepared(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"),
                       F.col(text).cast("string").alias("text"))

