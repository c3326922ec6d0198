"""Removal of repeated byte strings by a run-length index.

Chunks find where strings may repeat (``repeats``); the surroundings of such places go to
shards by the name of what they share. A shard puts them end to end, with that shared part
as one symbol, and keeps of the text's Burrows-Wheeler transform its runs, the suffix
array's samples at the runs' ends, and the common prefixes there. Streaming over the text
then gives for each place the longest match that starts elsewhere; long ones are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywire.llm.exchange import (
    REPLIES, REPLY_SCHEMA, batch_of, bucket_bits, bucket_borders, chunk_texts, questions, totals,
)
from tallywire.llm.recompression import removed_spans
from tallywire.llm.repeats import (
    Blocks, Rule, ask_first, blocks_of, prepared, second_duplicates, window_keys,
)
from tallywire.llm.text import RangeHash, byte_values, list_column
from tallywire.storage import materialize

WINDOW = 400
# Bytes of a window that its name covers; the rest is what an index must compare.
NAME = 256
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
# Symbols in one index, but for a name whose surroundings alone are more.
INDEX_SYMBOLS = 1_500_000
# A name that occurs more often is settled by totals of its windows, which no shard gathers.
MOST_OCCURRENCES = 10_000


class RunIndex:
    """Run-length Burrows-Wheeler transform of a symbol sequence, with samples at run ends.

    The sequence ends with a separator; separators are distinct and smaller than all else, so
    no match passes one.
    """

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        order, levels = self._suffixes(text)
        before = text[order - 1]
        new = np.ones(self.size, bool)
        new[1:] = before[1:] != before[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], self.size) - 1
        self.symbols, self.lengths = before[starts], ends - starts + 1
        # Samples, and the common prefixes across the borders between runs.
        self.first, self.last = order[starts], order[ends]
        self.border = self._common(levels, self.last[:-1], self.first[1:])

    @staticmethod
    def _suffixes(text: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Suffix array by ranks of ever longer prefixes, and those ranks by prefix length."""
        n, step = len(text), 1
        ranks = text - text.min() + 1
        levels = [(1, ranks.astype(np.int32))]
        while True:
            most = int(ranks.max()) + 1
            parts = 3 if most ** 3 < 2 ** 63 else 2
            key = ranks.copy()
            for part in range(1, parts):
                key *= most
                key[:n - part * step] += ranks[part * step:]
            order = np.argsort(key)
            ordered = key[order]
            new = np.ones(n, bool)
            new[1:] = ordered[1:] != ordered[:-1]
            ranks = np.empty(n, np.int64)
            ranks[order] = np.cumsum(new)
            step *= parts
            if new.all():
                return order, levels
            levels.append((step, ranks.astype(np.int32)))

    @staticmethod
    def _common(levels, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, pair by pair."""
        length = np.zeros(len(a), np.int64)
        for step, ranks in reversed(levels):
            for _ in range(2):
                same = ranks[np.minimum(a + length, len(ranks) - 1)] == (
                    ranks[np.minimum(b + length, len(ranks) - 1)])
                length += step * same
        return length

    def _stream(self, sampled: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Values at all places: from one place to the next they fall by one but at samples."""
        order = np.argsort(sampled)
        sampled, values = sampled[order], values[order]
        at = np.searchsorted(sampled, np.arange(self.size), "right") - 1
        return values[at] - (np.arange(self.size) - sampled[at])

    def matches(self) -> np.ndarray:
        """For each place, the length of the longest match that starts at another place."""
        before = self._stream(self.first, np.append(0, self.border))
        after = self._stream(self.last, np.append(self.border, 0))
        return np.maximum(before, after)


def byte_blocks(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, name: int = NAME
                ) -> Blocks:
    """Blocks of byte windows of a chunk's texts; a window's anchor is its least ``name``-gram."""
    hashes, n = RangeHash(byte_values(data)), len(data)
    if n < window:
        return blocks_of(offsets, hashes, np.zeros(0, np.int64), 0, name, window)
    rank = hashes.of(np.arange(n - name + 1), np.arange(name, n + 1))
    # The place in the low bits: among equals the first counts, and the least tells its place.
    mask = np.uint64((1 << int(n).bit_length()) - 1)
    least = (rank & ~mask) | np.arange(len(rank), dtype=np.uint64)
    del rank
    size, span = 1, window - name + 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[:size - span], least[span - size:])
    anchors = (least & mask).astype(np.int64)
    return blocks_of(offsets, hashes, anchors, 0, name, window)


_SECOND = ("chunk long, bucket int, keys binary, counts binary, lows binary, "
           "lefts binary, sizes binary, firsts binary, sure binary, texts binary")
_SECOND_SCHEMA = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *(
    (c, pa.binary()) for c in ("keys", "counts", "lows", "lefts", "sizes", "firsts", "sure",
                               "texts"))])


def surroundings(chunk: int, data: np.ndarray, blocks: Blocks, chosen: np.ndarray,
                 sure: np.ndarray, name: int, bits: int) -> Iterator[dict]:
    """Rows for the shards: what stands before and after the named part of each block."""
    chosen = chosen[np.argsort(blocks.name[chosen], kind="stable")]
    first, anchor = blocks.first[chosen], blocks.anchor[chosen]
    lefts = anchor - first
    sizes = blocks.last[chosen] + blocks.window - first - name
    borders = bucket_borders(blocks.name[chosen], bits)
    for bucket in np.flatnonzero(np.diff(borders)).tolist():
        part = slice(borders[bucket], borders[bucket + 1])
        of = np.repeat(np.arange(*part.indices(len(chosen))), sizes[part])
        within = np.arange(len(of)) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])
        places = first[of] + within + name * (within >= lefts[of])
        yield {"chunk": chunk, "bucket": bucket, "keys": blocks.name[chosen[part]].tobytes(),
               "lefts": lefts[part].astype(np.int32).tobytes(),
               "sizes": sizes[part].astype(np.int32).tobytes(),
               "firsts": first[part].astype(np.int64).tobytes(),
               "sure": sure[chosen[part]].tobytes(), "texts": data[places].tobytes()}


def _indexed(names: np.ndarray, lefts: np.ndarray, sizes: np.ndarray, texts: np.ndarray,
             begins: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries and offsets in them of the windows that match elsewhere among the entries."""
    n = len(names)
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    of = np.repeat(np.arange(n), sizes)
    within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text = np.empty(int(sizes.sum()) + 2 * n, np.int64)
    # Separators are 0 to n - 1; then come the bytes, then the names.
    text[starts[of] + within + (within >= lefts[of])] = (
        texts[begins[of] + within].astype(np.int64) + n)
    text[starts + lefts] = np.cumsum(np.append(True, names[1:] != names[:-1])) + n + 255
    text[starts + sizes + 1] = np.arange(n)
    matches = RunIndex(text).matches()
    hits = np.flatnonzero(matches >= need)
    entry = np.searchsorted(starts, hits, "right") - 1
    return entry, hits - starts[entry]


def mark_matches(shard: pa.Table, need: int, index_symbols: int) -> pa.Table:
    """Starts of the windows that match elsewhere, by chunk; indexes are built name by name."""
    rows = shard.to_pylist()

    def joined(column: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(row[column], kind) for row in rows])

    names, lefts = joined("keys", np.uint64), joined("lefts", np.int32).astype(np.int64)
    sizes, firsts = joined("sizes", np.int32).astype(np.int64), joined("firsts", np.int64)
    sure, texts = joined("sure", bool), joined("texts", np.uint8)
    chunk = np.repeat([row["chunk"] for row in rows], [len(row["keys"]) // 8 for row in rows])
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(names, kind="stable")
    ends = np.flatnonzero(np.append(names[order][1:] != names[order][:-1], True)) + 1
    weight = np.cumsum(sizes[order] + 2)
    found, start = [], 0
    while start < len(order):
        limit = (weight[start - 1] if start else 0) + index_symbols
        at = np.searchsorted(ends, np.searchsorted(weight, limit, "right"), "right") - 1
        stop = ends[at] if at >= 0 and ends[at] > start else ends[np.searchsorted(ends, start, "right")]
        part = order[start:stop]
        entry, offset = _indexed(names[part], lefts[part], sizes[part], texts, begins[part], need)
        entry = part[entry]
        asked = ~sure[entry]
        found.append((chunk[entry[asked]], firsts[entry[asked]] + offset[asked]))
        start = stop
    chunks, places = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(chunks, kind="stable")
    chunks, places = chunks[order], places[order]
    heads = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])) if len(chunks) else []
    out = [{"chunk": int(chunks[a]), "bucket": -2, "round": 3, "reply": places[a:b].tobytes()}
           for a, b in zip(heads, [*heads[1:], len(chunks)])]
    return pa.Table.from_batches([batch_of(out, REPLY_SCHEMA)])


_RESULT = ("id long, kept binary, n_bytes long, n_removed long, "
           "spans array<struct<first: long, end: long>>")


def remove_repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                          window: int = WINDOW, name: int = NAME,
                          chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                          index_symbols: int = INDEX_SYMBOLS,
                          most_occurrences: int = MOST_OCCURRENCES) -> DataFrame:
    """Texts without the bytes of any string of ``window`` bytes that starts in two places.

    Returns per row ``id``, ``kept`` (bytes: a character may be cut), ``n_bytes``, ``n_removed``
    and the maximal removed ``spans``. Strings lie within a text and are judged on the texts
    as given; places may be in one text and may overlap; all copies go. Repeated rows
    repeat their strings. Null and empty texts have no bytes; shorter ones than ``window`` stay.
    Names that occur more than ``most_occurrences`` times are as exact, but settled by
    totals of their windows over all chunks instead of an index in one task.
    """
    rule, bits = Rule(earlier=False), bucket_bits(docs, text, bucket_bytes)

    def parse(data: np.ndarray, offsets: np.ndarray) -> Blocks:
        return byte_blocks(data, offsets, window, name)

    asked = ask_first(prepared(docs, id_col, text), rule, parse, bits, chunk_bytes)
    chunks = asked.where("bucket = -1").select("chunk", "ids", "offsets", "texts")
    replies = materialize(totals(asked, 1), "repeats-replies", compression="zstd")

    def judged(row: dict, said: pa.Table):
        data, offsets = chunk_texts(row)
        blocks = parse(data, offsets)
        keys, order = rule.first_keys(row["chunk"], row["ids"], blocks)
        first = rule.first_verdicts(keys, order, said)
        hot = first.open & (first.occurrences > most_occurrences)
        return data, blocks, first, np.flatnonzero(hot), np.flatnonzero(first.open & ~hot)

    def compare(own: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        for row in own.to_pylist():
            data, blocks, first, hot, rest = judged(row, said)
            windows, _, _ = window_keys(rule, row["chunk"], row["ids"], blocks, hot)
            rows += questions(row["chunk"], windows.distinct, windows.counts, windows.lows, bits)
            rows += surroundings(row["chunk"], data, blocks, rest, first.duplicate, name, bits)
        return pa.Table.from_batches([batch_of(rows, _SECOND_SCHEMA)])

    def mark(shard: pa.Table) -> pa.Table:
        return mark_matches(shard, window - name + 1, index_symbols)

    def finish(own: pa.Table, said: pa.Table) -> pa.Table:
        out = []
        for row in own.to_pylist():
            data, blocks, first, hot, _ = judged(row, said)
            sure, _ = blocks.starts(np.flatnonzero(first.duplicate))
            marked = [np.frombuffer(r["reply"], np.int64) for r in said.to_pylist()
                      if r["round"] == 3]
            counted = second_duplicates(rule, row["chunk"], row["ids"], blocks, hot, said)
            out.append(_rest(row["ids"], data, blocks.rows, blocks.covered(
                np.concatenate([sure, counted, *marked]))))
        return pa.concat_tables(out)

    by_chunk = chunks.groupBy("chunk")
    second = materialize(by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(compare, _SECOND),
                         "repeats-surroundings", compression="zstd")
    # An index costs far more than its bytes tell, so shards are dealt out by number and not
    # merged by size.
    shards = second.where("lefts is not null").repartition(1 << bits, "bucket")
    marks = shards.groupBy("bucket").applyInArrow(mark, REPLIES)
    said = (replies.unionByName(totals(second.where("lefts is null"), 2)).unionByName(marks))
    return by_chunk.cogroup(said.groupBy("chunk")).applyInArrow(finish, _RESULT)


def _rest(ids: list, data: np.ndarray, rows: np.ndarray, gone: np.ndarray) -> pa.Table:
    removed = np.append(0, np.cumsum(gone))[rows]
    kept = data[~gone]
    spans, borders = removed_spans(gone, rows)
    return pa.table({
        "id": pa.array(ids, pa.int64()),
        "kept": pa.Array.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer((rows - removed).astype(np.int32)),
                                    pa.py_buffer(kept.tobytes())]),
        "n_bytes": pa.array(np.diff(rows), pa.int64()),
        "n_removed": pa.array(np.diff(removed), pa.int64()),
        "spans": list_column(spans, borders)})
