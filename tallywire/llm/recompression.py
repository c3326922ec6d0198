"""Substring dedup of words by recompression.

Words are symbols. A round names runs of one symbol, then pairs of a left and a right one,
each name being a hash of what it stands for, so that all tasks give one name to one content
without asking each other. Equal passages so get equal symbols but near their ends, and
symbols shared by documents reveal passages that may repeat; those are verified in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywire.llm.exchange import (
    CHUNK_SCHEMA, CHUNKS, batch_of, bucket_bits, chunk_texts, questions, totals,
)
from tallywire.llm.repeats import (
    Blocks, Rule, ask_first, blocks_of, prepared, second_duplicates, window_keys,
)
from tallywire.llm.text import (
    SPACES, RangeHash, byte_values, list_column, mix, strings, word_ranges,
)
from tallywire.storage import materialize

WINDOW = 50
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20

# Most words of a run's and of a pair's name, by round.
ROUNDS = [(2, 2), (4, 4), (0, 8)]
# Two equal passages have equal symbols but for so many words at either end: a round's run or
# pair may take in, across the end, a run of its cap or a symbol of the round's cap.
MARGIN = 2 + 2 + 4 + 4 + 4
_LONGEST = ROUNDS[-1][1]

_RUN = np.uint64(0x9FB21C651E98DF25)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_SIDE = 0xD1B54A32D192ED03


def recompress(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols after all rounds; none crosses a document's end."""
    names, first = words, np.arange(len(words))
    ends = np.zeros(len(words) + 1, bool)
    ends[rows] = True
    for number, (run_cap, pair_cap) in enumerate(ROUNDS):
        if run_cap:
            names, first = _name_runs(names, first, len(words), ends, run_cap)
        names, first = _name_pairs(names, first, len(words), ends, pair_cap, number)
    return names, first


def _name_runs(names, first, n, ends, cap):
    """A run of one symbol, if it has no more than ``cap`` words, becomes one symbol."""
    if not len(names):
        return names, first
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | ends[first[1:]]
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(names)))
    words = np.diff(np.append(first[heads], n))
    joined = (counts > 1) & (words <= cap)
    keep = new | ~np.repeat(joined, counts)
    out = names.copy()
    out[heads[joined]] = mix(names[heads[joined]] + counts[joined].astype(np.uint64) * _RUN)
    return out[keep], first[keep]


def _name_pairs(names, first, n, ends, cap, number):
    """A left symbol and the right one after it become one; the name's hash tells the side."""
    if len(names) < 2:
        return names, first
    side = np.uint64((number + 1) * _SIDE % 2**64)
    right = (mix(names + side) >> np.uint64(63)).astype(bool)
    sizes = np.diff(np.append(first, n))
    pair = (~right[:-1] & right[1:] & ~ends[first[1:]] & (sizes[:-1] + sizes[1:] <= cap))
    at = np.flatnonzero(pair)
    out = names.copy()
    out[at] = mix(names[at] * _PAIR + names[at + 1])
    keep = np.ones(len(names), bool)
    keep[at + 1] = False
    return out[keep], first[keep]


def _anchors(names: np.ndarray, first: np.ndarray, n: int, window: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """Per window, first word and words of the symbol with the least hash well inside it.

    The symbols that lie ``MARGIN`` words from both ends follow from the window alone.
    """
    starts = np.arange(max(0, n - window + 1))
    ends = np.append(first[1:], n)
    low = np.searchsorted(first, starts + MARGIN)
    high = np.searchsorted(ends, starts + window - MARGIN, "right")
    # Windows across documents may have no symbol; they are no windows and are left out later.
    high = np.maximum(high, low + 1)
    rank = mix(names ^ np.uint64(_SIDE))
    place = np.arange(len(names))
    level, least = [place], place
    size = 1
    while 2 * size <= window:
        a, b = least[:-size], least[size:]
        least = np.where(rank[a] <= rank[b], a, b)
        level.append(least)
        size *= 2
    low = np.minimum(low, len(names) - 1)
    high = np.minimum(high, len(names))
    power = np.frexp(np.maximum(high - low, 1).astype(float))[1] - 1
    chosen = np.empty(len(starts), np.int64)
    for p in range(len(level)):
        own = np.flatnonzero(power == p)
        a = level[p][low[own]]
        b = level[p][high[own] - (1 << p)]
        chosen[own] = np.where(rank[a] <= rank[b], a, b)
    return first[chosen], (ends - first)[chosen]


def word_blocks(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> Blocks:
    """Blocks of word windows of a chunk's texts."""
    begin, end, rows = word_ranges(data, offsets, SPACES)
    words = RangeHash(byte_values(data)).of(begin, end)
    names, first = recompress(words, rows)
    anchors, sizes = _anchors(names, first, len(words), window)
    return blocks_of(rows, RangeHash(words), anchors, MARGIN, sizes + 2 * MARGIN, window,
                     (begin, end))


_RESULT = ("id long, text string, n_words long, n_removed long, "
           "spans array<struct<first: long, end: long>>")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                   window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Texts without the words of passages that a document with a smaller id also holds.

    Returns per row ``id``, ``text`` (the words that stay, joined by one space), ``n_words``,
    ``n_removed`` and ``spans`` of removed words. A word goes if it lies in a window of
    ``window`` words whose sequence also starts in a document with a smaller id, judged on
    the texts as given. Rows with one id never remove from each other; a null id is larger
    than all others. Null and empty texts have no words, texts shorter than a window stay.
    ``window`` must be at least ``2 * MARGIN`` and twice the longest symbol less one, 47.
    """
    if window < 2 * MARGIN + 2 * _LONGEST - 1:
        raise ValueError(f"windows of {window} words hold no certain symbol")
    rule, bits = Rule(earlier=True), bucket_bits(docs, text, bucket_bytes)

    def parse(data: np.ndarray, offsets: np.ndarray) -> Blocks:
        return word_blocks(data, offsets, window)

    asked = ask_first(prepared(docs, id_col, text), rule, parse, bits, chunk_bytes)
    chunks = asked.where("bucket = -1").select("chunk", "ids", "offsets", "texts")
    replies = materialize(totals(asked, 1), "repeats-replies", compression="zstd")

    def compare(own: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        for row in own.to_pylist():
            chunk, ids = row["chunk"], row["ids"]
            blocks = parse(*chunk_texts(row))
            keys, order = rule.first_keys(chunk, ids, blocks)
            chosen = np.flatnonzero(rule.first_verdicts(keys, order, said).open)
            windows, _, _ = window_keys(rule, chunk, ids, blocks, chosen)
            rows += questions(chunk, windows.distinct, windows.counts, windows.lows, bits)
        return pa.Table.from_batches([batch_of(rows, CHUNK_SCHEMA)])

    def finish(own: pa.Table, said: pa.Table) -> pa.Table:
        return pa.concat_tables(_kept(row, said, rule, parse) for row in own.to_pylist())

    by_chunk = chunks.groupBy("chunk")
    second = materialize(by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(compare, CHUNKS),
                         "repeats-windows", compression="zstd")
    said = replies.unionByName(totals(second, 2))
    return by_chunk.cogroup(said.groupBy("chunk")).applyInArrow(finish, _RESULT)


def _kept(row: dict, said: pa.Table, rule: Rule, parse) -> pa.Table:
    chunk, ids = row["chunk"], row["ids"]
    data, offsets = chunk_texts(row)
    blocks = parse(data, offsets)
    keys, order = rule.first_keys(chunk, ids, blocks)
    first = rule.first_verdicts(keys, order, said)
    sure, _ = blocks.starts(np.flatnonzero(first.duplicate))
    found = second_duplicates(rule, chunk, ids, blocks, np.flatnonzero(first.open), said)
    gone = blocks.covered(np.concatenate([sure, found]))
    texts = list(_kept_words(data, blocks, gone))
    counts = np.diff(np.append(0, np.cumsum(gone))[blocks.rows])
    spans, borders = removed_spans(gone, blocks.rows)
    return pa.table({
        "id": pa.array(ids, pa.int64()), "text": strings(texts),
        "n_words": pa.array(np.diff(blocks.rows), pa.int64()), "n_removed": pa.array(counts, pa.int64()),
        "spans": list_column(spans, borders)})


def _kept_words(data: np.ndarray, blocks: Blocks, gone: np.ndarray) -> Iterator[bytes]:
    """Per document its words that stay, one space between them."""
    begin, end = blocks.spans
    content = data.tobytes()
    for a, b in zip(blocks.rows[:-1].tolist(), blocks.rows[1:].tolist()):
        if a == b:
            yield b""
        elif not gone[a:b].any():
            # What separates words are white-space bytes, as for ``split``.
            yield b" ".join(content[begin[a]:end[b - 1]].split())
        else:
            stay = a + np.flatnonzero(~gone[a:b])
            yield b" ".join([content[x:y] for x, y in zip(begin[stay].tolist(), end[stay].tolist())])


def removed_spans(gone: np.ndarray, rows: np.ndarray) -> tuple[pa.StructArray, np.ndarray]:
    """Maximal runs of removed units within documents, counted from a document's first."""
    edge = np.zeros(len(gone) + 1, bool)
    edge[rows] = True
    first, end = gone.copy(), gone.copy()
    first[1:] &= ~gone[:-1] | edge[1:-1]
    end[:-1] &= ~gone[1:] | edge[1:-1]
    first, end = np.flatnonzero(first), np.flatnonzero(end) + 1
    own = rows[np.searchsorted(rows, first, "right") - 1]
    return (pa.StructArray.from_arrays([pa.array(first - own, pa.int64()),
                                        pa.array(end - own, pa.int64())], ["first", "end"]),
            np.searchsorted(first, rows))

