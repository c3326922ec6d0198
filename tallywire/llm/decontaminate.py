"""Benchmark decontamination by a suffix automaton of the test items."""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.automaton import Alphabet, SuffixAutomaton, known_runs
from tallywire.llm.shared import Shared
from tallywire.llm.text import (
    NOT_PLAIN, in_slabs, list_column, lower_ascii, slabs, strings, text_bytes, word_hashes, word_ranges,
)
from tallywire.storage import make_folder, materialize, scratch_path

WINDOW = 10
MAX_COVERAGE = 0.5
# Item words in one automaton; more items are matched block by block.
BLOCK_WORDS = 100_000

_SPAN = "struct<first: bigint, last: bigint, first_byte: bigint, end_byte: bigint>"
_MATCH = f"struct<n_words: bigint, spans: array<{_SPAN}>, items: array<string>>"
_CLEANED = f"struct<n_words: bigint, spans: array<{_SPAN}>, rest: string>"

# Made once in a task: from a text column to the column of its matches.
Find = Callable[[pa.Array], pa.StructArray]


def _words(column: pa.Array):
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
    return starts, ends, rows, word_hashes(data, starts, ends), offsets


class ItemMatcher:
    """Windows of items, found by the longest match that ends at each word.

    A match of at least ``window`` words ends with a window; its state shortened to
    ``window`` words names the items that hold it. An item of fewer words is one window
    and is found at the state of the whole item, which the match must reach.
    """

    def __init__(self, names: list[str], texts: pa.Array, window: int):
        _, _, rows, hashes, _ = _words(texts)
        self.window, self.alphabet = window, Alphabet(hashes)
        ids = self.alphabet.ids(hashes).tolist()
        items = [ids[rows[i]:rows[i + 1]] for i in range(len(names))]
        self.least = min([window, *(len(item) for item in items if item)])
        self.automaton = auto = SuffixAutomaton(items)
        holders, self.whole = defaultdict(set), defaultdict(set)
        for name, item in zip(names, items):
            state = matched = 0
            for word in item:
                state, matched = auto.step(state, matched, word)
                if matched >= window:
                    holders[auto.shortened(state, window)].add(name)
            if item and len(item) < window:
                self.whole[auto.shortened(state, len(item))].add((len(item), name))
        # Per state, the one of its last ``window`` words, and the short items it ends with.
        self.ending: dict[int, int] = {}
        for state in auto.by_length():
            link = auto.link[state]
            if auto.length[state] >= window:
                self.ending[state] = state if auto.length[link] < window else self.ending[link]
            if link in self.whole:
                self.whole[state] |= self.whole[link]
        self.holders, self.whole = dict(holders), dict(self.whole)

    def run(self, ids: list[int], found: set[str]) -> Iterator[tuple[int, int]]:
        """(first word, end) of the windows in a run of known words, by their ends."""
        state = matched = 0
        for at, word in enumerate(ids, 1):
            state, matched = self.automaton.step(state, matched, word)
            longest = 0
            if matched >= self.window:
                found |= self.holders[self.ending[state]]
                longest = self.window
            for length, name in self.whole.get(state, ()):
                if length <= matched:
                    found.add(name)
                    longest = max(longest, length)
            if longest:
                yield at - longest, at

    def add_to(self, found: Found, words: tuple) -> None:
        """The spans and items that this matcher finds among a column's words."""
        _, _, rows, hashes, _ = words
        ids = self.alphabet.ids(hashes)
        for row, first, end in known_runs(ids, rows, self.least):
            for begin, stop in self.run(ids[first:end].tolist(), found.names[row]):
                merge_into(found.spans[row], first + begin, first + stop)

    def match(self, column: pa.Array) -> pa.StructArray:
        found, words = Found(), _words(column)
        self.add_to(found, words)
        return found.column(words)


class Found:
    """Spans (first word, end) and item names by row."""

    def __init__(self):
        self.spans: dict[int, list[list[int]]] = defaultdict(list)
        self.names: dict[int, set[str]] = defaultdict(set)

    def add(self, other: Found) -> None:
        """What another matcher found in the same column."""
        for row, names in other.names.items():
            self.names[row] |= names
        for row, spans in other.spans.items():
            own, both = self.spans[row], sorted(self.spans[row] + spans)
            own.clear()
            for first, end in both:
                end = max(end, own[-1][1]) if own and own[-1][1] >= first else end
                merge_into(own, first, end)

    def column(self, words: tuple) -> pa.StructArray:
        starts, ends, rows, _, offsets = words
        n = len(rows) - 1
        counts = [len(self.spans.get(row, ())) for row in range(n)]
        flat = np.array([span for row in sorted(self.spans) for span in self.spans[row]],
                        np.int64).reshape(-1, 2)
        of = np.repeat(np.arange(n), counts)
        fields = [flat[:, 0] - rows[of], flat[:, 1] - 1 - rows[of],
                  starts[flat[:, 0]] - offsets[of], ends[flat[:, 1] - 1] - offsets[of]]
        found = [sorted(self.names.get(row, ())) for row in range(n)]
        return pa.StructArray.from_arrays(
            [pa.array(np.diff(rows), pa.int64()),
             list_column(pa.StructArray.from_arrays(
                 [pa.array(f, pa.int64()) for f in fields],
                 ["first", "last", "first_byte", "end_byte"]), np.cumsum([0, *counts])),
             pa.array(found, pa.list_(pa.string()))],
            ["n_words", "spans", "items"])


def merge_into(spans: list[list[int]], first: int, end: int) -> None:
    """Add a range whose end is not before that of the last one; touching ranges are one."""
    while spans and spans[-1][1] >= first:
        first = min(first, spans.pop()[0])
    spans.append([first, end])


def _pieces(items: DataFrame, window: int, most: int) -> DataFrame:
    """Items (``name, text``) in pieces of ``most`` words that together have the same windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, 1):
            starts, ends, rows, _, offsets = _words(batch.column(1))
            data = text_bytes(batch.column(1))[0].tobytes()
            for row, name in enumerate(batch.column(0).to_pylist()):
                first, stop = int(rows[row]), int(rows[row + 1])
                heads = range(first, max(first + 1, stop - window + 1), most - window + 1)
                parts = [data[starts[at]:ends[min(at + most, stop) - 1]] for at in heads
                         if first < stop]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(parts), pa.string()), strings(parts)], ["name", "text"])

    return items.mapInArrow(cut, "name string, text string")


def _item_blocks(items: DataFrame, item_id: str, text: str, window: int, block_words: int):
    """Distinct pieces of items with a ``block``, dealt by hash, and the number of blocks."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"),
                         F.col(text).cast("string").alias("text"))
    # Small beside a block, so that blocks are of about equal size.
    most = max(2 * window, block_words // 16)
    named = materialize(_pieces(named, window, most).distinct(), "items")
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0
    # A word and what separates it take two characters at least.
    blocks = max(1, -(-total // (2 * block_words)))
    return named.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks))), blocks


def match_items(docs: DataFrame, items: DataFrame, *, text: str = "text",
                item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                block_words: int = BLOCK_WORDS, into: str = "match") -> DataFrame:
    """``docs`` with a struct ``into``: word count, maximal spans of hit words, item ids.

    Items go to the tasks as automata over blocks of bounded size, repeated rows once and
    long items in pieces that overlap by all but a word of a window. One block is built here and
    broadcast; several are built by tasks, stored, and read one by one by the tasks that go
    through the documents, which are read once, however many blocks there are. Null texts
    and texts without words have no spans; items without words match nothing; items
    with one id count once; a null item id is the empty name. An existing column named
    ``into`` is replaced.
    """
    start = _finder(items, item_id, item_text, window, block_words)

    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = start()
        for column in columns:
            yield find(column)

    match = F.arrow_udf(apply, _MATCH).asNondeterministic()
    return docs.withColumn(into, match(F.col(text).cast("string")))


def _finder(items: DataFrame, item_id: str, item_text: str, window: int, block_words: int
            ) -> Callable[[], Find]:
    """What a task calls to get its ``Find``, after the items have been put where tasks find them."""
    named, blocks = _item_blocks(items, item_id, item_text, window, block_words)
    if blocks == 1:
        rows = named.orderBy("name", "text").toArrow()
        return _matching(Shared(items.sparkSession, _matcher(rows, window)))
    return _matching_all(_stored_matchers(named, blocks, window), blocks)


def _matcher(rows: pa.Table, window: int) -> ItemMatcher:
    return ItemMatcher(rows.column("name").to_pylist(), rows.column("text").combine_chunks(), window)


def _stored_matchers(named: DataFrame, blocks: int, window: int) -> str:
    """A folder with a file for each block that has items, built by as many tasks."""
    folder = scratch_path(named.sparkSession, "decontaminate")
    make_folder(named.sparkSession, folder)

    def build(rows: pa.Table) -> pa.Table:
        matcher = cloudpickle.dumps(_matcher(rows.sort_by([("name", "ascending"), ("text", "ascending")]), window))
        block = rows.column("block")[0].as_py()
        # Another attempt writes the same; a file is there as a whole or not at all.
        fs, root = pafs.FileSystem.from_uri(_uri(folder))
        hidden = f"{root}/.{block}-{uuid.uuid4().hex}"
        with fs.open_output_stream(hidden) as stream:
            stream.write(matcher)
        fs.move(hidden, f"{root}/{block}")
        return pa.table({"size": pa.array([len(matcher)], pa.int64())})

    shards = named.repartition(blocks, "block").groupBy("block").applyInArrow(build, "size long")
    shards.agg(F.sum("size")).collect()
    return folder


def _uri(folder: str) -> str:
    return folder if ":" in folder else f"file://{folder}"


def _matching_all(folder: str, blocks: int) -> Callable[[], Find]:
    def start() -> Find:
        fs, root = pafs.FileSystem.from_uri(_uri(folder))

        def find(column: pa.Array) -> pa.StructArray:
            # A block is read once for a whole batch, and of a batch only what was found is kept.
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [part.column(0) for part in slabs([batch], 0)]
            found = [Found() for _ in parts]
            for block in range(blocks):
                if fs.get_file_info(f"{root}/{block}").type == pafs.FileType.NotFound:
                    continue
                with fs.open_input_stream(f"{root}/{block}") as stream:
                    matcher = pickle.loads(stream.read())
                for own, part in zip(found, parts):
                    more = Found()
                    matcher.add_to(more, _words(part))
                    own.add(more)
            done = [own.column(_words(part)) for own, part in zip(found, parts)]
            return pa.concat_arrays(done) if done else Found().column(_words(column))
        return find
    return start


def _matching(matcher: Shared) -> Callable[[], Find]:
    def start() -> Find:
        own = matcher.value()
        return lambda column: in_slabs(own.match, column)
    return start


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The texts that have spans, without them; null for all others."""
    hit = np.flatnonzero(np.diff(spans.offsets.to_numpy()))
    data, offsets = text_bytes(texts.take(pa.array(hit)))
    data, kept = data.tobytes(), [None] * len(texts)
    for row, cuts, at, stop in zip(hit.tolist(), spans.take(pa.array(hit)).to_pylist(),
                                   offsets[:-1].tolist(), offsets[1:].tolist()):
        first, parts = at, []
        for cut in cuts:
            parts.append(data[at:first + cut["first_byte"]])
            at = first + cut["end_byte"]
        kept[row] = b"".join([*parts, data[at:stop]])
    return strings(kept)


def hit_words(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without the spans that items also hold; same columns.

    A span is what is covered by windows of an item (``window`` consecutive words, or the
    whole of a shorter item). It goes from the text. A document of which more than
    ``max_coverage`` of the words is hit goes as a whole. Texts without a hit, null and
    empty ones stay as they are.
    """
    name = "_match"
    while name in docs.columns:
        name = f"_{name}"
    start = _finder(items, item_id, item_text, window, block_words)

    # Found and cut by one worker: two for each running task would hold twice the memory.
    def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = start()
        for column in columns:
            n_words, spans, _ = find(column).flatten()
            yield pa.StructArray.from_arrays([n_words, spans, _cut(column, spans)],
                                             ["n_words", "spans", "rest"])

    cleaned = F.arrow_udf(clean, _CLEANED).asNondeterministic()
    spans = F.col(name)["spans"]
    keep = hit_words(spans) <= F.lit(max_coverage) * F.col(name)["n_words"]
    rest = F.coalesce(F.col(name)["rest"], F.col(text))
    matched = docs.withColumn(name, cleaned(F.col(text).cast("string")))
    return matched.where(keep).withColumn(text, rest).select(*docs.columns)
