"""Spelling variants: words one edit apart, found by a frontier of trie states.

Every word is put into a trie twice, forwards and backwards, as a distributed table of edges.
States (word, position, node, edits) are joined with the edges of their node, level by level:
a state without an edit goes on along its own word, tries other letters and leaves a letter
out; a state with one has to go on exactly. Of two words one edit apart, the edit is in the
later half of one of the two directions, so a state starts at its word's middle, where few
words are left below a node. An edge with one word below it is settled at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.text import (
    RangeHash, lower_ascii, mix, slabs, text_bytes, word_hashes, word_ranges,
)
from tallywire.storage import materialize

LEAST_LETTERS = 5
LEAST_COUNT = 3
# A form has at least this many times its variant's occurrences.
FORM_RATIO = 2
# Fixed value: which runs lose a letter.
DAMAGE = 97
# Letters of words that go through the trie; longer ones are compared by what an edit leaves.
DEPTH = 32
# A node with this many states and this share of a level's is joined apart from the others.
HOT_ROWS = 200_000
HOT_SHARE = 1024
_SLAB_BYTES = 4 << 20
_STEPPED = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()
_LETTERS = np.zeros(256, bool)
_LETTERS[0x61:0x7B] = True
# UTF-8 of U+00C0 to U+00FF is this byte and one more.
_LATIN = 0xC3


def crc_after(before: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
              ) -> np.ndarray:
    """crc32 of byte ranges, each after what has the crc32 ``before``."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    starts_, size_ = starts[order], -size[order]
    crc = ~before[order].astype(np.uint32)
    for at in range(min(_STEPPED, int(size.max(initial=0)))):
        n = np.searchsorted(size_, -at)
        part = crc[:n]
        crc[:n] = _CRC[(part ^ data[starts_[:n] + at]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    crc = ~crc
    for at in range(int(np.searchsorted(size_, -_STEPPED))):
        first, end = starts_[at] + _STEPPED, starts_[at] - size_[at]
        crc[at] = zlib.crc32(data[first:end].tobytes(), int(crc[at]))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def _cut_long(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows again, texts of more than ``limit`` bytes in pieces that no run crosses."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for row in np.flatnonzero(size > limit).tolist():
            if row > start:
                yield batch.slice(start, row - start)
            start = row + 1
            data, _ = text_bytes(batch.column(1).slice(row, 1))
            at = 0
            while at < len(data):
                end = min(at + limit, len(data))
                # An ASCII character that is no letter ends a run and is a character of its own.
                while end < len(data) and (data[end] >= 0x80 or _LETTERS[data[end] | 0x20]):
                    end += 1
                piece = pa.array([data[at:end].tobytes()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), piece], ["id", "text"])
                at = end
        if start < batch.num_rows:
            yield batch.slice(start)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of enough letters and how often each occurs, slab by slab."""
    for batch in slabs(_cut_long(batches, _SLAB_BYTES), 1, _SLAB_BYTES):
        data, offsets = text_bytes(batch.column(1))
        data = lower_ascii(data)
        lead = data == _LATIN
        inside = _LETTERS[data] | lead
        inside[1:] |= lead[:-1]
        starts, ends, rows = word_ranges(np.where(inside, data, 0x20), offsets, b" ")
        letters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        length = letters[ends] - letters[starts]
        before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode())
                           for i in batch.column(0).to_pylist()], np.uint32)
        of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        crc = crc_after(before[of], data, starts, ends)
        damaged = crc % DAMAGE == 0
        changed = []
        for k in np.flatnonzero(damaged & (length > LEAST_LETTERS)).tolist():
            word = data[starts[k]:ends[k]].tobytes().decode()
            at = int(crc[k]) % len(word)
            changed.append(word[:at] + word[at + 1:])
        whole = ~damaged & (length >= LEAST_LETTERS)
        starts, ends = starts[whole], ends[whole]
        _, first, counts = np.unique(word_hashes(data, starts, ends), return_index=True,
                                     return_counts=True)
        words = pa.concat_arrays([_strings(data, starts[first], ends[first]),
                                  pa.array(changed, pa.string())])
        n = np.append(counts, np.ones(len(changed), np.int64))
        yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])


def damaged_words(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                  least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the words of all texts, some runs with a letter taken out, and their counts.

    A run of Latin letters, A-Z in lower case, loses a letter if ``DAMAGE`` divides the crc32 of
    the row's id (null: empty), a colon and the run; the same crc32 names the letter. Words have
    ``LEAST_LETTERS`` letters or more, and occur ``least_count`` times or more over all rows.
    Null and empty texts have none; repeated rows count again.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.col(text).cast("string").alias("text"))
    return (rows.mapInArrow(_counted, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _directed(words: DataFrame) -> DataFrame:
    """Each word forwards (after ``>``) and backwards (after ``<``), and how much of it a
    state starts with: about half, the two halves of a word together being all of it."""
    half = F.expr("length(word) div 2")
    return words.select(F.explode(F.array(
        F.struct(F.concat(F.lit(">"), "word").alias("s"), (half + 1).cast("int").alias("first")),
        F.struct(F.concat(F.lit("<"), F.reverse("word")).alias("s"),
                 (F.length("word") - half + 1).cast("int").alias("first")))).alias("w")).select("w.*")


def _edges(directed: DataFrame) -> DataFrame:
    """``node, letter, one, depth``: the trie's edges below the middle of each word.

    A node is the text it spells. The edge without a letter ends a word. ``one`` is the hash of
    the only word below an edge, and null where there are several. No word is met above its
    middle: a state that may end there starts no higher.
    """
    depth = F.explode(F.sequence("first", F.length("s"))).alias("depth")
    return (directed.select("s", depth)
            .select(F.expr("substring(s, 1, depth)").alias("node"),
                    F.expr("substring(s, depth + 1, 1)").alias("letter"), "depth",
                    F.xxhash64("s").alias("below"))
            .groupBy("node", "letter", "depth")
            .agg(F.max("below").alias("below"), F.count("*").alias("words"))
            .select("node", "letter", "depth", F.when(F.col("words") == 1, F.col("below")).alias("one")))


def _branches(states: DataFrame) -> DataFrame:
    """States, and for those without an edit the ones that leave their next letter out.

    Of a run of one letter only the last is left out, which gives the same word.
    """
    here, after = F.expr("substring(s, pos + 1, 1)"), F.expr("substring(s, pos + 2, 1)")
    shorter = states.where((F.col("edits") == 0) & (here != "") & (here != after)).select(
        "s", (F.col("pos") + 1).alias("pos"), "node", F.lit(1).alias("edits"))
    return states.unionByName(shorter)


def _hot_nodes(states: DataFrame, hot_rows: int) -> list[str]:
    """Nodes with more than a fixed share of a level's states: at most ``HOT_SHARE`` of them."""
    total = states.count()
    if total < hot_rows:
        return []
    n = F.count("*").alias("n")
    found = states.groupBy("node").agg(n).where(F.col("n") >= max(hot_rows, -(-total // HOT_SHARE)))
    return [row.node for row in found.collect()]


def _step(states: DataFrame, edges: DataFrame, hot: list[str]) -> DataFrame:
    """The states one level down, and the words that were met (``near``).

    Another letter is tried only if it is later in the alphabet: the word it leads to finds the
    pair otherwise. The edges of a hot node are few (one for each letter) and go to its states.
    """
    here = F.expr("substring(s, pos + 1, 1)")
    allowed = F.when(F.col("edits") == 1, F.col("letter") == here).otherwise(
        (here != "") & ((F.col("letter") > here) | ((F.col("letter") == here) & F.col("one").isNull())))
    joined = states.join(edges, "node").where(allowed)
    if hot:
        is_hot = F.col("node").isin(hot)
        joined = (states.where(~is_hot).join(edges.where(~is_hot), "node").where(allowed)
                  .unionByName(states.where(is_hot).join(
                      F.broadcast(edges.where(is_hot)), "node").where(allowed)))
    met = F.concat("node", "letter", F.expr("substring(s, pos + 2)"))
    return joined.where(F.col("one").isNull() | (F.col("one") == F.xxhash64(met))).select(
        "s", (F.col("pos") + 1).alias("pos"), F.concat("node", "letter").alias("node"),
        F.when(F.col("letter") == here, F.col("edits")).otherwise(1).alias("edits"),
        F.when(F.col("one").isNotNull(), met).alias("near"))


def _undirected(s: str):
    word = F.expr(f"substring({s}, 2)")
    return F.when(F.col(s).startswith(">"), word).otherwise(F.reverse(word))


def _trie_pairs(words: DataFrame, hot_rows: int) -> DataFrame:
    """``word, near`` of words one edit apart, from one side each."""
    spark = words.sparkSession
    directed = materialize(_directed(words), "spelling", partition_by="first")
    edges = materialize(_edges(directed), "spelling", partition_by="depth")
    span = directed.agg(F.min("first"), F.max("first")).first()
    level, last = (span[0], span[1]) if span[0] is not None else (1, 0)
    carried, found = None, spark.createDataFrame([], "s string, near string")
    while level <= last or carried is not None:
        states = directed.where(F.col("first") == level).select(
            "s", F.col("first").alias("pos"), F.expr("substring(s, 1, first)").alias("node"),
            F.lit(0).alias("edits"))
        if carried is not None:
            states = states.unionByName(carried)
        states = _branches(states)
        out = materialize(_step(states, edges.where(F.col("depth") == level).drop("depth"),
                                _hot_nodes(states, hot_rows)), "spelling")
        found = found.unionByName(out.where("near is not null").select("s", "near"))
        carried = out.where("near is null").drop("near")
        if carried.isEmpty():
            carried = None
        level += 1
    return found.select(_undirected("s").alias("word"), _undirected("near").alias("near"))


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of what is left of long words without each letter, and cut at each place."""
    schema = pa.schema([("key", pa.int64()), ("word_id", pa.int64()), ("gap", pa.bool_())])
    for batch in batches:
        for word_id, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
            ranges, n = RangeHash(mix(points + np.uint64(1))), len(points)
            place = np.arange(n + 1)
            zero, end = np.zeros(n + 1, np.int64), np.full(n + 1, n)

            def keys(head: np.ndarray, tail: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
                return mix(mix(mix(head) + tail) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                           + np.uint64(length)).view(np.int64)

            head = ranges.of(zero, place)
            gaps = keys(head[:-1], ranges.of(place[1:], end[1:]), place[:-1], n - 1)
            cuts = keys(head, ranges.of(place, end), place, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([gaps, cuts])), pa.array(np.full(2 * n + 1, word_id)),
                 pa.array(np.arange(2 * n + 1) < n)], schema=schema)


def _long_pairs(words: DataFrame, depth: int) -> DataFrame:
    """``word, near`` one edit apart of which one has more than ``depth`` letters, once each.

    Two words differ in one letter if they are alike without it, and in one more letter if
    one without it is the other, cut at that place. The rows are as many as the letters.
    """
    named = words.where(F.length("word") >= depth).select(F.xxhash64("word").alias("word_id"), "word")
    rests = materialize(named.mapInArrow(_rests, "key long, word_id long, gap boolean"), "spelling")
    gaps = rests.where("gap").select("key", F.col("word_id").alias("a"))
    others = rests.select("key", F.col("word_id").alias("b"), "gap")
    ids = gaps.join(others, "key").where("a <> b and (not gap or a < b)").select("a", "b").distinct()
    pairs = (ids.join(named.select(F.col("word_id").alias("a"), "word"), "a")
             .join(named.select(F.col("word_id").alias("b"), F.col("word").alias("near")), "b"))
    return pairs.where((F.greatest(F.length("word"), F.length("near")) > depth)
                       & (F.levenshtein("word", "near", 1) == 1)).select("word", "near")


def near_words(words: DataFrame, *, depth: int = DEPTH, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``word, near``: all pairs of the distinct ``word`` that one letter more, less or other
    makes alike, in both directions.

    Words of up to ``depth`` letters go through the trie; pairs with a longer one are found by
    what is left without a letter, so that the number of levels is bounded. A level's states
    are a stored table. A node that has more than a 1,024th of a level's states is joined apart.
    """
    pairs = _trie_pairs(words.where(F.length("word") <= depth), hot_rows).unionByName(
        _long_pairs(words, depth))
    pairs = materialize(pairs, "spelling")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))
                             ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a ``form``, by following twice as many forms each round.

    Counts at least double from a word to its form, so rounds are few.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "spelling")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(roots.join(ahead, "root", "left"), "spelling")
        roots = step.select("word", F.coalesce("further", "root").alias("root"))
        if step.where("further is not null").isEmpty():
            return roots


def spelling_variants(words: DataFrame, *, ratio: int = FORM_RATIO, depth: int = DEPTH,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per distinct ``word`` with its ``n``: ``form, root, n_near, form_n``.

    ``form`` is the near word with the largest ``n``, of equal ones the first by code points, if
    that is at least ``ratio`` times the word's; else null. ``root`` is the last of the forms
    from a word on, and the word itself if it has none. ``n_near`` counts the near words. No
    words give no rows; null words are left out.
    """
    words = materialize(words.select("word", "n").where("word is not null"), "spelling")
    near = near_words(words, depth=depth, hot_rows=hot_rows)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (near.join(counts, "near").groupBy("word")
            .agg(F.count("*").alias("n_near"),
                 F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")))
    form_n = -F.col("best.minus")
    enough = form_n >= F.lit(ratio) * F.col("n")
    named = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, form_n).alias("form_n")),
        "spelling")
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
