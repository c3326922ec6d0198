"""A hashed maximum-entropy language model, trained and applied over chunks of documents.

The probability of a token is that of its class, given hashed features of the tokens before
it, times that of the token within its class. Classes come from global counts and the ends of
words; the first factor is a softmax over all classes with weights trained by distributed
gradient updates; the second comes from the counts. Nothing holds the vocabulary: counts
are added up and looked up bucket by bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.exchange import (
    CHUNK_SCHEMA, CHUNKS, answers, batch_of, bucket_bits, grouped, numbered_slabs, questions,
    totals,
)
from tallywire.llm.shared import Shared
from tallywire.llm.text import SPACES, lower_ascii, mix, text_bytes, word_hashes, word_ranges
from tallywire.storage import materialize

# Fixed value: what is added to a token's count.
SMOOTHING = 0.1
CLASSES = 64
# Rows of weights for each kind of feature: the token before, the one before that (a skip),
# and the classes of both (a pair).
BUCKETS = 4096
KINDS = 3
SHAPES = 16
BINS = 64
BATCH = 4096
RATE = 0.3
ROUNDS = 2
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
# Chunks that one gradient task goes through before weights are averaged.
UNIT_CHUNKS = 4
_BLOCKS = 8
# Units whose changes one task adds up; more are added up level by level.
FAN = 32

_END = np.uint64(0x6A09E667F3BCC909)
_START = np.uint64(0xBB67AE8584CAA73B)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of all texts' tokens (words, then the end), and the texts' offsets.

    A-Z count as lower case. A shape is a number below ``SHAPES`` from a word's last two bytes.
    """
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    begin, end, rows = word_ranges(data, offsets, SPACES)
    words = word_hashes(data, begin, end)
    last = data[end - 1].astype(np.uint64)
    before = np.where(end - begin > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    shapes = mix(before * np.uint64(256) + last) >> np.uint64(64 - int(math.log2(SHAPES)))
    n = len(rows) - 1
    ends = rows[1:] + np.arange(n)
    own = np.ones(len(words) + n, bool)
    own[ends] = False
    hashes, kinds = np.full(len(own), _END), np.zeros(len(own), np.uint8)
    hashes[own], kinds[own] = words, shapes
    return hashes, kinds, rows + np.arange(n + 1)


def cell(count: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Number of the cell of a token by the magnitude of its count and its shape."""
    size = np.minimum(BINS - 1, (2 * np.log2(np.maximum(count, 1))).astype(np.int64))
    return (BINS - 1 - size) * SHAPES + shape


def _cell_sums(total: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Per cell, the occurrences and the number of known tokens."""
    known = total > 0
    cells = cell(total[known], shape[known])
    return np.stack([np.bincount(cells, total[known], BINS * SHAPES),
                     np.bincount(cells, minlength=BINS * SHAPES)])


@dataclass
class Vocabulary:
    """What is known of all tokens together: sums by class, and the class of each cell."""

    n: int
    v: int
    classes: np.ndarray
    class_n: np.ndarray
    class_v: np.ndarray

    @classmethod
    def build(cls, sums: np.ndarray) -> Vocabulary:
        """Cells in order of their counts become classes of about equal mass."""
        mass, kinds = sums
        n = mass.sum()
        middle = (np.cumsum(mass) - mass / 2) / max(1.0, n)
        classes = np.minimum(CLASSES - 1, (middle * CLASSES).astype(np.int64))
        return cls(int(n), int(kinds.sum()), classes, np.bincount(classes, mass, CLASSES),
                   np.bincount(classes, kinds, CLASSES))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + SMOOTHING) / (self.n + SMOOTHING * (self.v + 1)))

    def within(self, count: np.ndarray, own: np.ndarray) -> np.ndarray:
        """log10 of a token's probability in its class, which also has one unknown token."""
        return np.log10((count + SMOOTHING) / (
            self.class_n[own] + SMOOTHING * (self.class_v[own] + 1)))

    def prior(self) -> np.ndarray:
        """Natural log of the classes' shares."""
        share = self.class_n + SMOOTHING * (self.class_v + 1)
        return np.log(share / share.sum()).astype(np.float32)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed plane by plane of their bytes: the upper ones are mostly alike."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.Codec("zstd", compression_level=3).compress(planes.tobytes(), asbytes=True)


def unpack_numbers(packed: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(packed, 4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").ravel().astype(np.int32)


class Coded:
    """A chunk with what the totals say of its tokens."""

    def __init__(self, row: dict, replies: pa.Table, vocabulary: Vocabulary):
        self.ids, self.rows = row["ids"], np.frombuffer(row["offsets"], np.int64)
        self.held = np.frombuffer(row["counts"], bool)
        shape = np.frombuffer(row["lows"], np.uint8)
        self.count, _ = answers(replies, 1, np.uint64)
        own = vocabulary.classes[cell(self.count, shape)].astype(np.int32)
        self.token = unpack_numbers(row["texts"], int(self.rows[-1]))
        self.classes = own[self.token]
        # Before a text there is a start, which has a number and a class of its own.
        numbers = np.append(np.frombuffer(row["keys"], np.uint16), int(_START) % BUCKETS
                            ).astype(np.int32)
        classes = np.append(own, CLASSES)
        one, two = self._before(1, len(own)), self._before(2, len(own))
        pairs = classes[one] * (CLASSES + 1) + classes[two]
        self.features = np.stack([numbers[one], numbers[two] + BUCKETS,
                                  pairs % BUCKETS + 2 * BUCKETS])

    def _before(self, distance: int, start: int) -> np.ndarray:
        """Number of the token ``distance`` places before each, or ``start``."""
        out = np.full(len(self.token), start, np.int32)
        out[distance:] = self.token[:-distance]
        firsts = self.rows[:-1]
        for place in range(distance):
            at = firsts + place
            out[at[at < self.rows[1:]]] = start
        return out


def _log_softmax(weights: np.ndarray, prior: np.ndarray, features: np.ndarray) -> np.ndarray:
    scores = prior + weights[features[0]]
    for kind in range(1, KINDS):
        scores += weights[features[kind]]
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores


def _group_sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of the rows from each head to the next.

    Adds the groups' first rows, then their second ones, and so on: for many small groups of
    short rows that takes a third of the time of ``np.add.reduceat``.
    """
    counts = np.diff(np.append(heads, len(values)))
    sums, place = values[heads], 1
    live = np.flatnonzero(counts > 1)
    while len(live) >= 8:
        sums[live] += values[heads[live] + place]
        place += 1
        live = live[counts[live] > place]
    for group in live.tolist():
        sums[group] += values[heads[group] + place:heads[group] + counts[group]].sum(axis=0)
    return sums


class Trainer:
    """Gradient steps over batches of tokens, each scaled by what its weight has seen so far."""

    def __init__(self, weights: np.ndarray, prior: np.ndarray):
        self.weights, self.prior = weights.copy(), prior
        self.seen = np.ones_like(weights)
        self.touched = np.zeros(len(weights), bool)

    def step(self, features: np.ndarray, classes: np.ndarray) -> None:
        gradient = -np.exp(_log_softmax(self.weights, self.prior, features))
        gradient[np.arange(len(classes)), classes] += 1
        for kind in range(KINDS):
            order = np.argsort(features[kind], kind="stable")
            own = features[kind][order]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            sums, rows = _group_sums(gradient[order], heads), own[heads]
            seen = self.seen[rows] + sums * sums
            self.seen[rows] = seen
            self.weights[rows] += RATE * sums / np.sqrt(seen)
            self.touched[rows] = True

    def chunk(self, coded: Coded) -> None:
        learn = np.flatnonzero(~np.repeat(coded.held, np.diff(coded.rows)))
        for start in range(0, len(learn), BATCH):
            part = learn[start:start + BATCH]
            self.step(coded.features[:, part], coded.classes[part])


def _encoded(docs: DataFrame, bits: int, chunk_bytes: int) -> DataFrame:
    """Chunks as numbers of their distinct tokens, and questions about the tokens' counts."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, batch in numbered_slabs(batches, 2, chunk_bytes):
            hashes, shapes, rows = tokens(batch.column(2))
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            order, firsts, number = grouped(hashes)
            learned = np.repeat(~held, np.diff(rows))
            counts = np.bincount(number[learned], minlength=len(firsts))
            keys, shapes = hashes[order[firsts]], shapes[order[firsts]]
            yield batch_of([
                {"chunk": chunk, "bucket": -1, "ids": batch.column(0).to_pylist(),
                 "offsets": rows.astype(np.int64).tobytes(), "texts": pack_numbers(number),
                 "keys": (keys % np.uint64(BUCKETS)).astype(np.uint16).tobytes(), "counts": held.tobytes(),
                 "lows": shapes.tobytes()},
                *questions(chunk, keys, counts, shapes.astype(np.int64), bits)], CHUNK_SCHEMA)

    return materialize(docs.mapInArrow(encode, CHUNKS), "lm-chunks", compression="zstd")


def _counted(asked: DataFrame) -> DataFrame:
    """Exact counts of the chunks' tokens, and sums by cell of the same counts."""
    return materialize(totals(asked, 1, _cell_sums, np.uint64), "lm-replies", compression="zstd")


def _vocabulary(replies: DataFrame) -> Vocabulary:
    """From the buckets' sums by cell, which Spark adds up; a row for each cell comes here."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for reply in batch.column(0).to_pylist():
                mass, kinds = np.frombuffer(reply, np.float64).reshape(2, -1)
                at = np.flatnonzero(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(mass[at].astype(np.int64)),
                     pa.array(kinds[at].astype(np.int64))], ["cell", "n", "v"])

    rows = (replies.where("chunk = -1").select("reply").mapInArrow(cells, "cell long, n long, v long")
            .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    sums = np.zeros((2, BINS * SHAPES))
    for row in rows:
        sums[:, row["cell"]] = row["n"], row["v"]
    return Vocabulary.build(sums)


CHANGES = "unit long, block int, change binary, touched binary"


def averaged(changes: DataFrame, step: int, units: int, fan: int = FAN) -> DataFrame:
    """Per block of weights, the mean change of each row over the units that met it.

    ``changes`` are of units below ``units``, one of ``step``. They are added up in groups
    of ``fan`` units at most, then the sums of ``fan`` groups, and so on, so what a task
    holds doesn't grow with the input.
    """

    def add(first: bool, last: bool):
        def added(group: pa.Table) -> pa.Table:
            change = met = 0.0
            for row in group.sort_by("unit").to_batches(max_chunksize=1):
                own = np.frombuffer(row.column("change")[0].as_buffer(),
                                    np.float32 if first else np.float64)
                change = change + own.astype(np.float64)
                met = met + np.frombuffer(row.column("touched")[0].as_buffer(),
                                          bool if first else np.float64).astype(np.float64)
            if last:
                mean = change.reshape(len(met), -1) / np.maximum(met, 1)[:, None]
                change = mean.astype(np.float32)
            return pa.table({"unit": group.column("unit").slice(0, 1),
                             "block": group.column("block").slice(0, 1),
                             "change": pa.array([change.tobytes()], pa.binary()),
                             "touched": pa.array([met.tobytes()], pa.binary())})
        return added

    first = True
    while first or units > step:
        step *= fan
        group = F.floor(F.col("unit") / step).alias("group")
        changes = changes.groupBy("block", group).applyInArrow(
            add(first, step >= units), CHANGES)
        first = False
    return changes.select("block", "change")


def _trained(chunks: DataFrame, replies: DataFrame, vocabulary: Vocabulary, rounds: int
             ) -> np.ndarray:
    """Weights after one pass over all training tokens, in ``rounds`` rounds.

    A round's tasks start from the same weights and go through chunks of their own; the
    changes of a row of weights are averaged over the tasks that met the row.
    """
    spark = chunks.sparkSession
    n = chunks.count()
    units = max(rounds, -(-n // UNIT_CHUNKS))
    unit = F.pmod(F.xxhash64("chunk"), F.lit(units)).alias("unit")
    own, said = chunks.select("*", unit), replies.where("chunk >= 0").select("*", unit)
    weights = np.zeros((KINDS * BUCKETS, CLASSES), np.float32)
    for number in range(rounds):
        shared = Shared(spark, (weights, vocabulary))

        def learn(mine: pa.Table, answered: pa.Table) -> pa.Table:
            start, known = shared.value()
            trainer = Trainer(start, known.prior())
            for row in sorted(mine.to_pylist(), key=lambda r: r["chunk"]):
                trainer.chunk(Coded(row, _of_chunk(answered, row["chunk"]), known))
            change = np.split(trainer.weights - start, _BLOCKS)
            touched = np.split(trainer.touched, _BLOCKS)
            return pa.table({
                "unit": pa.array([mine.column("unit")[0].as_py()] * _BLOCKS, pa.int64()),
                "block": pa.array(range(_BLOCKS), pa.int32()),
                "change": pa.array([c.tobytes() for c in change], pa.binary()),
                "touched": pa.array([t.tobytes() for t in touched], pa.binary())})

        turn = F.pmod("unit", F.lit(rounds)) == number
        learned = own.where(turn).groupBy("unit").cogroup(said.where(turn).groupBy("unit"))
        changes = averaged(learned.applyInArrow(learn, CHANGES), rounds, units).collect()
        for row in changes:
            size = len(weights) // _BLOCKS
            weights[row["block"] * size:(row["block"] + 1) * size] += np.frombuffer(
                row["change"], np.float32).reshape(size, CLASSES)
    return weights


def _of_chunk(replies: pa.Table, chunk: int) -> pa.Table:
    import pyarrow.compute as pc

    return replies.filter(pc.equal(replies.column("chunk"), chunk))


_SCORES = ("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def score_documents(docs: DataFrame, held_out, *, id_col: str = "doc_id", text: str = "text",
                    rounds: int = ROUNDS, chunk_bytes: int = CHUNK_BYTES,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: ``n_tokens, n_known, train_tokens, base_score, score`` (log10) and ``held_out``.

    The model learns from the rows where the boolean column ``held_out`` is false, or null.
    Tokens are words split at ASCII white space, with A-Z in lower case, and an end. ``base_score`` is that of a
    smoothed unigram model over all training tokens. Both know one more token than
    those counted, the unknown one; in ``score`` there is one for each class, and a token that
    wasn't counted is that of the class where words of its shape counted once are.
    Null and empty texts are an end alone. Without training rows all tokens are unknown.
    """
    spark, bits = docs.sparkSession, bucket_bits(docs, text, bucket_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(text).cast("string").alias("text"))
    asked = _encoded(rows, bits, chunk_bytes)
    replies = _counted(asked)
    chunks = asked.where("bucket = -1").drop("bucket")
    vocabulary = _vocabulary(replies)
    shared = Shared(spark, (_trained(chunks, replies, vocabulary, rounds), vocabulary))

    def score(mine: pa.Table, said: pa.Table) -> pa.Table:
        weights, known = shared.value()
        prior, out = known.prior(), []
        for row in mine.to_pylist():
            coded = Coded(row, said, known)
            n = len(coded.token)
            own = np.empty(n)
            for start in range(0, n, BATCH):
                part = slice(start, start + BATCH)
                classes = coded.classes[part]
                scores = _log_softmax(weights, prior, coded.features[:, part])
                own[part] = scores[np.arange(len(classes)), classes] / math.log(10)
            count = coded.count[coded.token]
            own += known.within(count, coded.classes)
            heads = coded.rows[:-1]
            out.append(pa.table({
                "id": pa.array(coded.ids, pa.int64()), "held_out": pa.array(coded.held),
                "n_tokens": pa.array(np.diff(coded.rows), pa.int64()),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), heads)),
                "train_tokens": pa.array(np.full(len(heads), known.n), pa.int64()),
                "base_score": pa.array(np.add.reduceat(known.base(count), heads)),
                "score": pa.array(np.add.reduceat(own, heads))}))
        return pa.concat_tables(out)

    return (chunks.groupBy("chunk").cogroup(replies.where("chunk >= 0").groupBy("chunk"))
            .applyInArrow(score, _SCORES))
