"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.shared import Shared
from tallywire.llm.text import (
    NOT_PLAIN, RangeHash, byte_values, in_slabs, list_column, lower_ascii, mix, slabs, text_bytes,
    word_ranges,
)

THRESHOLD = 0.7
# Labelled rows the grammar is fitted to, those with the smallest hashes of their ids.
FIT_ROWS = 20_000
# Leading bytes of a word that can be learned as a stem, beside the whole word.
STEMS = (4, 5)

# Word classes of the grammar's input tape.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Words whose class is known beforehand.
KNOWN = {
    INSULT: "clown disgusting dumb filth fool idiot imbecile jerk loser moron pathetic scum "
            "stupid trash vermin worthless",
    THREAT: "beat burn crush destroy hang hurt kill punish shoot smash stab",
    TARGET: "you your yourself he him she her they them these those people everyone du ihr sie "
            "vous toi ils elles usted ustedes ellos ellas",
    NEGATION: "not no never none nor isn aren wasn weren don doesn didn nicht kein keine nie pas "
              "jamais nunca jamás tampoco",
    REPORT: "said says wrote writes reported quoted claimed claims called according sagte schrieb "
            "dit écrit dijo escribió",
}
CLAUSE_ENDS = b".!?;:,\n"

KNOWN_INSULT = 3.0
KNOWN_THREAT = 2.0
NEGATED = 0.7
REPORTED = 0.7
AIMED = 1.5
# Words over which a negation, a target or a threat's verb still counts.
REACH = 3


def counter(opens: int):
    """Transducer that counts down from ``REACH`` after a word of class ``opens``."""
    return [[REACH if cls == opens else max(0, state - 1) for cls in range(6)]
            for state in range(REACH + 1)]


def latch(opens: int):
    """Transducer that stays on from a word of class ``opens`` to the end of the clause."""
    return [[int(state or cls == opens) for cls in range(6)] for state in range(2)]


def compose() -> tuple[np.ndarray, np.ndarray]:
    """The product of the transducers: next state and output weight by (state, class).

    Negation, report, target and threat run side by side over the classes of the words;
    the output of a word in a state says by how much its own weight counts there: insults
    always, more if aimed at someone, less if negated or reported; a target completes a
    threat whose verb is near.
    """
    parts = [counter(NEGATION), latch(REPORT), counter(TARGET), counter(THREAT)]
    states = list(product(*(range(len(part)) for part in parts)))
    number = {state: i for i, state in enumerate(states)}
    following = np.zeros((len(states), 6), np.int64)
    weight = np.zeros((len(states), 6))
    for state, i in number.items():
        negated, reported, aimed, threat = state
        scale = (NEGATED if negated else 1.0) * (REPORTED if reported else 1.0)
        weight[i, INSULT] = scale * (AIMED if aimed else 1.0)
        weight[i, TARGET] = scale * KNOWN_THREAT if threat else 0.0
        for cls in range(6):
            following[i, cls] = number[tuple(part[s][cls] for part, s in zip(parts, state))]
    return following, weight


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of words and of their stems (0 where a word is no longer than the stem)."""
    ranges = RangeHash(byte_values(data))
    found = [ranges.of(starts, ends)]
    for size in STEMS:
        long = ends - starts > size
        stem = np.zeros(len(starts), np.uint64)
        stem[long] = mix(ranges.of(starts[long], starts[long] + size) + np.uint64(size))
        found.append(stem)
    return found


@dataclass
class Grammar:
    """Lexicon (sorted feature hashes, classes, weights), transducer and output scale."""

    hashes: np.ndarray
    classes: np.ndarray
    weights: np.ndarray
    scale: tuple[float, float, float]

    def __post_init__(self):
        self.following, self.factor = (table.tolist() for table in compose())

    def _lookup(self, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Class and weight of every word; the whole word goes before longer, then shorter stems."""
        cls = np.zeros(len(features[0]), np.int64)
        weight = np.zeros(len(cls))
        for feature in [features[0], *features[:0:-1]]:
            at = np.searchsorted(self.hashes, feature)
            at[at == len(self.hashes)] = 0
            new = (self.hashes[at] == feature) & (cls == OTHER)
            cls[new], weight[new] = self.classes[at[new]], self.weights[at[new]]
        return cls, weight

    def _clause(self, at: list[int], cls: list[int], weight: list[float]) -> float:
        state, total, last = 0, 0.0, at[0] - 1
        for place, c, w in zip(at, cls, weight):
            for _ in range(min(place - last - 1, REACH)):
                state = self.following[state][OTHER]
            factor = self.factor[state][c]
            total += factor * w if c == INSULT else factor
            state, last = self.following[state][c], place
        return total

    def clauses(self, column: pa.Array):
        """Per matched clause: row, first byte, end byte, weight."""
        data, offsets = text_bytes(column)
        data = lower_ascii(data)
        starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
        cls, weight = self._lookup(_features(data, starts, ends))
        stops = np.zeros(256, bool)
        stops[list(CLAUSE_ENDS)] = True
        clause = np.cumsum(stops[data])[starts] if len(data) else starts
        row = np.repeat(np.arange(len(column)), np.diff(rows))
        new = np.ones(len(starts), bool)
        new[1:] = (clause[1:] != clause[:-1]) | (row[1:] != row[:-1])
        clause = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(starts)) - 1
        hit = np.unique(clause[(cls == INSULT) | (cls == THREAT)])
        marked = np.flatnonzero(cls)
        begin = np.searchsorted(marked, firsts[hit])
        end = np.searchsorted(marked, lasts[hit], "right")
        for number, b, e in zip(hit.tolist(), begin.tolist(), end.tolist()):
            at = marked[b:e]
            total = self._clause(at.tolist(), cls[at].tolist(), weight[at].tolist())
            if total > 0:
                first, last = firsts[number], lasts[number]
                own = row[first]
                yield own, starts[first] - offsets[own], ends[last] - offsets[own], total

    def scores(self, top: np.ndarray, total: np.ndarray) -> np.ndarray:
        bias, by_top, by_total = self.scale
        return 1 / (1 + np.exp(-(bias + by_top * top + by_total * np.log1p(total))))

    def match(self, column: pa.Array) -> pa.StructArray:
        found = list(self.clauses(column))
        row, first, end, weight = (np.array(c) for c in zip(*found)) if found else [np.zeros(0)] * 4
        row = row.astype(np.int64)
        top, total = np.zeros(len(column)), np.zeros(len(column))
        np.maximum.at(top, row, weight)
        np.add.at(total, row, weight)
        spans = pa.StructArray.from_arrays(
            [pa.array(first, pa.int64()), pa.array(end, pa.int64()), pa.array(weight, pa.float64())],
            ["first_byte", "end_byte", "weight"])
        borders = np.searchsorted(row, np.arange(len(column) + 1))
        return pa.StructArray.from_arrays(
            [pa.array(self.scores(top, total)), pa.array(top), pa.array(total),
             list_column(spans, borders)], ["score", "top", "total", "clauses"])


_MATCH = ("struct<score: double, top: double, total: double, "
          "clauses: array<struct<first_byte: bigint, end_byte: bigint, weight: double>>>")


def _known() -> dict[int, tuple[int, float]]:
    lexicon = {}
    for cls, words in KNOWN.items():
        data, offsets = text_bytes(pa.array([words.lower()]))
        starts, ends, _ = word_ranges(data, offsets, NOT_PLAIN)
        weight = KNOWN_INSULT if cls == INSULT else 0.0
        for h in _features(data, starts, ends)[0].tolist():
            lexicon[h] = (cls, weight)
    return lexicon


def _grammar(lexicon: dict[int, tuple[int, float]], scale) -> Grammar:
    hashes = np.array(sorted(lexicon), np.uint64)
    return Grammar(hashes, np.array([lexicon[h][0] for h in hashes.tolist()], np.int64),
                   np.array([lexicon[h][1] for h in hashes.tolist()]), scale)


# Scale of a grammar that has seen no labels of both kinds.
UNFITTED = (-4.0, 1.5, 1.0)
# How strongly a fit is drawn to it.
PULL = 2.0


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (feature, previous word) pairs of each slab of texts."""
    for batch in slabs(batches, 0):
        data, offsets = text_bytes(batch.column(0))
        data = lower_ascii(data)
        starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
        if not len(starts):
            continue
        features = _features(data, starts, ends)
        before = np.append(np.uint64(0), features[0][:-1])
        before[rows[:-1][rows[:-1] < len(before)]] = 0
        values = np.concatenate(features)
        pairs = np.stack([values, mix(values ^ mix(np.tile(before, len(features))))], 1)
        pairs = np.unique(pairs[values != 0], axis=0).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                         ["feature", "context"])


def _document_counts(candidates):
    """Number of texts, in a task, that hold each candidate."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = candidates.value
        counts = np.zeros(len(wanted), np.int64)
        for batch in slabs(batches, 0):
            data, offsets = text_bytes(batch.column(0))
            data = lower_ascii(data)
            starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            for feature in _features(data, starts, ends) if len(wanted) else ():
                at = np.searchsorted(wanted, feature)
                at[at == len(wanted)] = 0
                hit = wanted[at] == feature
                both = np.unique(at[hit] * np.int64(len(rows)) + row[hit]) // len(rows)
                counts += np.bincount(both, minlength=len(wanted))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(wanted[found].astype(np.int64)), pa.array(counts[found])],
            ["feature", "texts"])
    return count


def _learned(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int
             ) -> dict[int, tuple[int, float]]:
    """Words and stems that occur in toxic texts far more than chance would have it.

    A feature counts once per text, but in toxic ones no more often than it follows
    different words, so that copies of a text, where it always follows the same one, are
    no evidence for the text's own words. It is taken if the excess is more improbable than one
    among all candidates would be by chance (a bound of Chernoff's on the share).
    """
    spark = toxic.sparkSession
    candidates = (toxic.mapInArrow(_contexts, "feature long, context long")
                  .groupBy("feature").agg(F.countDistinct("context").alias("toxic"))
                  .where("toxic >= 3").toArrow())
    features = candidates.column("feature").to_numpy().view(np.uint64)
    order = np.argsort(features)
    features, seen = features[order], candidates.column("toxic").to_numpy()[order]
    shared = spark.sparkContext.broadcast(features)

    def texts_with(texts: DataFrame) -> np.ndarray:
        rows = (texts.mapInArrow(_document_counts(shared), "feature long, texts long")
                .groupBy("feature").agg(F.sum("texts").alias("texts")).toArrow())
        counts = np.zeros(len(features))
        at = np.searchsorted(features, rows.column("feature").to_numpy().view(np.uint64))
        counts[at] = rows.column("texts").to_numpy()
        return counts

    seen, counts = np.minimum(seen, texts_with(toxic)), texts_with(clean)
    prior = n_toxic / (n_toxic + n_clean)
    n = seen + counts
    share = np.clip(seen / n, 1e-9, 1 - 1e-9)
    excess = n * (share * np.log(share / prior) + (1 - share) * np.log((1 - share) / (1 - prior)))
    odds = np.log((seen + 0.5) / (n_toxic + 1)) - np.log((counts + 0.5) / (n_clean + 1))
    taken = (share > prior) & (excess >= math.log(max(1, len(features))) + 3) & (odds >= 2)
    return {int(h): (INSULT, float(min(w, 2 * KNOWN_INSULT)))
            for h, w in zip(features[taken], odds[taken])}


def _scaled(top: np.ndarray, total: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on the two sums, by Newton's method.

    Drawn towards ``UNFITTED``, so that few or noisy labels do not undo the known words.
    """
    x = np.stack([np.ones(len(top)), top, np.log1p(total)], 1)
    start = np.array(UNFITTED)
    w, ridge = start.copy(), np.diag([PULL] * 3)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - label * z) + (w - start) @ ridge @ (w - start) / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - label) + ridge @ (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        while loss(w - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit_grammar(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
                text: str = "text", label: str = "toxic", rows: int = FIT_ROWS) -> Grammar:
    """Lexicon weights and output scale from labelled documents.

    Only ids and ``label`` of ``labels`` and texts of ``docs`` are used. At most ``rows``
    labelled ids, those with the smallest hashes, are looked at; their list is what is
    broadcast. Rows with a null id or label are no labels; an id with both labels is toxic.
    Without toxic or without clean texts the known words and ``UNFITTED`` remain.
    """
    spark = docs.sparkSession
    chosen = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
              .where("_id is not null and _label is not null")
              .groupBy("_id").agg(F.max("_label").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
             .join(F.broadcast(chosen), "_id").select("_text", "_label"))
    texts = texts.persist()
    try:
        n = {row["_label"]: row["n"] for row in
             texts.groupBy("_label").agg(F.count("*").alias("n")).collect()}
        lexicon = _known()
        if not n.get(1) or not n.get(0):
            return _grammar(lexicon, UNFITTED)
        toxic, clean = (texts.where(F.col("_label") == v).select("_text") for v in (1, 0))
        for feature, entry in _learned(toxic, clean, n[1], n[0]).items():
            if lexicon.get(feature, (INSULT, 0.0))[0] == INSULT:
                lexicon[feature] = max(entry, lexicon.get(feature, entry))
        unscaled = _grammar(lexicon, UNFITTED)
        sums = score_toxicity(texts, unscaled, text="_text", into="_m").select(
            F.col("_m.top").alias("top"), F.col("_m.total").alias("total"), "_label").toArrow()
        return _grammar(lexicon, _scaled(*(sums.column(c).to_numpy().astype(float)
                                           for c in ("top", "total", "_label"))))
    finally:
        texts.unpersist()


def score_toxicity(docs: DataFrame, grammar: Grammar, *, text: str = "text",
                   into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``into``: score from 0 to 1, and the matched clauses with weights.

    A score looks at the text only. Null and empty texts, and texts without a match, have
    the score of no evidence. An existing column named ``into`` is replaced.
    """
    shared = Shared(docs.sparkSession, grammar)

    def match(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value()
        for column in columns:
            yield in_slabs(own.match, column)

    found = F.arrow_udf(match, _MATCH).asNondeterministic()
    return docs.withColumn(into, found(F.col(text).cast("string")))


def drop_toxic(docs: DataFrame, grammar: Grammar, *, text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score below ``threshold``; same columns."""
    name = "_toxicity"
    while name in docs.columns:
        name = f"_{name}"
    scored = score_toxicity(docs, grammar, text=text, into=name)
    return scored.where(F.col(name)["score"] < threshold).select(*docs.columns)
