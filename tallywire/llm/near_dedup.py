"""Near-duplicate documents by MinHash bands, odd sketches and full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.components import components
from tallywire.llm.text import (
    SPACES, RangeHash, list_column, lower_ascii, mix, slabs, text_bytes, word_hashes, word_ranges,
)
from tallywire.storage import materialize

WORDS = 5
PERCENT = 80
# Bands of rows. A pair that shares 80 % of its shingles has no common band with a
# probability of 5e-8, one that shares 85 % with 6e-11.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
# How far below the threshold an estimate may lie for the pair to be compared in full:
# at the threshold the estimate falls so low in less than one of 10^7 pairs.
SLACK = 0.2
# Documents of a cluster that one task compares with one another, or with as many others.
BLOCK = 256
# Documents of a band whose sketches one task compares with one another, or with as many others.
BAND_BLOCK = 2048
_COLUMNS = 1 << 14


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their offsets."""
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    begin, end, rows = word_ranges(data, offsets, SPACES)
    words = word_hashes(data, begin, end)
    counts = np.diff(rows)
    of = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words))
    # Of a text with fewer words, the first word stands for the whole sequence.
    stop = np.minimum(place + size, rows[1:][of])
    whole = (stop - place == size) | ((place == rows[:-1][of]) & (counts[of] < size))
    hashes, of = RangeHash(words).of(place[whole], stop[whole]), of[whole]
    order = np.argsort(hashes)
    small = of.astype(np.int16) if len(counts) < 1 << 15 else of
    order = order[np.argsort(small[order], kind="stable")]
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(counts) + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each non-empty set: node (hash of the set), band keys, odd sketch.

    A sample is the set's least value under one of ``SAMPLES`` permutations. The sketch is a
    bitmap in which every (permutation, sample) flips one bit, so that the bits in which
    two sketches differ tell how many samples do.
    """
    starts = offsets[:-1][np.diff(offsets) > 0]
    node = mix(np.add.reduceat(mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)), starts))
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    random = np.random.default_rng(9)
    factors = random.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
    samples = np.empty((len(starts), SAMPLES), np.uint64)
    for i in range(SAMPLES):
        samples[:, i] = np.minimum.reduceat(small * factors[i] + shifts[i], starts)
    samples = mix(samples + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    bands = np.zeros((len(starts), BANDS), np.uint64)
    for row in range(ROWS):
        bands = mix(bands + samples[:, row::ROWS])
    bits = np.zeros((len(starts), SKETCH_BITS), np.uint8)
    place = np.arange(len(starts))
    for i in range(SAMPLES):
        bits[place, (samples[:, i] % SKETCH_BITS).astype(np.int64)] ^= 1
    return node, bands, np.packbits(bits, axis=1)


def estimate(different):
    """Share of equal samples, from the number of bits in which two odd sketches differ."""
    share = F.least(2.0 * different / SKETCH_BITS, F.lit(0.999))
    return 1.0 + SKETCH_BITS / (4.0 * SAMPLES) * F.log1p(-share)


_SKETCHES = "key long, id long, n long, node long, bands array<long>, sketch array<long>"


def _sketched(rows: DataFrame, size: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, 2):
            hashes, offsets = shingles(batch.column(2), size)
            counts = np.diff(offsets)
            full = counts > 0
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64())]
            if full.any():
                node, bands, sketches = signatures(hashes, offsets)
                at = np.full(len(full), -1)
                at[full] = np.arange(full.sum())
                where = pa.array(at, mask=~full)
                columns += [
                    pa.array(node.view(np.int64)).take(where),
                    list_column(bands.view(np.int64).ravel(),
                                np.arange(len(node) + 1) * BANDS).take(where),
                    list_column(sketches.view(np.int64).ravel(),
                                np.arange(len(node) + 1) * (SKETCH_BITS // 64)).take(where)]
            else:
                n = batch.num_rows
                columns += [pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.list_(pa.int64()))] * 2]
            yield pa.RecordBatch.from_arrays(
                columns, ["key", "id", "n", "node", "bands", "sketch"])

    return rows.mapInArrow(sketch, _SKETCHES)


def _shared_bands(nodes: DataFrame) -> DataFrame:
    """Nodes by the bands that two or more share: ``band, node, n, pivot`` (the least node)."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    least = rows.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("n"))
    return materialize(rows.join(least.where("n > 1"), "band"), "near-bands")


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches do not rule them out."""
    own = nodes.select("node", F.col("sketch").alias("own"))
    other = nodes.select(F.col("node").alias("pivot"), F.col("sketch").alias("other"))
    different = F.aggregate(
        F.zip_with("own", "other", lambda a, b: F.bit_count(a.bitwiseXOR(b))),
        F.lit(0), lambda total, bits: total + bits)
    return (pairs.join(own, "node").join(other, "pivot")
            .where(estimate(different) >= percent / 100 - SLACK).select("node", "pivot"))


def _most_different(percent: int) -> int:
    """Most bits in which two sketches may differ that ``_alike`` doesn't rule out."""
    share = np.minimum(2.0 * np.arange(SKETCH_BITS + 1) / SKETCH_BITS, 0.999)
    near = 1.0 + SKETCH_BITS / (4.0 * SAMPLES) * np.log1p(-share) >= percent / 100 - SLACK
    return int(np.flatnonzero(near).max())


def across(sketches: np.ndarray, labels: np.ndarray, first: int, most: int
           ) -> Iterator[tuple[int, int]]:
    """Pairs of labels that suffice to connect those whose sketches differ in ``most`` bits or less.

    With ``first`` > 0 only the first so many are compared, each with all others.
    """
    group = labels.copy()
    for row in range(first or len(sketches)):
        start = first or row + 1
        apart = np.flatnonzero(group[start:] != group[row]) + start
        different = np.bitwise_count(sketches[apart] ^ sketches[row]).sum(axis=1, dtype=np.int64)
        for label in np.unique(group[apart[different <= most]]).tolist():
            yield int(group[row]), label
            group[group == label] = group[row]


def _met_in_bands(bands: DataFrame, clusters: DataFrame, nodes: DataFrame, percent: int,
                  block: int) -> DataFrame:
    """Pairs of clusters with alike nodes in a band, for bands whose nodes are not in one cluster.

    Every two nodes of such a band are compared by their sketches, unless one cluster holds
    both. A band of more than ``block`` nodes is dealt into blocks, and each pair of blocks is
    a unit of its own.
    """
    rows = (bands.where("n > 2").select("band", "node", "n").join(clusters, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))
    several = rows.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    blocks = F.ceil(F.col("n") / block).cast("int")
    units = (rows.join(several.where("a <> b").select("band"), "band")
             .withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .join(nodes.select("node", "sketch"), "node")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"), "block", "label", "sketch"))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = _most_different(percent)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(unit: tuple, held: list) -> pa.RecordBatch:
            numbers, labels, sketches = (np.concatenate(part) for part in zip(*held))
            first = int((numbers == unit[1]).sum()) if unit[1] != unit[2] else 0
            pairs = []
            if unit[1] == unit[2] or 0 < first < len(labels):
                pairs = list(across(sketches, labels, first, most))
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in pairs], pa.int64()),
                 pa.array([y for _, y in pairs], pa.int64())], ["a", "b"])

        unit, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            band, low, high, number, label = (c.to_numpy() for c in batch.columns[:5])
            sketch = batch.column(5).flatten().to_numpy().view(np.uint64).reshape(
                -1, SKETCH_BITS // 64)
            new = (band[1:] != band[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            heads = [0, *(np.flatnonzero(new) + 1).tolist(), len(band)]
            for start, stop in zip(heads, heads[1:]):
                here = (band[start], low[start], high[start])
                if here != unit:
                    if held:
                        yield found(unit, held)
                    unit, held = here, []
                held.append((number[start:stop].copy(), label[start:stop].copy(),
                             sketch[start:stop].copy()))
        if held:
            yield found(unit, held)

    dealt = units.repartition(parts, "band", "low", "high").sortWithinPartitions(
        "band", "low", "high", "block")
    return dealt.mapInArrow(meet, "a long, b long")


def _clusters(nodes: DataFrame, percent: int, block: int) -> DataFrame:
    """Clusters of nodes that share a band and whose sketches don't rule them out.

    The nodes of a band are compared with its pivot first, which connects most of what is
    alike; then with one another, where that leaves them in several clusters.
    """
    bands = _shared_bands(nodes)
    pairs = bands.where("node <> pivot").select("node", "pivot").distinct()
    near = components(materialize(_alike(pairs, nodes, percent), "near-pairs"), "node", "pivot")
    met = materialize(_met_in_bands(bands, near, nodes, percent, block), "near-met")
    joined = components(met, "a", "b").select(F.col("node").alias("label"),
                                              F.col("label").alias("whole"))
    # A node without a cluster may have been met as one of its own.
    alone = joined.select(F.col("label").alias("node"), "label").join(near, "node", "left_anti")
    return (near.unionByName(alone).join(joined, "label", "left")
            .select("node", F.coalesce("whole", "label").alias("label")))


def linked(sets: list[np.ndarray], first: int, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs that suffice to connect all links among ``sets``.

    With ``first`` > 0 only links between the first so many and the others count. Sizes of
    all intersections come from products of 0/1 matrices over slices of the shingles that
    occur in two sets at least.
    """
    left = range(first) if first else range(len(sets))
    right = range(first, len(sets)) if first else left
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, of = values[order], of[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    heads = np.flatnonzero(new)
    shared = np.diff(np.append(heads, len(values))) > 1
    number = np.cumsum(new) - 1
    keep = shared[number]
    number, of = (np.cumsum(shared) - 1)[number[keep]], of[keep]
    common = np.zeros((len(left), len(right)))
    for start in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(number, [start, start + _COLUMNS])
        table = np.zeros((len(sets), _COLUMNS), np.float32)
        table[of[a:b], number[a:b] - start] = 1
        common += table[left.start:left.stop] @ table[right.start:right.stop].T
    union = sizes[left.start:left.stop, None] + sizes[None, right.start:right.stop] - common
    i, j = np.nonzero(100 * common >= percent * union)
    group = list(range(len(sets)))

    def root(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for x, y in zip((i + left.start).tolist(), (j + right.start).tolist()):
        a, b = root(x), root(y)
        if a != b:
            group[b] = a
            yield x, y


def _confirmed(clusters: DataFrame, nodes: DataFrame, rows: DataFrame, size: int, percent: int,
               block: int) -> DataFrame:
    """Links on full sets among the documents of each cluster, as connecting pairs.

    A cluster of more than ``block`` documents is dealt into blocks, and each pair of blocks
    is a unit of its own, so no task holds more than two blocks of texts.
    """
    sizes = clusters.groupBy("label").agg(F.count("*").alias("n")).select(
        "label", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    members = (clusters.join(sizes, "label")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
               .join(nodes.select("node", "key"), "node"))
    units = (members.join(rows.select("key", "text"), "key")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"), "block", "node", "text"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(unit: tuple, held: dict) -> pa.RecordBatch:
            own = sorted(held.items(), key=lambda item: (item[1][0], item[0]))
            first = sum(b == unit[1] for _, (b, _) in own) if unit[1] != unit[2] else 0
            pairs = []
            if len(own) > 1 and (unit[1] == unit[2] or 0 < first < len(own)):
                pairs = list(linked([s for _, (_, s) in own], first, percent))
            names = [node for node, _ in own]
            return pa.RecordBatch.from_arrays(
                [pa.array([names[x] for x, _ in pairs], pa.int64()),
                 pa.array([names[y] for _, y in pairs], pa.int64())], ["a", "b"])

        unit, held = None, {}
        for batch in slabs(batches, 5):
            hashes, offsets = shingles(batch.column(5), size)
            columns = [c.to_pylist() for c in batch.columns[:5]]
            for row, (label, low, high, number, node) in enumerate(zip(*columns)):
                if (label, low, high) != unit:
                    if held:
                        yield found(unit, held)
                    unit, held = (label, low, high), {}
                # Copies of a text have one set.
                held[node] = (number, hashes[offsets[row]:offsets[row + 1]].copy())
        if held:
            yield found(unit, held)

    dealt = units.repartition(parts, "label", "low", "high").sortWithinPartitions(
        "label", "low", "high")
    return dealt.mapInArrow(links, "a long, b long")


def near_duplicate_groups(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                          words: int = WORDS, percent: int = PERCENT, block: int = BLOCK,
                          band_block: int = BAND_BLOCK) -> DataFrame:
    """Per row: ``key``, ``id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if their sets of distinct shingles of ``words`` words (A-Z in lower
    case, split at ASCII white space) share at least ``percent`` per cent of their union; a
    text of fewer words has its whole sequence as one shingle. ``component_id`` is the least
    id that can be reached over links, and the row with it is kept; a null id is larger than
    all others. Null texts and texts without words are linked with nothing. Documents with
    one set are one node until the end, so copies are never compared. ``key`` is a hash of
    id and text; rows that repeat both are one document, and stay or go together.
    """
    rows = docs.select(F.xxhash64(id_col, text).alias("key"),
                       F.col(id_col).cast("long").alias("id"),
                       F.col(text).cast("string").alias("text"))
    sketched = materialize(_sketched(rows, words), "near-sketches")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    full = sketched.where("node is not null")
    nodes = materialize(
        full.groupBy("node").agg(F.min(order).alias("low"), F.first("bands").alias("bands"),
                                 F.first("sketch").alias("sketch"))
        .withColumn("key", F.col("low.key")), "near-nodes")
    clusters = _clusters(nodes, percent, band_block)
    links = materialize(_confirmed(clusters, nodes, rows, words, percent, block), "near-links")
    labels = components(links, "a", "b")
    lows = (nodes.select("node", "low").join(labels, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))
    least = lows.groupBy("label").agg(F.min("low").alias("least"))
    least = lows.select("node", "label").join(least, "label").select("node", "least")
    return (sketched.select("key", "id", F.col("n").alias("n_shingles"), "node")
            .join(least, "node", "left")
            .select("key", "id", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least.id"))
                    .alias("component_id"),
                    (F.col("node").isNull() | (F.col("least.key") == F.col("key"))).alias("kept")))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                         words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one of each group, with all their columns."""
    groups = near_duplicate_groups(docs, id_col=id_col, text=text, words=words, percent=percent)
    gone = groups.where("not kept").select(F.col("key").alias("_gone")).distinct()
    return docs.join(gone, F.xxhash64(docs[id_col], docs[text]) == gone["_gone"], "left_anti")
