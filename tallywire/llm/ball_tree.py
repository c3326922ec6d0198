"""Ranked lexical search by exact inner products over ball trees of sparse documents.

A document is a sparse vector of integers, one for each of its terms that a query has; a query
is a vector of integer weights. Tasks gather documents into trees of balls: a ball has a centroid and
a radius that holds all its documents, so a query's product with any of them is at most its
product with the centroid plus its own length times the radius. Balls are visited best first, and
a subtree whose bound, rounded up, is below the least of the best scores so far is left
out. Scores at the leaves are exact 64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywire.llm.shared import Shared
from tallywire.llm.text import NOT_PLAIN, lower_ascii, slabs, text_bytes, word_hashes, word_ranges
from tallywire.storage import materialize

MOST = 10
LEAF = 32
# Item text of one pass over the documents; terms and items of one tree's queries.
ROUND_BYTES = 4 << 20
BLOCK_TERMS = 1 << 15
BLOCK_ITEMS = 1 << 10
# Numbers in the centroids of one tree, and documents in it.
_TREE_NUMBERS = 1 << 21
_MOST_LEAVES = 256
# Documents that one task searches: at least so many, and so many where there are enough.
_TASK_DOCS = 8192, 262_144
# More than the rounding errors of a product of BLOCK_TERMS non-negative doubles.
_SLACK = 1e-9


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that occurs ``tf`` times in a document of ``n`` terms counts, before weights."""
    sizes, of = np.unique(n, return_inverse=True)
    lengths = np.array([25 + 75 * int(size) * n_docs // n_terms for size in sizes], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * lengths[of])


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' terms, and the rows' offsets."""
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    starts, ends, rows = word_ranges(data, offsets, NOT_PLAIN)
    return word_hashes(data, starts, ends), rows


@dataclass
class Query:
    """An item: its terms' numbers in ascending order, and how often it has each."""

    terms: np.ndarray
    times: np.ndarray


class Queries:
    """The items of a round: their distinct terms, and blocks of items that share a tree."""

    def __init__(self, texts: pa.Array, block_terms: int, block_items: int):
        hashes, rows = _terms(texts)
        self.terms = np.unique(hashes)
        numbers = np.searchsorted(self.terms, hashes)
        self.items = [Query(*np.unique(numbers[first:end], return_counts=True))
                      for first, end in zip(rows[:-1], rows[1:])]
        # (distinct terms, numbers of the items) of each block.
        self.blocks: list[tuple[np.ndarray, list[int]]] = []
        known: set[int] = set()
        own: list[int] = []
        for number, item in enumerate(self.items):
            more = known.union(item.terms.tolist())
            if own and (len(more) > block_terms or len(own) == block_items):
                self._close(known, own)
                more, own = set(item.terms.tolist()), []
            known = more
            own.append(number)
        if own:
            self._close(known, own)

    def _close(self, known: set[int], own: list[int]) -> None:
        self.blocks.append((np.array(sorted(known), np.int64), own))


class Matrix:
    """Rows of sparse vectors: term numbers and values end to end. No row is empty."""

    def __init__(self, heads: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.heads, self.terms, self.values = heads, terms, values

    def __len__(self) -> int:
        return len(self.heads) - 1

    def rows(self, chosen: np.ndarray) -> Matrix:
        size = np.diff(self.heads)[chosen]
        heads = np.append(0, np.cumsum(size))
        at = np.repeat(self.heads[chosen] - heads[:-1], size) + np.arange(heads[-1])
        return Matrix(heads, self.terms[at], self.values[at])

    def times(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(dense[self.terms] * self.values, self.heads[:-1])

    def columns(self, chosen: np.ndarray, width: int) -> tuple[np.ndarray, Matrix]:
        """Rows with any of the chosen ascending terms, which are numbered anew, and their places."""
        place = np.full(width, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        terms = place[self.terms]
        kept = terms >= 0
        of = np.repeat(np.arange(len(self)), np.diff(self.heads))[kept]
        rows, size = np.unique(of, return_counts=True)
        return rows, Matrix(np.append(0, np.cumsum(size)), terms[kept], self.values[kept])


class BallTree:
    """Balls over documents whose vectors are scaled by the terms' weights.

    Scaling leaves products with a query as they are, if the query's are divided by the
    same. It makes frequent terms, which most documents differ in, count little in a radius.
    """

    def __init__(self, documents: Matrix, weights: np.ndarray, leaf: int = LEAF):
        scaled = Matrix(documents.heads, documents.terms,
                        documents.values * weights[documents.terms].astype(np.float64))
        self.width, self.leaf = len(weights), leaf
        self.first, self.end, self.children = [], [], []
        self._centroids, self._radii = [], []
        order: list[np.ndarray] = []
        self._split(scaled, np.arange(len(documents)), order)
        self.order = np.concatenate(order)
        self.documents = documents.rows(self.order)
        self.centroids = np.stack(self._centroids, axis=1)
        self.radii = np.array(self._radii)
        self.sizes = np.array(self.end) - np.array(self.first)
        self.read = 0

    def _split(self, rows: Matrix, ids: np.ndarray, order: list[np.ndarray]) -> int:
        """Add the ball of these rows and those within it; its number. Halves are equal, so the
        depth is bounded, also among copies."""
        node, n = len(self.first), len(rows)
        placed = sum(map(len, order))
        self.first.append(placed)
        self.end.append(placed + n)
        centroid = np.bincount(rows.terms, rows.values, self.width) / n
        square = np.add.reduceat(rows.values * rows.values, rows.heads[:-1])
        far = square - 2 * rows.times(centroid) + centroid @ centroid
        # The difference may lose digits where the squares are large beside it.
        slack = _SLACK * (float(square.max()) + float(centroid @ centroid))
        self._centroids.append(centroid)
        self._radii.append(math.sqrt(max(0.0, float(far.max())) + slack) * (1 + _SLACK))
        self.children.append(())
        if n <= self.leaf:
            order.append(ids)
            return node
        one = self._dense(rows, int(far.argmax()))
        apart = square - 2 * rows.times(one)
        other = self._dense(rows, int(apart.argmax()))
        side = np.argsort(rows.times(other - one), kind="stable")
        halves = np.sort(side[:n // 2]), np.sort(side[n // 2:])
        self.children[node] = tuple(self._split(rows.rows(half), ids[half], order) for half in halves)
        return node

    def _dense(self, rows: Matrix, row: int) -> np.ndarray:
        part = slice(rows.heads[row], rows.heads[row + 1])
        return np.bincount(rows.terms[part], rows.values[part], self.width)

    def bounds(self, query: Query) -> np.ndarray:
        """For each ball, no less than any of its documents' scores.

        All numbers are non-negative, so a score is also no more than the sum of all in the ball.
        """
        times = query.times.astype(np.float64)
        middle = times @ self.centroids[query.terms]
        length = math.sqrt(float(times @ times)) * (1 + _SLACK)
        return np.minimum(middle + length * self.radii, middle * self.sizes) * (1 + _SLACK)

    def search(self, query: Query, weights: np.ndarray, best: Best) -> None:
        """Offer every document to ``best`` that may be one of its best."""
        bounds = self.bounds(query)
        dense = np.zeros(self.width, np.int64)
        dense[query.terms] = weights[query.terms] * query.times
        open_ = [(-float(bounds[0]), 0)]
        while open_ and -open_[0][0] >= best.least:
            bound, node = heapq.heappop(open_)
            for child in self.children[node]:
                if (limit := min(-bound, float(bounds[child]))) >= best.least:
                    heapq.heappush(open_, (-limit, child))
            if not self.children[node]:
                first, end = self.first[node], self.end[node]
                heads = self.documents.heads[first:end + 1]
                part = slice(heads[0], heads[-1])
                scores = np.add.reduceat(
                    dense[self.documents.terms[part]] * self.documents.values[part], heads[:-1] - heads[0])
                self.read += end - first
                for at in np.flatnonzero(scores >= best.least).tolist():
                    best.offer(int(scores[at]), int(self.order[first + at]))


class Best:
    """The best (score, document) pairs: by score, then by id, null ids last."""

    def __init__(self, most: int):
        self.most, self.found, self.least = most, [], 1
        self.names: list = []

    def offer(self, score: int, row: int) -> None:
        name = self.names[row]
        self.found.append((-score, name is None, 0 if name is None else name))
        if len(self.found) > self.most:
            self.found.sort()
            del self.found[self.most:]
        if len(self.found) == self.most:
            self.least = -max(self.found)[0]


_VECTORS = "kind int, doc_id {id}, n long, docs long, terms binary, times binary"


def _vectors(docs: DataFrame, terms: np.ndarray, id_type: str) -> DataFrame:
    """Per document with any of the ``terms`` its vector (kind 0), and per task (kind 1) how
    many documents have terms at all, how many terms these have, and how many each of ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    schema = docs.sparkSession.createDataFrame([], _VECTORS.format(id=id_type)).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        df = np.zeros(len(wanted), np.int64)
        n_docs = n_terms = 0
        for batch in slabs(batches, 1):
            hashes, rows = _terms(batch.column(1))
            size = np.diff(rows)
            n_docs, n_terms = n_docs + int((size > 0).sum()), n_terms + len(hashes)
            at = np.searchsorted(wanted, hashes)
            at[at == len(wanted)] = 0
            hit = wanted[at] == hashes if len(wanted) else np.zeros(len(hashes), bool)
            of = np.repeat(np.arange(len(size)), size)
            both, times = np.unique(of[hit] * np.int64(max(1, len(wanted))) + at[hit], return_counts=True)
            row, term = np.divmod(both, max(1, len(wanted)))
            df += np.bincount(term, minlength=len(wanted))
            found, first = np.unique(row, return_index=True)
            borders = np.append(first, len(row))
            term, times = term.astype("<u4"), times.astype("<u4")
            parts = [slice(a, b) for a, b in zip(borders[:-1], borders[1:])]
            zero = np.zeros(len(found), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(zero.astype(np.int32)), batch.column(0).take(pa.array(found)),
                 pa.array(size[found]), pa.array(zero), pa.array([term[p].tobytes() for p in parts], pa.binary()),
                 pa.array([times[p].tobytes() for p in parts], pa.binary())], schema=arrow)
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_pylist(
            [{"kind": 1, "n": n_terms, "docs": n_docs, "terms": own.astype("<u4").tobytes(),
              "times": df[own].astype("<i8").tobytes()}], schema=arrow)

    return materialize(docs.mapInArrow(count, schema), "lexical", partition_by="kind", compression="zstd")


def _document_counts(statistics: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each of a round's terms."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(n_terms, np.int64)
            for terms, times in zip(*(column.to_pylist() for column in batch.columns)):
                counts[np.frombuffer(terms, "<u4")] += np.frombuffer(times, "<i8")
            own = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own])], ["term", "df"])

    rows = (statistics.select("terms", "times").mapInArrow(explode, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    counts = np.zeros(n_terms, np.int64)
    counts[rows.column("term").to_numpy()] = rows.column("df").to_numpy()
    return counts


def _trees(batches: Iterator[pa.RecordBatch], docs: int) -> Iterator[tuple[list, np.ndarray, Matrix, np.ndarray]]:
    """Ids, lengths and vectors (values: times) of up to ``docs`` documents at a time."""
    held: list[tuple] = []

    def together():
        ids, n, terms, times = zip(*held)
        size = np.array([len(t) // 4 for t in terms])
        return (list(ids), np.array(n, np.int64),
                Matrix(np.append(0, np.cumsum(size)), np.frombuffer(b"".join(terms), "<u4").astype(np.int64),
                       np.frombuffer(b"".join(times), "<u4").astype(np.int64)))

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            held.append(row)
            if len(held) == docs:
                yield together()
                held.clear()
    if held:
        yield together()


def _searched(vectors: DataFrame, queries: Shared, width: int, most: int, leaf: int, id_type: str
              ) -> DataFrame:
    """``item, doc_id, score``: the best of each task for each item of a round."""
    docs = leaf * max(1, min(_MOST_LEAVES, _TREE_NUMBERS // (2 * max(1, width))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, n_docs, n_terms = queries.value()
        best = [Best(most) for _ in asked.items]
        for ids, n, rows in _trees(batches, docs):
            of = np.repeat(np.arange(len(rows)), np.diff(rows.heads))
            rows.values = impacts(rows.values, n[of], n_docs, n_terms)
            for terms, items in asked.blocks:
                own, part = rows.columns(terms, len(weights))
                if not len(own):
                    continue
                tree = BallTree(part, weights[terms], leaf)
                names = [ids[row] for row in own]
                for number in items:
                    item = asked.items[number]
                    local = Query(np.searchsorted(terms, item.terms), item.times)
                    best[number].names = names
                    tree.search(local, weights[terms], best[number])
        rows = [(number, None if absent else name, -score) for number, own in enumerate(best)
                for score, absent, name in own.found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], kind) for k, kind in enumerate((pa.int64(), id_kind, pa.int64()))],
            ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_kind = to_arrow_type(vectors.schema["doc_id"].dataType)
    return (vectors.select("doc_id", "n", "terms", "times")
            .mapInArrow(search, f"item long, doc_id {id_type}, score long"))


def rank_documents(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", most: int = MOST, leaf: int = LEAF,
                   round_bytes: int = ROUND_BYTES, block_terms: int = BLOCK_TERMS,
                   block_items: int = BLOCK_ITEMS) -> DataFrame:
    """For each item its ``most`` best documents: ``item_id, rank, doc_id, score`` (as named).

    Terms are runs of ASCII letters and digits, A-Z in lower case, and non-ASCII characters. A
    document scores, for each of the item's terms with repeats, the term's weight times what
    its occurrences count in a document of that length, in whole numbers; the best come
    first, equal ones by id, null ids last. Documents and items without terms (null, empty)
    are in no result, and only documents with terms count as documents. Each row of ``docs``
    is a document; rows of ``items`` with the same id and text are one item, and items with
    one id and different texts are ranked apart. An item has fewer rows if fewer score above 0.

    Items are asked in rounds of some ``round_bytes`` of text, whose distinct terms go to the
    tasks. Each round reads the documents once, stores what they have of those terms, and
    searches that once; the trees of a task share the best scores found so far, and only
    ``most`` rows for each item leave it.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = materialize(items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
                        .where("text is not null").distinct(), "lexical")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // round_bytes))
    asked = asked.withColumn("round", F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)))
    found = None
    for number in range(rounds):
        own = asked.where(F.col("round") == number).orderBy("item_id", "text").toArrow()
        queries = Queries(own.column("text").combine_chunks(), block_terms, block_items)
        vectors = _vectors(rows, queries.terms, id_type)
        tasks = vectors.where("kind = 1")
        n_docs, n_terms = tasks.agg(F.sum("docs"), F.sum("n")).first()
        df = _document_counts(tasks, len(queries.terms))
        weights = np.array([weight(n_docs, int(count)) if count else 0 for count in df], np.int64)
        width = max((len(terms) for terms, _ in queries.blocks), default=1)
        # Searching costs far more than the vectors' bytes tell, so they are dealt out by number.
        few, many = _TASK_DOCS
        cores = spark.sparkContext.defaultParallelism
        parts = max(1, min((n_docs or 0) // few, max(4 * cores, (n_docs or 0) // many)))
        hits = _searched(vectors.where("kind = 0").repartition(parts), Shared(spark, (queries, weights, n_docs, n_terms)),
                         width, most, leaf, id_type)
        names = own.select(["item_id"]).append_column("item", pa.array(range(own.num_rows), pa.int64()))
        ranked = _merged(hits, most).join(F.broadcast(spark.createDataFrame(names, _item_shape(asked))), "item")
        ranked = ranked.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(id_col), "score")
        if rounds > 1:
            ranked = materialize(ranked, "lexical")
        found = ranked if found is None else found.unionByName(ranked)
    return found


def _item_shape(asked: DataFrame) -> str:
    return f"item_id {asked.schema['item_id'].dataType.simpleString()}, item long"


def _merged(hits: DataFrame, most: int) -> DataFrame:
    """The best of all tasks, ranked; first among those of some tasks, so that none sees all."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    part = F.pmod(F.spark_partition_id(), F.lit(64))
    some = Window.partitionBy("item", "part").orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    return (hits.withColumn("part", part).withColumn("rank", F.row_number().over(some))
            .where(F.col("rank") <= most).drop("part", "rank")
            .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= most))
