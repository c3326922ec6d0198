"""Bounded-space online packing of documents into sequences of one length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.shared import Shared
from tallywire.llm.text import slabs
from tallywire.llm.tokenizer import ByteBPE
from tallywire.storage import materialize

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 32
# A window that is emitted with a larger gap is filled with a piece cut from the document.
LEAST_CUT = 16
_FAN_IN = 64

_PIECES = ("doc_id {id}, start long, ids binary, doc_tokens long, sequence_id long, "
           "offset long, part long, open boolean")


class Windows:
    """A fixed number of open windows; pieces go to the one they fit best.

    A piece is (document id, place in the document, ids, the document's tokens). When it
    fits no open window and no more may be opened, the fullest is emitted, filled up
    with the piece's head if the gap is worth a cut.
    """

    def __init__(self, length: int, most: int, least_cut: int):
        self.length, self.most, self.least_cut = length, most, least_cut
        self.open: list[list] = []
        self.used: list[int] = []

    def _close(self, window: int) -> list:
        self.used.pop(window)
        return self.open.pop(window)

    def place(self, doc_id, start: int, ids: np.ndarray, total: int) -> Iterator[list]:
        """Put a piece; yields the windows that are finished by it."""
        while len(ids) >= self.length:
            yield [(doc_id, start, ids[:self.length], total)]
            start, ids = start + self.length, ids[self.length:]
        while len(ids):
            fits = [(self.length - used, i) for i, used in enumerate(self.used)
                    if self.length - used >= len(ids)]
            if fits:
                window = min(fits)[1]
            elif len(self.open) < self.most:
                window = len(self.open)
                self.open.append([])
                self.used.append(0)
            else:
                fullest = max(range(len(self.used)), key=self.used.__getitem__)
                gap = self.length - self.used[fullest]
                if gap >= self.least_cut:
                    self.open[fullest].append((doc_id, start, ids[:gap], total))
                    start, ids = start + gap, ids[gap:]
                yield self._close(fullest)
                continue
            self.open[window].append((doc_id, start, ids, total))
            self.used[window] += len(ids)
            if self.used[window] == self.length:
                yield self._close(window)
            return

    def merged(self) -> Iterator[list]:
        """What is open, end to end: all but the last sequence are full."""
        sequence, used = [], 0
        for doc_id, start, ids, total in (piece for window in self.open for piece in window):
            while len(ids):
                head = ids[:self.length - used]
                sequence.append((doc_id, start, head, total))
                start, ids, used = start + len(head), ids[len(head):], used + len(head)
                if used == self.length:
                    yield sequence
                    sequence, used = [], 0
        if sequence:
            yield sequence


def _write(sequences: Iterator[tuple[list, bool]], schema: pa.Schema, level: int, part: int
           ) -> Iterator[pa.RecordBatch]:
    """Pieces of numbered sequences as rows; ids as little-endian 32-bit numbers."""
    rows, weight = [], 0
    number = (level << 58) | (part << 28)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for sequence, is_open in sequences:
        offset = 0
        for doc_id, start, ids, total in sequence:
            rows.append((doc_id, start, ids.astype("<u4").tobytes(), total, number, offset,
                         part, is_open))
            offset += len(ids)
            weight += 4 * len(ids) + 64
        number += 1
        if weight > 4 << 20:
            yield batch()
            rows, weight = [], 0
    if rows:
        yield batch()


def pack(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text: str = "text",
         length: int = LENGTH, end_id: int = END_ID, windows: int = OPEN_WINDOWS,
         least_cut: int = LEAST_CUT) -> DataFrame:
    """One row per piece: ``doc_id, start, ids, doc_tokens, sequence_id, offset``.

    ``vocabulary`` is the path of a tokenizer file, read here once. A document is its ids
    and ``end_id``; a null text is empty, and its one id is ``end_id``. Pieces of a
    document follow one another from 0 to ``doc_tokens``; pieces of a sequence from
    offset 0. Each task keeps ``windows`` open windows over its rows as they come.
    What is open at its end is packed again by fewer tasks, level by level, until one
    has the rest; each level takes the leftovers of at most ``_FAN_IN`` tasks, so no task
    takes more than that many times the open windows. Repeated rows and ids, and null ids,
    are documents of their own.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        encoder = Shared(spark, file.read())
    id_type = docs.schema[id_col].dataType.simpleString()
    shape = spark.createDataFrame([], _PIECES.format(id=id_type)).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(shape)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, own = ByteBPE(encoder.value()), Windows(length, windows, least_cut)

        def sequences() -> Iterator[tuple[list, bool]]:
            for batch in slabs(batches, 1):
                for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = np.append(bpe.ids(content or ""), np.uint32(end_id))
                    for sequence in own.place(doc_id, 0, ids, len(ids)):
                        yield sequence, False
            for sequence in own.open:
                yield sequence, True

        yield from _write(sequences(), schema, 0, TaskContext.get().partitionId())

    def again(level: int, last: bool):
        def merge(key: tuple, rows: pa.Table) -> pa.Table:
            own = Windows(length, windows, least_cut)

            def sequences() -> Iterator[tuple[list, bool]]:
                ordered = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
                for row in ordered.to_pylist():
                    ids = np.frombuffer(row["ids"], "<u4")
                    for sequence in own.place(row["doc_id"], row["start"], ids, row["doc_tokens"]):
                        yield sequence, False
                for sequence in own.merged() if last else own.open:
                    yield sequence, not last

            part = key[0].as_py()
            return pa.Table.from_batches(_write(sequences(), schema, level, part), schema)
        return merge

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    packed = materialize(texts.mapInArrow(first, shape), "packing", compression="zstd")
    done, level = packed.where("not open"), 0
    parts = (packed.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level += 1
        parts = -(-parts // _FAN_IN)
        rows = packed.where("open").withColumn("part", F.expr(f"part div {_FAN_IN}"))
        packed = materialize(rows.groupBy("part").applyInArrow(again(level, parts == 1), shape),
                             "packing", compression="zstd")
        done = done.unionByName(packed.where("not open"))
        if parts == 1:
            return done.drop("part", "open").withColumnRenamed("doc_id", id_col)
