"""Grace hash deduplication of whole texts.

Texts are dealt out by hash, first by Spark's shuffle, then, where a task's share does not
fit its memory, again and again by further bits of the hash to spill files of that task,
until each bucket fits an open-addressing table that compares complete contents. Tasks
collapse their own rows before the shuffle, so a text that a third of all rows hold
is sent once per task.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallywire.llm.text import text_bytes
from tallywire.storage import materialize

BUCKET_BYTES = 128 << 20
_FAN_OUT_BITS = 4

# key, text (bytes), id, rep, n, rest
Row = tuple[int, bytes, int | None, int, int, dict]


class OpenTable:
    """Open addressing with linear probing; a slot belongs to a complete content."""

    def __init__(self):
        self._slots = np.full(1 << 10, -1, np.int64)
        self._keys: list[int] = []
        self.texts: list[bytes] = []

    def place(self, key: int, text: bytes) -> int:
        """Number of the entry with this content; the next number if it is new."""
        mask = len(self._slots) - 1
        at = key & mask
        while (entry := int(self._slots[at])) >= 0:
            if self._keys[entry] == key and self.texts[entry] == text:
                return entry
            at = (at + 1) & mask
        self._slots[at] = entry = len(self.texts)
        self._keys.append(key)
        self.texts.append(text)
        if 2 * len(self.texts) > len(self._slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self._slots = np.full(2 * len(self._slots), -1, np.int64)
        mask = len(self._slots) - 1
        for entry, key in enumerate(self._keys):
            at = key & mask
            while self._slots[at] >= 0:
                at = (at + 1) & mask
            self._slots[at] = entry


def _wins(row: Row, other: Row) -> bool:
    """The larger id; a null id is the smallest; among equal ids the first row read."""
    return (row[2] is not None, row[2] or 0, -row[3]) > (other[2] is not None, other[2] or 0, -other[3])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[Row]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        data, offsets = data.tobytes(), offsets.tolist()
        key, _, *others = (column.to_pylist() if i != 1 else None
                           for i, column in enumerate(batch.columns))
        for row in range(batch.num_rows):
            yield (key[row], data[offsets[row]:offsets[row + 1]], *(c[row] for c in others))


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4 << 20
             ) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[1]) + 64
        if weight > size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _locally(schema: pa.Schema, limit: int) -> Callable:
    """Rows with one text as one row of the winner and the ids; a full table is emptied.

    ``rep`` numbers the rows that come out.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 33

        def out() -> Iterator[tuple]:
            nonlocal made
            table, best, ids, held = OpenTable(), [], [], 0
            for key, text, own, rest in _rows(batches):
                entry = table.place(key, text)
                row = (key, text, own, 0, 1, rest)
                if entry == len(best):
                    best.append(row)
                    ids.append([own])
                    held += len(text) + 200
                else:
                    ids[entry].append(own)
                    if _wins(row, best[entry]):
                        best[entry] = row
                held += 16
                if held > limit:
                    for row, group in zip(best, ids):
                        yield (*row[:3], made, len(group), row[5], group)
                        made += 1
                    table, best, ids, held = OpenTable(), [], [], 0
            for row, group in zip(best, ids):
                yield (*row[:3], made, len(group), row[5], group)
                made += 1

        yield from _batches(out(), schema)

    return collapse


def _grace(emit: Callable, schema: pa.Schema, held_schema: pa.Schema, limit: int) -> Callable:
    """Groups of equal texts among the rows of a task; ``emit(winner, rows)`` makes the output.

    Spill files are the task's own and go when it ends, as those of a sort do; a task
    that is lost begins again from the shuffle.
    """

    def groups(rows: Iterator[Row], depth: int) -> Iterator[tuple]:
        table, found, held = OpenTable(), [], 0
        for row in rows:
            entry = table.place(row[0], row[1])
            row = (row[0], table.texts[entry], *row[2:])
            if entry == len(found):
                found.append([])
                held += len(row[1]) + 200
            found[entry].append(row)
            held += 100
            if held > limit and depth < 64 // _FAN_OUT_BITS and len(found) > 1:
                kept = (r for group in found for r in group)
                yield from spilled(kept, rows, depth)
                return
        for group in found:
            winner = group[0]
            for row in group[1:]:
                if _wins(row, winner):
                    winner = row
            yield from emit(winner, group)

    def spilled(kept: Iterator[Row], rows: Iterator[Row], depth: int) -> Iterator[tuple]:
        fan = 1 << _FAN_OUT_BITS
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            names = [os.path.join(folder, f"{part}.arrow") for part in range(fan)]
            waiting: list[list[Row]] = [[] for _ in range(fan)]
            weight = [0] * fan
            files = [pa.OSFile(name, "wb") for name in names]
            writers = [pa.ipc.new_stream(file, held_schema) for file in files]

            def write(part: int) -> None:
                for batch in _batches(waiting[part], held_schema):
                    writers[part].write_batch(batch)
                waiting[part], weight[part] = [], 0

            for source in (kept, rows):
                for row in source:
                    # High bits first; the table's probing uses the low ones.
                    part = (row[0] >> (64 - _FAN_OUT_BITS * (depth + 1))) & (fan - 1)
                    waiting[part].append(row)
                    weight[part] += len(row[1]) + 100
                    if weight[part] > limit // (4 * fan):
                        write(part)
            for part in range(fan):
                write(part)
                writers[part].close()
                files[part].close()
            for name in names:
                with pa.OSFile(name, "rb") as file:
                    yield from groups(_rows(pa.ipc.open_stream(file)), depth + 1)
                os.unlink(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(groups(_rows(batches), 0), schema)

    return run


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Hash, bytes, id and the other columns (in a struct, so their names are free)."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    others = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)
              if c not in (id_col, text)]
    return docs.select(
        F.xxhash64(content).alias("key"), content.cast("binary").alias("text"),
        F.col(id_col).cast("long").alias("id"),
        F.struct(F.col(text).isNull().alias("was_null"), *others).alias("rest"))


def _collapsed(keyed: DataFrame, bucket_bytes: int) -> DataFrame:
    schema = (keyed.schema["rest"].dataType.simpleString())
    local = f"key long, text binary, id long, rep long, n long, rest {schema}, ids array<long>"
    shape = keyed.sparkSession.createDataFrame([], local).schema
    return keyed.mapInArrow(_locally(to_arrow_schema(shape), bucket_bytes), shape)


def _dealt(rows: DataFrame) -> DataFrame:
    """By hash, over the session's shuffle partitions."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key")


def duplicate_groups(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: id, ``keep_id`` of the row that stays, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are; a null text is an empty one. The row with the
    largest id stays; a null id is the smallest; of repeated rows one stays. An empty
    table gives an empty result; other columns do not matter.
    """
    keyed = _keyed(docs.select(id_col, text), id_col, text)
    local = materialize(_collapsed(keyed, bucket_bytes), "dedup-local")
    rows = local.select("key", "text", "id", "rep", "n", "rest")

    def verdicts(winner: Row, group: list[Row]) -> Iterator[tuple]:
        size = sum(row[4] for row in group)
        for row in group:
            yield row[3], b"", winner[2], size, row[3] == winner[3]

    shape = docs.sparkSession.createDataFrame(
        [], "rep long, none binary, keep_id long, group_size long, wins boolean").schema
    groups = _dealt(rows).mapInArrow(
        _grace(verdicts, to_arrow_schema(shape), to_arrow_schema(rows.schema), bucket_bytes), shape)
    members = local.select("rep", "ids", F.sha2("text", 256).alias("text_sha256"))
    first = F.coalesce(F.array_position("ids", F.col("keep_id")), F.lit(1)) - 1
    return (
        members.join(groups.drop("none"), "rep")
        .select("*", F.posexplode("ids").alias("place", id_col))
        .select(id_col, "keep_id", "group_size",
                (F.col("wins") & (F.col("place") == first)).alias("kept"), "text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows that stay, with all their columns; see ``duplicate_groups`` for the rules."""
    keyed = _keyed(docs, id_col, text)
    rows = _collapsed(keyed, bucket_bytes).drop("ids")

    def winners(winner: Row, group: list[Row]) -> Iterator[tuple]:
        yield winner

    schema = to_arrow_schema(rows.schema)
    kept = _dealt(rows).mapInArrow(_grace(winners, schema, schema, bucket_bytes), rows.schema)
    places = {c: F.col(f"rest.c{i}") for i, c in enumerate(docs.columns)}
    content = F.when(~F.col("rest.was_null"), F.col("text").cast("string"))
    places |= {id_col: F.col("id").cast(docs.schema[id_col].dataType),
               text: content.cast(docs.schema[text].dataType)}
    return kept.select(*(places[c].alias(c) for c in docs.columns))
