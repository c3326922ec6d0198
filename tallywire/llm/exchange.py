"""Chunks of documents, and totals of 64-bit keys over all chunks.

Tasks cut their rows into chunks of bounded size. A chunk asks about the keys it has (words,
windows, names) with one sorted list for each bucket of the key space; per bucket the
lists of all chunks are added up and every chunk gets the totals of its own keys back, in its
order. A key sends one entry for each chunk, however many rows hold it, so none is hot, and
no list of all keys is ever in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.text import slabs, text_bytes

MOST_BUCKETS = 1 << 16
_MOST = (1 << 31) - 1
# Keys of a bucket that are added up at a time.
PART_KEYS = 1 << 22

# One table holds the chunks themselves (bucket -1) and their questions.
CHUNKS = ("chunk long, bucket int, ids array<long>, offsets binary, texts binary, "
          "keys binary, counts binary, lows binary")
CHUNK_SCHEMA = pa.schema([
    ("chunk", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())),
    ("offsets", pa.binary()), ("texts", pa.binary()), ("keys", pa.binary()),
    ("counts", pa.binary()), ("lows", pa.binary())])
REPLIES = "chunk long, bucket int, round int, reply binary"
REPLY_SCHEMA = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("round", pa.int32()),
                          ("reply", pa.binary())])


def bucket_bits(docs: DataFrame, text: str, bucket_bytes: int) -> int:
    """Bits of a key that name its bucket, for about ``bucket_bytes`` of text to a bucket."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(8, size // bucket_bytes))
    return int(buckets - 1).bit_length()


def numbered_slabs(batches: Iterator[pa.RecordBatch], text: int, limit: int
                   ) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A task's rows in chunks, with numbers that no other task gives."""
    first = TaskContext.get().partitionId() << 32
    for number, slab in enumerate(slabs(batches, text, limit)):
        yield first + number, slab


def chunk_row(chunk: int, ids: list, data: np.ndarray, offsets: np.ndarray) -> dict:
    return {"chunk": chunk, "bucket": -1, "ids": ids,
            "offsets": offsets.astype(np.int64).tobytes(),
            "texts": pa.compress(data.tobytes(), codec="zstd", asbytes=True)}


def chunk_texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a chunk's texts."""
    offsets = np.frombuffer(row["offsets"], np.int64)
    data = pa.decompress(row["texts"], int(offsets[-1]), codec="zstd", asbytes=True)
    return np.frombuffer(data, np.uint8), offsets


def bucket_borders(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in sorted keys, and the end."""
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(keys, firsts), len(keys))


def questions(chunk: int, keys: np.ndarray, counts: np.ndarray, lows: np.ndarray | None, bits: int
              ) -> Iterator[dict]:
    """Rows that ask about sorted distinct keys: own counts, and own lowest values if given."""
    borders = bucket_borders(keys, bits)
    # A chunk has less than 2^31 of anything, as it is some MB and the rest of one text.
    counts = np.minimum(counts, _MOST).astype(np.uint32)
    for bucket in np.flatnonzero(np.diff(borders)).tolist():
        part = slice(borders[bucket], borders[bucket + 1])
        yield {"chunk": chunk, "bucket": bucket, "keys": keys[part].tobytes(),
               "counts": counts[part].tobytes(),
               "lows": None if lows is None else lows[part].tobytes()}


def batch_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row.get(field.name) for row in rows], field.type) for field in schema],
        schema=schema)


def _arrays(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    """The values of all rows, where they are; a null is none."""
    buffers = (value.as_buffer() for chunk in column.chunks for value in chunk)
    return [np.frombuffer(b if b is not None else b"", kind) for b in buffers]


def _cuts(keys: list[np.ndarray]) -> np.ndarray:
    """Keys that cut a bucket's into parts of about ``PART_KEYS``; hashed keys lie evenly."""
    full = [k for k in keys if len(k)]
    parts = -(-sum(map(len, full)) // PART_KEYS)
    if parts < 2:
        return np.zeros(0, np.uint64)
    low, high = min(int(k[0]) for k in full), max(int(k[-1]) for k in full)
    return np.array([low + (high - low) * part // parts for part in range(1, parts)], np.uint64)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys, where each distinct one begins there, and its number by entry."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), number


def totals(asked: DataFrame, number: int, summary: Callable | None = None, kind: type = np.uint32
           ) -> DataFrame:
    """Replies to the questions of a round: per key twice its total, plus 1 if the own low is lowest.

    As 32-bit numbers totals end at 2^31 - 1, which then stands for that many or more; as
    ``np.uint64`` they are exact.

    ``summary(totals, lows)`` of a bucket's distinct keys gives an array that is returned for
    each bucket as the reply to chunk -1. A bucket is added up part by part of its keys, so that
    arrays beside its lists are bounded; arrays of summaries are added.
    """

    most = int(np.iinfo(kind).max) >> 1

    def part_totals(keys: list, counts: list, lows: list):
        together = np.concatenate(keys)
        order, firsts, of = grouped(together)
        total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), firsts)
        low = np.concatenate(lows)
        lowest = np.minimum.reduceat(low[order], firsts) if len(low) else None
        reply = np.minimum(total, most)[of].astype(kind) << kind(1)
        if lowest is not None:
            reply |= (low == lowest[of]).astype(kind)
        return reply, None if summary is None else summary(total, lowest)

    def add(table: pa.Table) -> pa.Table:
        keys = _arrays(table.column("keys"), np.uint64)
        counts, lows = _arrays(table.column("counts"), np.uint32), _arrays(table.column("lows"), np.int64)
        cuts = _cuts(keys)
        places = [np.concatenate([[0], np.searchsorted(own, cuts), [len(own)]]) for own in keys]
        replies, whole = [np.empty(len(own), kind) for own in keys], None
        for part in range(len(cuts) + 1):
            slices = [slice(place[part], place[part + 1]) for place in places]
            if not any(s.stop > s.start for s in slices):
                continue
            reply, sums = part_totals(*([own[s] for own, s in zip(column, slices)]
                                        for column in (keys, counts, lows)))
            borders = np.cumsum([0, *(s.stop - s.start for s in slices)])
            for own, s, first, end in zip(replies, slices, borders, borders[1:]):
                own[s] = reply[first:end]
            if sums is not None:
                whole = sums if whole is None else whole + sums
        buckets = table.column("bucket").to_pylist()
        rows = [{"chunk": chunk, "bucket": bucket, "round": number, "reply": reply.tobytes()}
                for chunk, bucket, reply in zip(table.column("chunk").to_pylist(), buckets, replies)]
        if whole is not None:
            rows.append({"chunk": -1, "bucket": buckets[0], "round": number, "reply": whole.tobytes()})
        return pa.Table.from_batches([batch_of(rows, REPLY_SCHEMA)])

    rows = asked.where("bucket >= 0").select("chunk", "bucket", "keys", "counts", "lows")
    return rows.groupBy("bucket").applyInArrow(add, REPLIES)


def answers(replies: pa.Table, number: int, kind: type = np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """Totals, and whether the own low was lowest, of a chunk's sorted distinct keys in a round.

    ``kind`` is that of the ``totals``.
    """
    own = sorted((row["bucket"], row["reply"]) for row in replies.to_pylist()
                 if row["round"] == number)
    reply = np.frombuffer(b"".join(r for _, r in own), kind)
    return (reply >> kind(1)).astype(np.int64), (reply & kind(1)).astype(bool)


def column_texts(batch: pa.RecordBatch) -> tuple[list, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of a batch of (id, text)."""
    return (batch.column(0).to_pylist(), *text_bytes(batch.column(1)))
