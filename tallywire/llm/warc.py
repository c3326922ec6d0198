"""WARC archives written by tasks, and read back by byte ranges.

An archive is a run of gzip members, one record each, so a reader can begin anywhere:
a task looks for gzip's magic in its range, takes a place for the start of a member only
if it decodes to a record's header, and owns the records that start inside its range,
whether or not they end there.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.llm.text import text_bytes

# Fixed values of the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = b"\r\n\r\n"

LEAST_REVISIT_BYTES = 100
RANGE_BYTES = 32 << 20
_READ_BYTES = 1 << 20
_HEADER_BYTES = 16 << 10

_RECORD = ("path string, start long, record_type string, record_id string, refers_to string, "
           "target_uri string, payload_bytes long, payload_digest string, payload binary")


def _open(path: str):
    """File system and path within, for any store that pyarrow reaches by URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def record(record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit that leaves it out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{record_id}>",
            f"WARC-Target-URI: {' '.join(uri.split())}",
            f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + "\r\n".join(head).encode() + BREAK + block + BREAK


def member(data: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame, *, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html`` (as bytes) with ``digest`` and ``refers_to``.

    Among equal payloads of enough bytes all but the smallest ``page_id`` refer to that
    one. Only digests that occur more than once are joined back, one row for each; rows
    of a digest with very many pages stay spread, as the join splits skewed partitions.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit(""))
                        .cast("binary").alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn(
        "large", F.octet_length("html") >= least_bytes)
    first = (rows.where("large").groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("large") & (F.col("first") < F.col("page_id")), F.col("first"))
        .alias("refers_to"))


def write_warc(records: DataFrame, folder: str) -> int:
    """Write ``page_id, url, html, digest, refers_to`` as archives in ``folder``; returns the records.

    A task writes one archive under a name of this attempt and renames it when it is whole,
    so a task that runs again replaces its archive by an equal one.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}.warc"
        store, path = _open(name)
        attempt = f"{path}.{context.taskAttemptId()}.tmp"
        count = 0
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(attempt, compression=None) as out:
            for batch in batches:
                data, offsets = text_bytes(batch.column(2))
                data, offsets = data.tobytes(), offsets.tolist()
                ids, urls, _, digests, refers = (c.to_pylist() for c in batch.columns)
                for row, digest in enumerate(digests):
                    out.write(member(record(
                        "" if ids[row] is None else str(ids[row]), urls[row] or "",
                        data[offsets[row]:offsets[row + 1]], digest,
                        None if refers[row] is None else str(refers[row]))))
                    count += 1
        store.move(attempt, path)
        yield pa.RecordBatch.from_pydict({"n": pa.array([count], pa.int64())})

    written = records.select("page_id", "url", "html", "digest", "refers_to")
    return written.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def archive_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, start, end`` of the byte ranges that readers take, one a row."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(folder)
             .select("path", "length").where("length > 0"))
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1,
                                 F.lit(range_bytes).cast("long"))).alias("start")
    return files.select("path", "length", begin).select(
        "path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))


class RangeReader:
    """The records that start in ``[start, end)`` of a file."""

    def __init__(self, file, start: int, end: int):
        self.file, self.start, self.end = file, start, end
        self._block, self._from = b"", start

    def _at(self, place: int, size: int) -> bytes:
        """Bytes of the file, read a block at a time; fewer at its end."""
        if not self._from <= place <= place + size <= self._from + len(self._block):
            self.file.seek(place)
            self._block, self._from = self.file.read(max(size, _READ_BYTES)), place
        return self._block[place - self._from:place - self._from + size]

    def _is_record(self, place: int) -> bool:
        """Whether a member that decodes to a record's header begins here."""
        unpacker = zlib.decompressobj(wbits=31)
        try:
            head = unpacker.decompress(self._at(place, 4096), 4096)
        except zlib.error:
            return False
        return head.startswith(b"WARC/1.") and b"\r\nWARC-Type: " in head

    def _next(self, place: int) -> int | None:
        """First start of a member at or after ``place`` and before the end of the range."""
        if place < self.end and self._at(place, len(GZIP_MAGIC)) == GZIP_MAGIC and (
                self._is_record(place)):
            return place
        while place < self.end:
            # Two bytes more, so that magic across the edge of what was read is seen.
            chunk = self._at(place, min(_READ_BYTES, self.end - place) + len(GZIP_MAGIC) - 1)
            hit = chunk.find(GZIP_MAGIC)
            while hit >= 0:
                if place + hit < self.end and self._is_record(place + hit):
                    return place + hit
                hit = chunk.find(GZIP_MAGIC, hit + 1)
            place += min(_READ_BYTES, self.end - place)
        return None

    def _member(self, place: int) -> tuple[bytes, int]:
        """Content of the member at ``place``, read past the range if need be, and its end."""
        unpacker, parts, at = zlib.decompressobj(wbits=31), [], place
        while not unpacker.eof:
            chunk = self._at(at, _HEADER_BYTES)
            if not chunk:
                raise ValueError(f"a member at {place} is cut off")
            at += len(chunk)
            parts.append(unpacker.decompress(chunk))
        return b"".join(parts), at - len(unpacker.unused_data)

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        place = self._next(self.start)
        while place is not None:
            content, after = self._member(place)
            yield place, content
            place = self._next(after)


def parse(content: bytes) -> dict:
    """Fields of a record; a revisit's payload size is that of the response it repeats."""
    head, _, block = content.partition(BREAK)
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:]
                  if ": " in line)
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(BREAK)
    kind = fields["WARC-Type"]

    def named(key: str) -> str | None:
        value = fields.get(key, "").removeprefix("<urn:page:").removesuffix(">")
        return value or None

    if kind == "response":
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if f"sha256:{digest}" != fields.get("WARC-Payload-Digest"):
            raise ValueError(f"{fields.get('WARC-Record-ID')}: payload and digest differ")
    else:
        lengths = [line.split(b":", 1)[1] for line in http.split(b"\r\n")
                   if line.lower().startswith(b"content-length:")]
        size, payload = int(lengths[0]), None
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    return {"record_type": kind, "record_id": named("WARC-Record-ID"),
            "refers_to": named("WARC-Refers-To"), "target_uri": fields.get("WARC-Target-URI"),
            "payload_bytes": size, "payload_digest": digest, "payload": payload}


def read_warc(spark: SparkSession, folder: str, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record of the archives in ``folder``: place, type, ids, payload, its size and digest.

    Payloads are null for revisits. Ranges are dealt out by file and start. An empty
    folder has no records; a member that is cut off fails, a gap between members is skipped.
    """
    ranges = archive_ranges(spark, folder, range_bytes)
    cores = spark.sparkContext.defaultParallelism
    parts = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [field.split()[0] for field in _RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, t) for n, t in zip(names, [
            pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(),
            pa.int64(), pa.string(), pa.binary()])])
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _open(row["path"])
                held, weight = [], 0
                with store.open_input_file(path) as file:
                    for place, content in RangeReader(file, row["start"], row["end"]):
                        held.append({"path": row["path"], "start": place, **parse(content)})
                        weight += len(content)
                        if weight > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return ranges.repartition(parts, "path", "start").mapInArrow(read, _RECORD)
