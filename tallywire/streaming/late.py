"""Rows that come too late: counted for every batch, and the messages themselves on request."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tallywire.commits import CommitLog, HadoopFolder
from tallywire.functions.json_codec import decode_messages
from tallywire.operators.clean import flatten_article, with_event_time
from tallywire.operators.windowed import WINDOW_LENGTH
from tallywire.schemas import MESSAGE

# How long after a query's end its last reports may take to arrive.
_PATIENCE_SECONDS = 60
_NO_LIMIT = 0


def _milliseconds(instant: str) -> int:
    return round(datetime.fromisoformat(instant.replace("Z", "+00:00")).timestamp() * 1000)


class LateRows(StreamingQueryListener):
    """What the batches of a query dropped for being behind the watermark.

    A listener is told of every batch, once and in order, so nothing has to be looked up in
    time. ``total`` counts as Spark does: rows of partial counts, so messages that share a
    window, a key and a task are one. With ``path`` each batch's report is kept there as an
    entry of a log (watermark, offsets, rows dropped), from which ``late_messages`` finds the
    messages.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None):
        self._reports: dict[str, dict[int, dict]] = {}
        self._ended: set[str] = set()
        self._followed: set[str] = set()
        self._kept: set[tuple[str, int]] = set()
        self._changed = threading.Condition()
        self._spark, self._path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        report = {
            "watermark": _milliseconds(progress.eventTime.get("watermark", "1970-01-01T00:00:00Z")),
            "start": progress.sources[0].startOffset, "end": progress.sources[0].endOffset,
            "dropped": sum(o.numRowsDroppedByWatermark for o in progress.stateOperators),
        }
        with self._changed:
            self._reports.setdefault(str(progress.runId), {})[progress.batchId] = report
            self._keep()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _keep(self) -> None:
        if self._path is None:
            return
        for run in self._followed:
            log = None
            for batch, report in sorted(self._reports.get(run, {}).items()):
                if (run, batch) not in self._kept:
                    log = log or CommitLog.of(self._spark, self._path)
                    log.put(batch, report)
                    self._kept.add((run, batch))

    @contextmanager
    def listening(self, spark: SparkSession) -> Iterator[LateRows]:
        """Start the queries to follow inside, and end them there."""
        self._spark = self._spark or spark
        spark.streams.addListener(self)
        try:
            yield self
        finally:
            spark.streams.removeListener(self)

    def follow(self, query: StreamingQuery) -> None:
        """Count this query's batches, also those reported before."""
        with self._changed:
            self._followed.add(str(query.runId))
            self._keep()

    def wait(self) -> None:
        """Return when all that ended queries reported has arrived."""
        with self._changed:
            if not self._changed.wait_for(lambda: self._followed <= self._ended, _PATIENCE_SECONDS):
                raise TimeoutError("A query's end was not reported; is it still running?")

    def total(self) -> int:
        with self._changed:
            return sum(report["dropped"] for run in self._followed
                       for report in self._reports.get(run, {}).values())


def recover(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Add to a log of reports the batches whose reports were lost with the driver.

    A checkpoint remembers the watermarks and offsets of its last hundred batches. How many
    rows these dropped it doesn't, so that is null.
    """
    log = CommitLog.of(spark, path)
    known, offsets = log.last(), HadoopFolder(spark, f"{checkpoint}/offsets")
    done = {name for name in HadoopFolder(spark, f"{checkpoint}/commits").names() if name.isdigit()}
    batches = sorted(int(name) for name in offsets.names() if name in done)
    ends = {}
    for batch in batches:
        _, about, *sources = offsets.read(str(batch)).decode().splitlines()
        ends[batch] = sources[0] if sources and sources[0] != "-" else None
        if batch > known:
            log.put(batch, {"watermark": json.loads(about)["batchWatermarkMs"],
                            "start": ends.get(batch - 1), "end": ends[batch], "dropped": None})


def _offset(text: str | None) -> int:
    return -1 if text is None else json.loads(text)["logOffset"]


def _plain_path(path):
    return F.regexp_replace(path, "^file:/+", "file:/")


def _landed_files(spark: SparkSession, checkpoint: str, batches: list[tuple[int, int, int, int]]
                  ) -> DataFrame:
    """``path, batch, limit`` of the files that went into batches (number, offsets from and to, limit)."""
    log = HadoopFolder(spark, f"{checkpoint}/sources/0")
    names = [name for name in log.names() if name.split(".")[0].isdigit() and not name.startswith(".")]
    folded = max((int(name.split(".")[0]) for name in names if name.endswith(".compact")), default=-1)
    read = [f"{checkpoint}/sources/0/{name}" for name in names
            if int(name.split(".")[0]) > folded or name == f"{folded}.compact"]
    wanted = spark.createDataFrame(batches, "batch long, first long, last long, limit long")
    entries = spark.read.text(read).select(
        F.from_json("value", "path string, batchId long").alias("file")).where("file.path is not null")
    return entries.join(wanted, F.col("file.batchId").between(F.col("first"), F.col("last"))).select(
        _plain_path("file.path").alias("path"), "batch", "limit").distinct()


def late_messages(spark: SparkSession, path: str, checkpoint: str,
                  read: Callable[[list[str]], DataFrame] | None = None,
                  length: str = WINDOW_LENGTH) -> DataFrame:
    """The articles that a count of landed messages dropped as late: nine fields, ``batch``, ``limit``.

    ``path`` is the log that ``LateRows`` kept of the count with this ``checkpoint``. A batch
    drops what belongs to windows that ended at or before the watermark of the batch before
    it, its ``limit``. Only files of batches that dropped something (or where that is not
    known) are read, by ``read``, as a ``value`` column. Articles without a time are in no
    window and not late.
    """
    entries = CommitLog.of(spark, path).entries()
    limits = {number: entries[number - 1]["watermark"] if number - 1 in entries else _NO_LIMIT
              for number in entries}
    late = [(number, _offset(e["start"]) + 1, _offset(e["end"]), limits[number])
            for number, e in sorted(entries.items())
            if e["dropped"] != 0 and limits[number] > 0 and _offset(e["end"]) > _offset(e["start"])]
    shape = spark.createDataFrame([], MESSAGE)
    files = _landed_files(spark, checkpoint, late).collect() if late else []
    if files:
        rows = read([f.path for f in files]) if read else spark.read.schema(MESSAGE).parquet(
            *(f.path for f in files))
        rows = rows.select("value", _plain_path(F.col("_metadata.file_path")).alias("path"))
        known = spark.createDataFrame(files, "path string, batch long, limit long")
    else:
        rows = shape.withColumn("path", F.lit(""))
        known = spark.createDataFrame([], "path string, batch long, limit long")
    placed = rows.join(known, "path").select("value", "batch", "limit")
    keep = ["batch", "limit"]
    articles = with_event_time(flatten_article(decode_messages(placed, keep=keep), keep))
    end = F.unix_millis(F.window("publishedAt", length)["end"])
    return articles.withColumn("_end", end).where(F.col("_end") <= F.col("limit")).drop("_end").withColumn(
        "limit", F.timestamp_millis("limit")).select(
        *(c for c in articles.columns if c not in keep), *keep)
