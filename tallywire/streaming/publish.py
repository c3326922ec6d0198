"""A topic in a shared folder, where a batch of messages is published as a whole or not at all.

For publishing where there is no broker, with the guarantee that a broker's plain producer does
not give: tasks write files that nobody reads yet; once all have succeeded, one entry of a log
names the files of the batch, and these are moved to where readers look. If that is broken off, the
next commit moves the rest. A batch that is run again after a failure leaves no second copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from tallywire.commits import ArrowFolder, CommitLog
from tallywire.schemas import MESSAGE
from tallywire.sources.messages import landed_messages
from tallywire.storage import make_folder

FORMAT = "committed_messages"
_STAGED, _PUBLISHED = "staged", "messages"
_MESSAGE = pa.schema([("value", pa.binary())])


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: a file, or nothing."""

    file: str | None
    rows: int


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self._path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                stream = ArrowFolder(f"{self._path}/{_STAGED}").create(name)
                writer = pq.ParquetWriter(stream, _MESSAGE, compression="zstd")
            writer.write_batch(batch.select(["value"]).cast(_MESSAGE))
            rows += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        stream.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        log = CommitLog.at(self._path)
        if batchId <= log.last():
            self.abort(messages, batchId)
        else:
            done = [message for message in messages if message is not None and message.file]
            log.put(batchId, {"files": [m.file for m in done], "rows": sum(m.rows for m in done)})
        bring_forward(self._path)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        folder = ArrowFolder(f"{self._path}/{_STAGED}")
        for message in messages:
            if message is not None and message.file:
                folder.remove(message.file)


def bring_forward(path: str) -> None:
    """Move what the last commit names to where readers look, as far as it is not there yet."""
    staged, entry = ArrowFolder(f"{path}/{_STAGED}"), CommitLog.at(path).latest()
    if entry is not None:
        published, there = ArrowFolder(f"{path}/{_PUBLISHED}"), set(staged.names())
        for name in entry["files"]:
            if name in there:
                staged.move(name, published)


class CommittedMessages(DataSource):
    """A sink of streams: the folder named by the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value binary"

    def streamWriter(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def committed_sink(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Publish ``value`` rows to a folder that driver and executors share, batch by batch."""
    messages.sparkSession.dataSource.register(CommittedMessages)
    return (
        messages.select(messages["value"].cast("binary").alias("value"))
        .writeStream.format(FORMAT)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def committed_messages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The messages of all committed batches, as a table or as a stream. Files appear one by one,
    so a reader may see a part of a batch before the rest, but nothing twice."""
    folder = f"{path}/{_PUBLISHED}"
    make_folder(spark, folder)
    return landed_messages(spark, folder) if stream else spark.read.schema(MESSAGE).parquet(folder)


def discard_uncommitted(path: str) -> list[str]:
    """Remove the files of attempts that failed without a trace. For the writer, when it isn't running."""
    bring_forward(path)
    folder = ArrowFolder(f"{path}/{_STAGED}")
    left = folder.names()
    for name in left:
        folder.remove(name)
    return left
