"""Several outputs from one streaming query."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallywire.commits import CommitLog, HadoopFolder
from tallywire.sources.directories import json_directory, parquet_directory

Target = Callable[[DataFrame, int], None]


def directory_target(path: str, fmt: str = "parquet", files: int | None = None) -> Target:
    """Write batch n to ``batch=n``. A replayed batch overwrites itself.

    ``files`` bounds the part files per batch where batches are known to be small.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if files is None else batch.coalesce(files)
        rows.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return write


def console_target(truncate: bool = False, rows: int = 20) -> Target:
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch: {batch_id}")
        batch.show(rows, truncate)

    return show


def fan_out(df: DataFrame, targets: Sequence[Target], checkpoint: str) -> DataStreamWriter:
    """Scan and aggregate once per batch, then hand the batch to every target."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if len(targets) == 1:
            targets[0](batch, batch_id)
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for target in targets:
                target(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(deliver)
    )


class CommittedBatches:
    """Several folders of one stream, in all of which a batch counts, or in none.

    Each delivery of a batch goes to folders of its own, one in every target; then one entry
    of the log beside them names all of these. A batch that comes again after its entry is
    left alone, and what was written without one is never read, and removed by the
    next delivery of a new run. One stream writes; any number of readers may read.
    """

    def __init__(self, spark: SparkSession, root: str, formats: Mapping[str, str],
                 also: Sequence[Target] = (), files: int | None = None):
        """``formats`` by target's name; ``also`` are further targets, without a log, which
        get a batch before it is committed; ``files`` bounds the part files of a batch."""
        self._spark, self._root, self._formats = spark, root, dict(formats)
        self._also, self._files, self._clean = list(also), files, False

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        log = CommitLog.of(self._spark, self._root)
        if batch_id <= log.last():
            return
        if not self._clean:
            self.discard_uncommitted()
            self._clean = True
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch if self._files is None else batch.coalesce(self._files)
            folders = {}
            for name, fmt in self._formats.items():
                folders[name] = f"{name}/batch={batch_id}-{uuid.uuid4().hex}"
                rows.write.format(fmt).save(f"{self._root}/{folders[name]}")
            for target in self._also:
                target(batch, batch_id)
        finally:
            batch.unpersist()
        log.put(batch_id, folders)

    def writer(self, df: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (
            df.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.deliver)
        )

    def folders(self, name: str) -> list[str]:
        """The committed folders of a target, by batch."""
        entries = CommitLog.of(self._spark, self._root).entries()
        return [f"{self._root}/{entry[name]}" for _, entry in sorted(entries.items()) if name in entry]

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The rows of a target's committed batches."""
        read = json_directory if self._formats[name] == "json" else parquet_directory
        return read(self._spark, self.folders(name), schema)

    def discard_uncommitted(self) -> None:
        """Remove what deliveries left that never came to their end. For the writer alone."""
        for name in self._formats:
            kept = {folder.rsplit("/", 1)[1] for folder in self.folders(name)}
            folder = HadoopFolder(self._spark, f"{self._root}/{name}")
            for found in folder.names():
                if found.startswith("batch=") and found not in kept:
                    folder.remove(found)
