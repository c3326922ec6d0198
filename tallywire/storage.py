"""Where intermediate tables, landing folders and checkpoints are kept."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHECKPOINT_DIR = "spark.checkpoint.dir"
# Read where the cluster names no checkpoint folder; may be set in a running session.
SCRATCH_DIR = "tallywire.scratch.dir"
_run: ContextVar[list[str] | None] = ContextVar("tallywire_scratch_run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is named by ``spark.checkpoint.dir``; where that is unset, by
    ``tallywire.scratch.dir``; where that is unset too, it is the warehouse, unless that is
    a folder of each machine's own disk, as it is by default: then this raises, because
    tasks elsewhere would write what nobody reads. Never a temporary folder.
    """
    for key in (_CHECKPOINT_DIR, SCRATCH_DIR):
        folder = spark.conf.get(key, None)
        if folder:
            return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if _may_be_private(spark, warehouse):
        raise ValueError(
            f"The warehouse {warehouse} is on each machine's own disk. Name a folder that driver and "
            f"executors share in {_CHECKPOINT_DIR} or {SCRATCH_DIR}.")
    return f"{warehouse}/_scratch"


def _master(spark: SparkSession) -> str:
    return spark.sparkContext.master


def _may_be_private(spark: SparkSession, path: str) -> bool:
    """Whether machines may each have a folder of this name: a plain file path on a cluster."""
    if _master(spark).startswith("local"):
        return False
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; belongs to the run around it, if any."""
    path = f"{shared_folder(spark)}/tallywire/{label}-{uuid.uuid4().hex}"
    made = _run.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, what this block and nothing else wrote to scratch paths.

    Results made inside must have been read or written before the block ends. Without
    a run, scratch tables stay: an unread result may still need them.
    """
    made: list[str] = []
    token = _run.set(made)
    try:
        yield
    finally:
        _run.reset(token)
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is; nothing happens if it is not there."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder where there is none yet."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(location)


def materialize(
    df: DataFrame, label: str, partition_by: str | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage at a point that outlives any executor, so values that a
    recomputation might assign differently stay as they were first written. A folder that is
    named as shared but is a plain file path (a mount, one hopes) is put to the test: if
    fewer rows come back than were written, this raises.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    rows, seen = df, None
    if _may_be_private(spark, path):
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
    writer.parquet(path, compression=compression)
    table = _table(spark, df.schema, path)
    if seen is not None and (found := table.count()) != (written := seen.get["rows"]):
        raise RuntimeError(f"{found} of {written} rows came back from {path}: executors don't share it.")
    return table


def _table(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
