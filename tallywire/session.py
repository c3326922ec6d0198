"""Session settings the rest of the package relies on."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State lives in RocksDB (off-heap, spilling to disk) so that the number of open
# (window, key) groups is not bounded by executor heap; changelog checkpoints
# upload only what a micro-batch changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_PARTITION_BYTES = 128 << 20


def pin_utc(spark: SparkSession) -> SparkSession:
    """Read and bucket times in UTC.

    The date pattern quotes its ``Z``, so the text carries no zone and would
    otherwise be read in whatever zone the session happens to use.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Enough partitions to keep each near 128 MB and, at least, every core busy."""
    waves = max(1, math.ceil(shuffled_bytes / _PARTITION_BYTES / cores))
    return waves * cores


@contextmanager
def stateful(spark: SparkSession, partitions: int | None = None) -> Iterator[SparkSession]:
    """Settings that a stateful query started inside the block takes with it.

    The number of state partitions is fixed by a checkpoint's first run and adaptive
    execution does not change it, so give ``partitions`` for the peak and not for the
    first load. Left out, there is one per core; on a cluster, whose executors may
    not all be there yet, no fewer than the session's shuffle partitions.
    """
    if partitions is None:
        context = spark.sparkContext
        partitions = context.defaultParallelism
        if not context.master.startswith("local"):
            partitions = max(partitions, int(spark.conf.get(_SHUFFLE_PARTITIONS)))
    wanted = {**STATE_STORE, _SHUFFLE_PARTITIONS: str(partitions)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallywire")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config(_SHUFFLE_PARTITIONS, str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
