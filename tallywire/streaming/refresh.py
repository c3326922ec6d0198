"""Counts over a growing sink, kept up to date instead of recomputed."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallywire.commits import CommitLog
from tallywire.storage import delete

# Fixed value.
REFRESH_INTERVAL = "2 minutes"

# Changes are folded into the base when they are more than this share of it, or so many.
FOLD_SHARE = 0.25
MOST_DELTAS = 16
# Fewer changed rows than this are merged on read for nothing, and not folded for their share.
FOLD_ROWS = 10_000
# Refreshes whose folders stay, so that one still being read is not taken away.
KEEP = 2


def running_counts(
    spark: SparkSession, sink: str, schema: T.StructType, key: str, fmt: str = "parquet"
) -> DataFrame:
    """Sink rows per key; each refresh reads only the files added since the last."""
    return (
        spark.readStream.schema(schema).format(fmt).load(sink)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n_windows"))
    )


def _merged(spark: SparkSession, path: str, entry: dict, schema: T.StructType) -> DataFrame:
    """The rows of a base that no later change replaces, and the last change of each key."""
    read = spark.read.schema(schema)
    base = read.parquet(f"{path}/{entry['base']}")
    if not entry["deltas"]:
        return base
    changes = reduce(DataFrame.unionByName, (
        read.parquet(f"{path}/{name}").withColumn("_number", F.lit(number))
        for number, name in enumerate(entry["deltas"])))
    key = entry["key"]
    rest = [F.col(name) for name in schema.names if name != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), "_number").alias("_last")).select(
        key, "_last.*")
    # Changes are few beside the base, so the base is not shuffled but for the planner's choice.
    kept = base.join(last.select(key), key, "left_anti")
    return kept.unionByName(last).select(*schema.names)


def _written(rows: DataFrame, path: str) -> int:
    """Write a new folder; the number of its rows, counted on the way."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return seen.get["rows"]


def delta_sink(counts: DataFrame, path: str, checkpoint: str, fold_share: float = FOLD_SHARE,
               keep: int = KEEP, fold_rows: int = FOLD_ROWS) -> DataStreamWriter:
    """Write, for each refresh, the keys whose counts it changed; readers merge.

    Changes are folded into a new base when they have grown to ``fold_share`` of it and to
    ``fold_rows``, or are too many, so what is written stays in proportion to what changed. One entry of the folder's
    log names the base and the changes since, and is written last: a refresh that was broken
    off is not served, and one that comes again does nothing. ``counts`` has one key column,
    its first.
    """
    schema, key = counts.schema, counts.columns[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = CommitLog.of(spark, path)
        if batch_id <= log.last():
            return
        before = log.latest() or {"key": key, "base": None, "base_rows": 0, "deltas": [], "delta_rows": 0}
        name = f"delta={batch_id}-{uuid.uuid4().hex}"
        rows = _written(batch, f"{path}/{name}")
        if before["base"] is None:
            entry = before | {"base": name, "base_rows": rows}
        elif rows:
            entry = before | {"deltas": [*before["deltas"], name],
                              "delta_rows": before["delta_rows"] + rows}
        else:
            entry = before
        most = max(fold_rows, fold_share * entry["base_rows"])
        if entry["delta_rows"] > most or len(entry["deltas"]) > MOST_DELTAS:
            base = f"base={batch_id}-{uuid.uuid4().hex}"
            base_rows = _written(_merged(spark, path, entry, schema), f"{path}/{base}")
            entry = entry | {"base": base, "base_rows": base_rows, "deltas": [], "delta_rows": 0}
        # Folders that the entry gives up go ``keep`` refreshes later, when nobody reads them.
        left = {before["base"], *before["deltas"], name} - {entry["base"], *entry["deltas"], None}
        leaving = [*before.get("leaving", []), *([batch_id, old] for old in sorted(left))]
        gone = [old for number, old in leaving if number <= batch_id - keep]
        entry = entry | {"leaving": [[number, old] for number, old in leaving if old not in gone],
                         "written": rows}
        log.put(batch_id, entry)
        for old in gone:
            delete(spark, f"{path}/{old}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def latest_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All counts as of the newest refresh that was written to its end; none if there is none yet."""
    entry = CommitLog.of(spark, path).latest()
    if entry is None:
        return spark.createDataFrame([], schema)
    return _merged(spark, path, entry, schema)
