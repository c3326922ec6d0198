"""Positions in a total order, without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.storage import materialize

# monotonically_increasing_id() puts the partition number above this bit and the
# row's place within the partition below it.
_PARTITION_BIT = 33


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row under ``order``.

    ``order`` must be total (end in a unique key). A range-partitioned sort numbers
    the rows of every partition in parallel; the rank is that place plus the sizes
    of the partitions before it. The numbered rows are written out first, because
    sizes and places have to come from one and the same partitioning.
    """
    place = F.monotonically_increasing_id()
    numbered = materialize(df.orderBy(*order).withColumn("_place", place), "ranked")

    partition = F.shiftright("_place", _PARTITION_BIT)
    sizes = numbered.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    # One row per sort partition, at most spark.sql.shuffle.partitions of them:
    # small enough for one running sum and for a broadcast.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    local = F.col("_place").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return (
        numbered.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + local + 1)
        .drop("_place", "_partition", "_offset")
    )
