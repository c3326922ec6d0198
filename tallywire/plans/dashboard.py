"""What a dashboard shows, recomputed or kept current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallywire.operators.rollups import chart_data, data_status
from tallywire.streaming.refresh import REFRESH_INTERVAL, delta_sink, running_counts


def bars_or_status(counts: DataFrame, key: str, count: str) -> tuple[DataFrame, DataFrame]:
    """The bars, and the one-row status that replaces them when there are none."""
    return chart_data(counts, key, count), data_status(counts)


def live_counts(
    spark: SparkSession,
    sink: str,
    schema: T.StructType,
    key: str,
    path: str,
    checkpoint: str,
    every: str = REFRESH_INTERVAL,
) -> DataStreamWriter:
    counts = running_counts(spark, sink, schema, key)
    return delta_sink(counts, path, checkpoint).trigger(processingTime=every)
