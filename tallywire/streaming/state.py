"""What a running count holds back, read from its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def open_windows(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The windows that the count with this checkpoint has not written yet, as its sink would have them.

    ``schema`` is the sink's: the window, the key and the count, under the names the count
    gave them. State is read as of the last batch that was committed, partition by
    partition where it lies; the query may be running.
    """
    state = spark.read.format("statestore").load(checkpoint)
    (value,) = state.schema["value"].dataType.names
    # Grouping columns have names of Spark's own there: the window's begins alike, the other is the key.
    names = state.schema["key"].dataType.names
    (window,) = [name for name in names if name.startswith("window")]
    (key,) = [name for name in names if name != window]

    def column(name: str):
        if name == "window":
            return F.col(f"key.`{window}`")
        return F.col(f"key.`{key}`" if name in schema.names[:2] else f"value.`{value}`")

    return state.select(*(column(name).cast(schema[name].dataType).alias(name) for name in schema.names))


def whole_counts(spark: SparkSession, sink: DataFrame, checkpoint: str, schema: T.StructType) -> DataFrame:
    """What has been written and what is still open: all counts so far, with ``is_open``."""
    opened = open_windows(spark, checkpoint, schema).withColumn("is_open", F.lit(True))
    return sink.withColumn("is_open", F.lit(False)).unionByName(opened)
