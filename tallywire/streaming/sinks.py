"""Stream writers. Each returns a writer; the caller adds a trigger and starts it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallywire.streaming.late import LateRows


def console_sink(df: DataFrame, truncate: bool = True) -> DataStreamWriter:
    return df.writeStream.format("console").outputMode("append").option("truncate", truncate)


def parquet_sink(df: DataFrame, path: str, checkpoint: str, by_day: bool = False) -> DataStreamWriter:
    return _file_sink(df, "parquet", path, checkpoint, by_day)


def json_sink(df: DataFrame, path: str, checkpoint: str, by_day: bool = False) -> DataStreamWriter:
    """JSON lines: window bounds as ISO text, null fields left out."""
    return _file_sink(df, "json", path, checkpoint, by_day)


def _file_sink(df: DataFrame, fmt: str, path: str, checkpoint: str, by_day: bool) -> DataStreamWriter:
    # Append only: a window is written once, when the watermark has passed its end.
    rows = df.withColumn("day", F.to_date("window.start")) if by_day else df
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    # One folder for each day, which readers of a day need not look beyond.
    return writer.partitionBy("day") if by_day else writer


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Publish ``value`` rows; a batch is committed only after the broker has them."""
    return (
        messages.select("value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def run_available(writer: DataStreamWriter, late: LateRows | None = None) -> StreamingQuery:
    """Process everything there is, then stop; ``late`` is told of the rows dropped on the way."""
    writer = writer.trigger(availableNow=True)
    if late is None:
        query = writer.start()
        query.awaitTermination()
        return query
    with late.listening(SparkSession.active()):
        query = writer.start()
        late.follow(query)
        query.awaitTermination()
        late.wait()
    return query
