"""The message stream: rows with one binary ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.schemas import MESSAGE


def kafka_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options of a topic subscription; it starts at the latest offsets unless told otherwise."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """A topic as a stream. Needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topic, **extra)
    return spark.readStream.format("kafka").options(**options).load().select("value")


def publish_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch of messages to a topic; returns once the broker has taken them all."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def landed_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A folder of message files as a stream of the same shape as a topic."""
    return spark.readStream.schema(MESSAGE).options(**options).parquet(path)


def land_messages(messages: DataFrame, path: str) -> str:
    """Add messages to such a folder."""
    messages.select(F.col("value").cast("binary").alias("value")).write.mode("append").parquet(path)
    return path
