"""Sinks of many small files as few large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_BYTES = 128 << 20


def compact(counts: DataFrame, path: str, fmt: str = "parquet", before: str | None = None) -> None:
    """Write counts to one folder per day of their windows, in files of some size.

    ``before`` (a date) leaves later days out, as they may still grow; null windows never
    occur in a sink. Days already there are replaced and others are kept, so the job may
    run again. Rows are dealt out by day with as many tasks for each as its size asks
    for, so a large day is no single task and a small one a single file. While it runs the
    session of ``counts`` has another size of partitions, so give it a session of its own
    (``spark.newSession()``) where others use that one meanwhile.
    """
    spark = counts.sparkSession
    day = F.to_date("window.start")
    rows = counts if before is None else counts.where(day < F.lit(before).cast("date"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(size)
    spark.conf.set(size, str(FILE_BYTES))
    try:
        (rows.withColumn("day", day).hint("rebalance", "day")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").format(fmt).save(path))
    finally:
        spark.conf.set(size, usual)
