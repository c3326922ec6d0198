"""Column overview of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: place, type, rows and non-null rows, from a single pass."""
    totals = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("n_rows"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return totals.select(F.inline(F.array(*entries)))
