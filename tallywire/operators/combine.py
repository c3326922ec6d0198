"""Putting frames together and taking nested columns apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flatten_nested(df: DataFrame, separator: str = ".") -> DataFrame:
    """Struct fields as columns of their own, named by their path."""

    def leaves(fields: list[T.StructField], path: tuple[str, ...]) -> list[Column]:
        found: list[Column] = []
        for field in fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType.fields, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                found.append(F.col(quoted).alias(separator.join(here)))
        return found

    return df.select(*leaves(df.schema.fields, ()))
