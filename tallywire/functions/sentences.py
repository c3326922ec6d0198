"""Text made from rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a document calls its key, and the separator between stuffed documents.
KEY_TITLES = {"source_id": "Source", "author": "Author"}
METADATA_NAMES = {"source_id": "source", "author": "author"}
CONTEXT_SEPARATOR = "\n\n"


def count_sentence(key: str, count: str) -> Column:
    """``Source: cnn, Number of articles: 7`` — an absent key reads ``None``."""
    return F.concat(
        F.lit(f"{KEY_TITLES[key]}: "), F.coalesce(F.col(key), F.lit("None")),
        F.lit(", Number of articles: "), F.col(count).cast("string"),
    )


def key_metadata(key: str) -> Column:
    return F.create_map(F.lit(METADATA_NAMES[key]), F.col(key))
