"""Rows as documents, and documents as one context text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.functions.sentences import CONTEXT_SEPARATOR, count_sentence, key_metadata


def key_documents(totals: DataFrame, key: str, count: str) -> DataFrame:
    """``page_content`` and ``metadata`` for every total."""
    return totals.select(
        count_sentence(key, count).alias("page_content"), key_metadata(key).alias("metadata")
    )


def stuff_context(hits: DataFrame, question: str, text: str = "page_content") -> DataFrame:
    """One text per question: its hits in rank order, a blank line between them.

    A question has at most k hits, so the gathered arrays are small by construction.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", text)))
    texts = F.transform(ranked, lambda hit: hit[text])
    return hits.groupBy(question).agg(
        F.count("*").alias("n_documents"),
        F.concat_ws(CONTEXT_SEPARATOR, texts).alias("context"),
    )
