"""From documents to packed sequences: five stages, each a stored table.

A stage takes the table its predecessor left, works on all of it, and drops or changes what
it finds: documents the toxicity grammar rejects go; of equal texts one stays; of groups of
near duplicates one stays; passages of benchmark items go from the texts, and documents
made mostly of them go as a whole; what is left is packed into sequences of token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.llm.decontaminate import decontaminate
from tallywire.llm.exact_dedup import drop_exact_duplicates
from tallywire.llm.inputs import fitted_grammar, table, vocabulary, with_digests
from tallywire.llm.near_dedup import drop_near_duplicates
from tallywire.llm.packing import pack
from tallywire.llm.toxicity import drop_toxic
from tallywire.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return drop_toxic(docs, fitted_grammar(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on five-word shingles the smallest id."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the benchmark's passages, and their new lengths."""
    rest = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return rest.withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 token ids."""
    return with_digests(pack(docs, vocabulary()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

# A learned grammar and a tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
