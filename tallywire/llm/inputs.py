"""The given tables, and what operators are fitted to, for queries and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.llm.toxicity import Grammar, fit_grammar


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, parts: int):
    """crc32 of an id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def fitted_grammar(spark: SparkSession, sf_dir: str) -> Grammar:
    """The toxicity grammar, from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    return fit_grammar(table(spark, sf_dir, "documents"), labels.select("doc_id", "toxic"))


def vocabulary() -> str:
    """The tokenizer file for packing, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def with_digests(pieces: DataFrame) -> DataFrame:
    """Packed pieces with the length and the checksum of their ids."""
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")
