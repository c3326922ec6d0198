"""Vectors for texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import HashingTF, IDF, IDFModel, Normalizer, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.storage import materialize

DEFAULT_DIMENSIONS = 256


def word_counts(df: DataFrame, text: str, dimensions: int = DEFAULT_DIMENSIONS) -> DataFrame:
    """Hashed counts of the lower-case words of the whole text, in place of the text."""
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern="\\s+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions)
    texts = df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).drop(text)
    return counts.transform(words.transform(texts)).drop("_text", "_words")


@dataclass(frozen=True)
class TfIdfEmbedder:
    """Weighs hashed word counts by rarity and scales them to unit length.

    Fitting is one aggregation whose result is a vector of fixed width, whatever
    the number of texts; applying it is a projection. Both stay in the JVM. Without
    a single document to fit on there are no weights, and counts are only scaled.
    """

    weights: IDFModel | None
    dimensions: int

    def save(self, spark: SparkSession, path: str) -> None:
        """Keep the weights below ``path``, over what was there."""
        if self.weights is not None:
            self.weights.write().overwrite().save(f"{path}/weights")
        spark.range(1).select(F.lit(self.dimensions).alias("dimensions"),
                              F.lit(self.weights is not None).alias("weighted")
                              ).write.mode("overwrite").parquet(f"{path}/shape")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TfIdfEmbedder:
        shape = spark.read.schema("dimensions int, weighted boolean").parquet(f"{path}/shape").first()
        weights = IDFModel.load(f"{path}/weights") if shape["weighted"] else None
        return cls(weights, shape["dimensions"])

    @classmethod
    def fit(cls, counts: DataFrame, dimensions: int = DEFAULT_DIMENSIONS) -> TfIdfEmbedder:
        if counts.isEmpty():
            return cls(None, dimensions)
        return cls(IDF(inputCol="_counts", outputCol="_weighted").fit(counts), dimensions)

    def embed_counts(self, counts: DataFrame, output: str = "embedding") -> DataFrame:
        if self.weights is None:
            weighted = counts.withColumn("_weighted", F.col("_counts"))
        else:
            weighted = self.weights.transform(counts)
        vectors = Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0).transform(weighted)
        return vectors.withColumn(output, vector_to_array("_unit", "float32")).drop(
            "_counts", "_weighted", "_unit"
        )

    def embed(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        return self.embed_counts(word_counts(df, text, self.dimensions), output)


def embed_corpus(
    documents: DataFrame, text: str, dimensions: int = DEFAULT_DIMENSIONS
) -> tuple[TfIdfEmbedder, DataFrame]:
    """An embedder fitted on the documents, and the documents with a vector for their text.

    Weights depend on all texts, so two passes are needed. The counts are written
    out between them: the second pass reads those, not the texts again.
    """
    counts = materialize(word_counts(documents, text, dimensions), "word-counts")
    embedder = TfIdfEmbedder.fit(counts, dimensions)
    return embedder, embedder.embed_counts(counts)


def embed_with_model(
    df: DataFrame,
    text: str,
    make_predict: Callable[[], Callable],
    output: str = "embedding",
    batch_size: int = 256,
) -> DataFrame:
    """Vectors from a model of the caller's.

    ``make_predict`` runs once per Python worker, loads the model there and returns
    a function from a batch of texts to a matrix with one row per text. A null text is
    an empty one. Later filters on the vector do not make the model run again.
    """
    predict = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return df.withColumn(output, predict.asNondeterministic()(F.coalesce(F.col(text), F.lit(""))))
