"""Questions asked in words, answered from the totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.operators.documents import key_documents, stuff_context
from tallywire.operators.embed import DEFAULT_DIMENSIONS, embed_corpus, embed_with_model
from tallywire.operators.nearest import DEFAULT_K, nearest, vector_table
from tallywire.operators.rollups import top_total, total_per_key
from tallywire.plans.store import DocumentStore, MakePredict, attach_documents
from tallywire.storage import materialize

# The questions asked of each sink.
QUESTIONS = {
    "source_id": "Which source is having highest number of articles?",
    "author": "Which author has the highest number of articles?",
}


def retrieve(
    questions: DataFrame,
    documents: DataFrame,
    *,
    question_id: str,
    document_id: str,
    question: str = "question",
    text: str = "page_content",
    k: int = DEFAULT_K,
    dimensions: int = DEFAULT_DIMENSIONS,
    make_predict: MakePredict | None = None,
) -> DataFrame:
    """For each question the context made of its ``k`` nearest documents.

    Vectors are hashed tf-idf, or those of the model that ``make_predict`` loads. Nothing is
    kept for another time; a ``DocumentStore`` can be asked again.
    """
    texts = documents.select(document_id, text)
    if make_predict is None:
        embedder, vectors = embed_corpus(texts, text, dimensions)
        asked = embedder.embed(questions.select(question_id, question), question)
    else:
        vectors = materialize(embed_with_model(texts, text, make_predict), "vectors")
        asked = embed_with_model(questions.select(question_id, question), question, make_predict)
    hits = nearest(asked, vector_table(vectors, document_id, "embedding"),
                   question_id=question_id, corpus_id=document_id, k=k)
    return stuff_context(attach_documents(hits, texts, document_id), question_id, text)


def _documents(totals: DataFrame, key: str, count: str) -> DataFrame:
    """One sentence per total, with its metadata and an id."""
    return key_documents(totals, key, count).select(
        F.map_values("metadata")[0].alias("document_id"), "page_content", "metadata")


def totals_store(totals: DataFrame, key: str, count: str, path: str,
                 dimensions: int = DEFAULT_DIMENSIONS, make_predict: MakePredict | None = None,
                 update: bool = False) -> DocumentStore:
    """A store of one sentence per total, with its metadata.

    With ``update`` a store that is there gets a version in which only the totals that
    changed were embedded again.
    """
    documents = _documents(totals, key, count)
    store = DocumentStore(totals.sparkSession, path, "document_id", make_predict=make_predict)
    return store.update(documents) if update else store.build(documents, dimensions)


def answer(counts: DataFrame, key: str, count: str, question: str | None = None,
           k: int = DEFAULT_K, path: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """The retrieved context for a question, by default the key's, and the exact answer.

    A context of k documents cannot show every key; the exact answer ranks all. The
    totals serve several passes, so they are written once. A store is built only where
    ``path`` says so; ``options`` go to ``totals_store`` or ``retrieve``.
    """
    totals = materialize(total_per_key(counts, key, count), "totals")
    if path is not None:
        context = ask_store(totals_store(totals, key, count, path, **options), key, question, k)
    else:
        context = retrieve(_asked(totals.sparkSession, key, [question]), _documents(totals, key, count),
                           question_id="question_id", document_id="document_id", k=k, **options)
    return context, top_total(totals, key, count)


def _asked(spark: SparkSession, key: str, questions: Sequence[str | None]) -> DataFrame:
    """Questions with ids: the key for one, the key and a number for several."""
    rows = [(key if len(questions) == 1 else f"{key} {number}", question or QUESTIONS[key])
            for number, question in enumerate(questions, 1)]
    return spark.createDataFrame(rows, "question_id string, question string")


def ask_store(store: DocumentStore, key: str, question: str | Sequence[str] | None = None,
              k: int = DEFAULT_K) -> DataFrame:
    """The contexts for one question, by default the key's, or for several."""
    questions = [question] if question is None or isinstance(question, str) else list(question)
    return store.contexts(_asked(store.spark, key, questions), "question_id", k=k)
