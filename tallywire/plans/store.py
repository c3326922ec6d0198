"""Documents embedded once and searched many times, in versions."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.commits import CommitLog
from tallywire.operators.documents import stuff_context
from tallywire.operators.embed import (
    DEFAULT_DIMENSIONS, TfIdfEmbedder, embed_corpus, embed_with_model,
)
from tallywire.operators.nearest import DEFAULT_K, nearest, vector_table
from tallywire.storage import delete, materialize

MakePredict = Callable[[], Callable]

# An update writes the store as one segment again when more of its rows than this are
# dead, or when it has more segments.
DEAD_SHARE = 0.25
MOST_SEGMENTS = 16
# Versions whose folders stay, for searches that began with them.
KEEP = 2


def attach_documents(hits: DataFrame, documents: DataFrame, document_id: str) -> DataFrame:
    """Look up the columns of found documents; a hit without a document keeps nulls.

    The hits are written first. Their size is then known to the planner, which
    broadcasts their ids to the documents when they are few, so that the texts not
    found are dropped where they are read instead of being shuffled.
    """
    hits = materialize(hits, "hits")
    found = documents.join(hits.select(document_id).distinct(), document_id)
    return hits.join(found, document_id, "left")


@dataclass(frozen=True)
class DocumentStore:
    """A folder with documents, a vector for each, and what embeds a question like them.

    A version of the store is a list of segments (documents and vectors) and a list of
    dead rows in them. Versions are entries of the folder's log, written last: a search takes
    the newest there is when it is planned, whatever is being built at the time. Folders
    that no version needs go ``KEEP`` versions later. One writer at a time.

    ``make_predict`` is the model the documents were embedded with, where it was not the
    default one; a model is the caller's and is not kept in the folder. Document ids are
    unique.
    """

    spark: SparkSession
    path: str
    document_id: str
    text: str = "page_content"
    make_predict: MakePredict | None = None

    def build(self, documents: DataFrame, dimensions: int = DEFAULT_DIMENSIONS) -> DocumentStore:
        """A new version from ``documents`` with all their columns, every text embedded anew.

        The default embedder is fitted to these documents.
        """
        segment, embedder = f"segment-{uuid.uuid4().hex}", None
        self._write(documents, f"{segment}/documents")
        texts = self._read(f"{segment}/documents").select(self.document_id, self.text)
        if self.make_predict is None:
            fitted, vectors = embed_corpus(texts, self.text, dimensions)
            embedder = f"embedder-{uuid.uuid4().hex}"
            fitted.save(self.spark, f"{self.path}/{embedder}")
        else:
            vectors = embed_with_model(texts, self.text, self.make_predict)
        self._write(vector_table(vectors, self.document_id, "embedding"), f"{segment}/vectors")
        self._publish({"segments": [segment], "dead": None, "embedder": embedder, "embedded": None})
        return self

    def update(self, documents: DataFrame, whole: bool = True) -> DocumentStore:
        """A new version that holds ``documents``; only new and changed texts are embedded.

        With ``whole`` these are all documents there are to be, and others go; otherwise the others
        stay. A document that changed but for its text keeps its vector. The default embedder
        stays as it was fitted by the last ``build``; the first version is built.
        """
        entry = self._log().latest()
        if entry is None:
            return self.build(documents)
        key, text = self.document_id, F.coalesce(F.col(self.text), F.lit(""))
        rows = F.xxhash64(F.to_json(F.struct(*sorted(documents.columns)), {"ignoreNullFields": "false"}))
        wanted = materialize(documents.select(F.col(key).alias("_id"), F.struct("*").alias("_document"),
                                              rows.alias("_row"), F.xxhash64(text).alias("_text")), "wanted")
        known = self._alive("documents", entry, list(documents.columns)).select(
            F.col(key).alias("_id"), "_segment", rows.alias("_old_row"), F.xxhash64(text).alias("_old_text"))
        # One row for each document on either side.
        both = materialize(wanted.drop("_document").withColumn("_is_wanted", F.lit(True))
                           .join(known, "_id", "full"), "wanted")
        there = F.col("_segment").isNotNull()
        changed = both.where("_is_wanted").where(~there | (F.col("_row") != F.col("_old_row")))
        gone = both.where(there).where(
            F.coalesce(F.col("_row") != F.col("_old_row"), F.lit(whole)))
        segment = f"segment-{uuid.uuid4().hex}"
        fresh = wanted.join(changed.select("_id"), "_id", "left_semi")
        self._write(fresh.select("_document.*"), f"{segment}/documents")
        same = there & F.coalesce(F.col("_text") == F.col("_old_text"), F.lit(False))
        copied = self._alive("vectors", entry).join(
            changed.where(same).select(F.col("_id").alias(key), "_segment"), [key, "_segment"], "left_semi")
        new = materialize(fresh.join(changed.where(~same).select("_id"), "_id", "left_semi").select(
            F.col("_id").alias(key), F.col(f"_document.{self.text}").alias(self.text)), "wanted")
        vectors = vector_table(self._embedded(new, self.text, entry), key, "embedding")
        self._write(vectors.unionByName(copied.drop("_segment")), f"{segment}/vectors")
        dead = f"dead-{uuid.uuid4().hex}"
        dying = gone.select(F.col("_id").alias(key), "_segment")
        if entry["dead"]:
            dying = dying.unionByName(self._read(entry["dead"]))
        self._write(dying, dead)
        entry = entry | {"segments": [*entry["segments"], segment], "dead": dead,
                         "embedded": new.count()}
        self._publish(self._compacted(entry))
        return self

    def _compacted(self, entry: dict) -> dict:
        """The same documents as one segment, if it is time."""
        every = reduce(DataFrame.unionByName, (
            self._read(f"{s}/documents").select(self.document_id) for s in entry["segments"]))
        if (self._read(entry["dead"]).count() <= DEAD_SHARE * every.count()
                and len(entry["segments"]) <= MOST_SEGMENTS):
            return entry
        segment = f"segment-{uuid.uuid4().hex}"
        for part in ("documents", "vectors"):
            self._write(self._alive(part, entry).drop("_segment"), f"{segment}/{part}")
        return entry | {"segments": [segment], "dead": None, "spare": [*entry["segments"], entry["dead"]]}

    def _log(self) -> CommitLog:
        return CommitLog.of(self.spark, self.path)

    def _publish(self, entry: dict) -> None:
        log = self._log()
        before, number = log.latest() or {}, log.last() + 1

        def named(e: dict) -> set[str]:
            return {*e.get("segments", []), e.get("dead"), e.get("embedder")} - {None}

        left = sorted((named(before) | set(entry.pop("spare", []))) - named(entry) - {None})
        leaving = [*before.get("leaving", []), *([number, folder] for folder in left)]
        stay = [pair for pair in leaving if pair[0] > number - KEEP]
        log.put(number, entry | {"leaving": stay})
        for _, folder in leaving[:len(leaving) - len(stay)]:
            delete(self.spark, f"{self.path}/{folder}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.parquet(f"{self.path}/{folder}")

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def _current(self) -> dict:
        entry = self._log().latest()
        if entry is None:
            raise FileNotFoundError(f"No version of a store in {self.path}")
        return entry

    def _alive(self, part: str, entry: dict, columns: list[str] | None = None) -> DataFrame:
        """Rows of all segments but the dead ones, with their ``_segment``."""
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (
            self._read(f"{s}/{part}").withColumn("_segment", F.lit(s)) for s in entry["segments"]))
        if columns is not None:
            # Columns that the store doesn't know yet are null there.
            rows = rows.select("_segment", *(F.col(c) if c in rows.columns else F.lit(None).alias(c)
                                             for c in columns))
        if entry["dead"] is None:
            return rows
        return rows.join(self._read(entry["dead"]), [self.document_id, "_segment"], "left_anti")

    def _embedded(self, rows: DataFrame, text: str, entry: dict) -> DataFrame:
        if self.make_predict is None:
            return TfIdfEmbedder.load(self.spark, f"{self.path}/{entry['embedder']}").embed(rows, text)
        return embed_with_model(rows, text, self.make_predict)

    def documents(self) -> DataFrame:
        return self._alive("documents", self._current()).drop("_segment")

    def search(self, questions: DataFrame, question_id: str, question: str = "question",
               k: int = DEFAULT_K) -> DataFrame:
        """The ``k`` nearest documents of each question: distance, rank, all their columns."""
        entry = self._current()
        asked = self._embedded(questions.select(question_id, question), question, entry)
        vectors = self._alive("vectors", entry).drop("_segment")
        hits = nearest(asked, vectors, question_id=question_id, corpus_id=self.document_id, k=k)
        return attach_documents(hits, self._alive("documents", entry).drop("_segment"), self.document_id)

    def contexts(self, questions: DataFrame, question_id: str, question: str = "question",
                 k: int = DEFAULT_K) -> DataFrame:
        """For each question the context made of its ``k`` nearest documents."""
        return stuff_context(self.search(questions, question_id, question, k), question_id,
                             self.text)
