"""Neighbours against brute force; embeddings against their definition."""

import math
import re

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallywire.operators import nearest as module
from tallywire.operators.embed import embed_corpus, embed_with_model
from tallywire.operators.documents import stuff_context
from tallywire.operators.nearest import nearest, vector_table
from tallywire.operators.embed import TfIdfEmbedder
from tallywire.plans.answers import QUESTIONS, answer, retrieve
from tallywire.plans.store import DocumentStore, attach_documents


def brute_force(questions, corpus, k):
    found = set()
    for qid, q in questions:
        near = sorted(
            (round(math.sqrt(sum((a - b) ** 2 for a, b in zip(q, x))), 6), cid)
            for cid, x in corpus if x is not None
        )[:k]
        found |= {(qid, cid, d, rank) for rank, (d, cid) in enumerate(near, start=1)}
    return found


def rows_of(df):
    return {(r.qid, r.cid, r.distance, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def vectors():
    # A third of the corpus are copies of one vector, so ties abound.
    rng = np.random.default_rng(11)
    points = rng.normal(size=(3000, 8)).astype(np.float32).round(2)
    points[::3] = points[0]
    corpus = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    questions = [(1000 + i, corpus[i][1]) for i in (0, 1, 2, 5, 700, 2999)]
    questions += [(2000 + i, [float(v) for v in rng.normal(size=8).astype(np.float32)])
                  for i in range(15)]
    return questions, corpus


def frames(spark, questions, corpus, id_type="long"):
    return (
        spark.createDataFrame(questions, "qid long, embedding array<float>"),
        spark.createDataFrame(corpus, f"cid {id_type}, embedding array<float>").repartition(7),
    )


@pytest.mark.parametrize("block_bytes", [16 << 20, 5 * 8 * 8])
@pytest.mark.parametrize("k", [1, 4, 50])
def test_exact_with_one_block_or_many(spark, vectors, block_bytes, k):
    questions, corpus = vectors
    q, c = frames(spark, questions, corpus)
    got = nearest(q, c, question_id="qid", corpus_id="cid", k=k, block_bytes=block_bytes)
    assert rows_of(got) == brute_force(questions, corpus, k)


def test_text_ids_null_vectors_and_a_small_corpus(spark, vectors):
    questions, corpus = vectors
    named = [(f"doc{i}", p) for i, p in corpus[:3]] + [("none", None)]
    q, c = frames(spark, questions, named, "string")
    got = nearest(q, c, question_id="qid", corpus_id="cid", k=4)
    assert rows_of(got) == brute_force(questions, named, 4)


def test_close_vectors_far_from_the_origin(spark):
    # Squared norms near 1e9 leave the product form no digits for these distances.
    rng = np.random.default_rng(5)
    points = (10_000 + rng.integers(-3, 4, size=(500, 8)) / 64).astype(np.float32)
    corpus = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    questions = [(i, corpus[i][1]) for i in range(0, 500, 25)]
    q, c = frames(spark, questions, corpus)
    got = nearest(q, c, question_id="qid", corpus_id="cid")
    assert rows_of(got) == brute_force(questions, corpus, 4)


def test_many_tasks_and_merge_groups(spark, vectors, monkeypatch):
    monkeypatch.setattr(module, "_MERGE_GROUPS", 3)
    questions, corpus = vectors
    q, c = frames(spark, questions, corpus)
    got = nearest(q, c.repartition(40), question_id="qid", corpus_id="cid")
    assert rows_of(got) == brute_force(questions, corpus, 4)


def test_no_questions(spark, vectors):
    q, c = frames(spark, *vectors)
    assert nearest(q.where("false"), c, question_id="qid", corpus_id="cid").count() == 0


def test_question_vectors_must_be_of_one_width(spark, vectors):
    q, c = frames(spark, [(1, [1.0]), (2, [1.0, 2.0])], vectors[1])
    with pytest.raises(ValueError, match="1 to 2 numbers"):
        nearest(q, c, question_id="qid", corpus_id="cid")


def test_repeated_question_ids_are_refused_when_they_cannot_be_split(spark, vectors):
    questions, corpus = vectors
    q, c = frames(spark, [(1, p) for _, p in questions], corpus)
    with pytest.raises(ValueError, match="not unique"):
        nearest(q, c, question_id="qid", corpus_id="cid", block_bytes=5 * 8 * 8)


@pytest.mark.parametrize("block_bytes", [16 << 20, 5 * 8 * 8])
def test_any_input_has_one_outcome_whatever_the_block_size(spark, vectors, block_bytes):
    questions, corpus = vectors

    def ask(q, c, k=4):
        return nearest(*frames(spark, q, c), question_id="qid", corpus_id="cid", k=k,
                       block_bytes=block_bytes)

    with pytest.raises(ValueError, match="not unique"):
        ask([*questions, questions[0]], corpus).count()
    with pytest.raises(ValueError, match="NaN, infinity or null"):
        ask([*questions, (1, [math.nan] * 8)], corpus).count()
    with pytest.raises(Exception, match="corpus vectors have"):
        ask(questions, [*corpus, (9000, [1.0] * 7), (9001, [1.0] * 9)]).count()
    lost = [(9000 + i, [x] + [0.0] * 7) for i, x in enumerate([math.nan, math.inf, None])]
    whole = ask(questions, [*corpus, (None, [0.0] * 8), *lost])
    assert rows_of(whole) == brute_force(questions, corpus, 4)
    few = ask(questions, [*lost, *corpus[1:3]])
    for row in few.collect():
        assert (row.cid in (9000, 9001, 9002)) == (row["rank"] > 2)
        if row["rank"] > 2:
            assert (row["rank"], row.cid) in {(3, 9001), (4, 9000)}


def test_vector_table_leaves_out_null_vectors(spark):
    df = spark.sql("select * from values (1, array(1d, 2d)), (2, null) as t(id, v)")
    table = vector_table(df, "id", "v")
    assert table.schema["v"].dataType.simpleString() == "array<float>"
    assert [r.id for r in table.collect()] == [1]


def bucket_of(spark, words, dimensions):
    """Where each word on its own is counted."""
    single = spark.createDataFrame([([w],) for w in words], "words array<string>")
    counted = HashingTF(inputCol="words", outputCol="c", numFeatures=dimensions).transform(single)
    place = F.array_position(vector_to_array("c"), 1.0) - 1
    return {r.word: r.place for r in
            counted.select(F.col("words")[0].alias("word"), place.alias("place")).collect()}


def test_embedding_follows_its_definition(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    _, vectors = embed_corpus(documents, "text", 64)
    got = {r.doc_id: r.embedding for r in vectors.collect()}

    split = {row.doc_id: [w for w in re.split(r"[ \t\n\x0b\f\r]+", row.text.lower()) if w]
             for row in documents.collect()}
    bucket = bucket_of(spark, {word for parts in split.values() for word in parts}, 64)
    counts = {doc_id: np.bincount([bucket[w] for w in parts], minlength=64).astype(float)
              for doc_id, parts in split.items()}
    assert set(got) == set(counts)
    matrix = np.array(list(counts.values()))
    idf = np.log((len(counts) + 1) / ((matrix > 0).sum(axis=0) + 1))
    for doc_id, vector in counts.items():
        weighted = vector * idf
        length = np.linalg.norm(weighted)
        expected = weighted / length if length else weighted
        np.testing.assert_allclose(got[doc_id], expected, atol=1e-5)


def test_own_model(spark):
    def make_predict():
        def predict(texts):
            return np.array([[len(t), t.count("a")] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([("banana",), ("xyz",)], "text string")
    got = {r.text: r.embedding for r in embed_with_model(df, "text", make_predict).collect()}
    assert got == {"banana": [6.0, 3.0], "xyz": [3.0, 0.0]}


def test_retrieval_with_own_model(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def make_predict():
        def predict(texts):
            with open(seen, "a") as file:
                file.writelines("x\n" for _ in texts)
            return np.array([[len(t), t.count("?")] for t in texts], dtype=np.float32)

        return predict

    questions = spark.createDataFrame([(1, "how?"), (2, "a much longer question")],
                                      "q int, question string")
    documents = spark.createDataFrame([(i, "x" * i) for i in range(1, 31)],
                                      "d int, page_content string")
    got = retrieve(questions, documents, question_id="q", document_id="d", k=2,
                   make_predict=make_predict)
    assert {r.q: r.context for r in got.collect()} == {
        1: "xxxx\n\nxxx", 2: "x" * 22 + "\n\n" + "x" * 21}
    with open(seen) as file:
        assert len(file.readlines()) == 30 + 2


def test_a_store_embeds_once_and_answers_any_number_of_times(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def make_predict():
        def predict(texts):
            with open(seen, "a") as file:
                file.writelines("x\n" for _ in texts)
            return np.array([[len(t), 0] for t in texts], dtype=np.float32)

        return predict

    documents = spark.createDataFrame([(i, "x" * i, {"n": str(i)}) for i in range(1, 21)],
                                      "d int, page_content string, metadata map<string, string>")
    store = DocumentStore(spark, str(tmp_path / "store"), "d", make_predict=make_predict)
    store.build(documents)
    for size in (3, 9, 15):
        asked = spark.createDataFrame([(size, "y" * size)], "q int, question string")
        (hit,) = store.search(asked, "q", k=1).collect()
        assert (hit.d, hit.distance, hit.metadata) == (size, 0.0, {"n": str(size)})
    with open(seen) as file:
        assert len(file.readlines()) == 20 + 3


def test_a_saved_embedder_is_the_same(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b c"), (2, "a d"), (3, None)], "i int, text string")
    embedder, vectors = embed_corpus(df, "text", 32)
    embedder.save(spark, str(tmp_path / "full"))
    again = TfIdfEmbedder.load(spark, str(tmp_path / "full"))
    assert again.embed(df, "text").orderBy("i").collect() == vectors.orderBy("i").collect()
    empty, _ = embed_corpus(df.where("false"), "text", 16)
    empty.save(spark, str(tmp_path / "empty"))
    assert TfIdfEmbedder.load(spark, str(tmp_path / "empty")) == TfIdfEmbedder(None, 16)


def test_blocks_are_as_few_as_the_bound_allows(spark, vectors, monkeypatch):
    questions, corpus = vectors
    passes = []
    search = module._search
    monkeypatch.setattr(module, "_search", lambda *a: passes.append(1) or search(*a))
    q, c = frames(spark, questions, corpus)
    nearest(q, c, question_id="qid", corpus_id="cid", block_bytes=5 * (8 * 8 + 5)).count()
    assert len(passes) == -(-len(questions) // 5)


def test_context_is_in_rank_order_with_blank_lines(spark):
    hits = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, None), (2, 1, "z")],
                                 "q int, rank int, page_content string")
    got = {r.q: (r.n_documents, r.context) for r in stuff_context(hits, "q").collect()}
    assert got == {1: (3, "a\n\nc"), 2: (1, "z")}


def test_texts_are_dropped_at_the_scan_when_hits_are_few(spark, tmp_path):
    spark.range(1000).select(
        F.col("id").alias("doc"), F.col("id").cast("string").alias("text")
    ).write.parquet(str(tmp_path / "docs"))
    documents = spark.read.parquet(str(tmp_path / "docs"))
    hits = spark.createDataFrame([(1, 5), (1, 2000)], "q int, doc long")
    found = attach_documents(hits, documents, "doc")
    assert {(r.doc, r.text) for r in found.collect()} == {(5, "5"), (2000, None)}
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_answer(spark):
    counts = spark.createDataFrame(
        [("cnn", 3), ("bbc", 5), ("cnn", 4), ("fox", 1), (None, 90), ("sky", 2), ("cbc", 2)],
        "source_id string, article_count long")
    context, exact = answer(counts, "source_id", "article_count")
    assert tuple(exact.first()) == ("cnn", 7)
    (row,) = context.collect()
    assert row.question_id == "source_id" and row.n_documents == 4
    texts = {f"Source: {s}, Number of articles: {n}"
             for s, n in (("cnn", 7), ("bbc", 5), ("fox", 1), ("sky", 2), ("cbc", 2))}
    parts = row.context.split("\n\n")
    assert len(set(parts)) == 4 and set(parts) <= texts
    assert set(QUESTIONS) == {"source_id", "author"}
