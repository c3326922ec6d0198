"""Ranked lexical search, against scores counted by hand."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallywire.llm.ball_tree import BallTree, Best, Matrix, Query, impacts, rank_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(rows, items, most=10):
    docs = [(i, Counter(t), len(t)) for i, t in ((i, terms_of(t)) for i, t in rows) if t]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, own, _ in docs for t in own)
    out = []
    for item, text in sorted({(i, t) for i, t in items if t is not None}, key=str):
        found = []
        for doc_id, own, n in docs:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * own[t] // (1000 * own[t] + 8 * m)) for t in terms_of(text) if t in own)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if none else doc, -score)
                for rank, (score, none, doc) in enumerate(sorted(found)[:most], 1)]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"W{n}" for n in range(120)] + ["Émile", "x1y2", "the", "The"] * 4
    rows = [(n, " ".join(rng.choices(words, k=rng.choice([1, 3, 10, 40, 200])))) for n in range(300)]
    rows += rows[:20] + [(900 + n, "the w1 w2 w3 émile") for n in range(15)]
    items = [(n, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for n in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (53, "unseen words"), (54, "w1 w1 W1"), (54, "w1 w1 W1"), (55, "the")]
    return rows, items


@pytest.mark.parametrize("options", [
    {}, {"leaf": 2, "block_terms": 20, "block_items": 3}, {"leaf": 5, "round_bytes": 400, "most": 3}])
def test_the_best_are_those_of_all_scores(spark, frame, hard, options):
    rows, items = corpus(4)
    rows = rows + hard
    asked = spark.createDataFrame([(i, t, "k", 3) for i, t in items],
                                  "item_id long, text string, score string, rank int")
    got = rank_documents(frame(rows), asked, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = ranked(rows, items, options.get("most", 10))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_text_ids_and_items_with_one_id(spark):
    docs = spark.createDataFrame([("b", "cat dog"), ("a", "cat dog"), (None, "cat dog"), ("c", "")],
                                 "name string, body string")
    items = spark.createDataFrame([("q", "cat"), ("q", "dog dog")], "key string, words string")
    got = rank_documents(docs, items, id_col="name", text="body", item_id="key", item_text="words").collect()
    assert [r.name for r in sorted(got, key=lambda r: (r.score, r.rank))] == ["a", "b", None] * 2


def test_search_in_nothing_and_for_nothing(spark, frame):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert rank_documents(frame([]), items).count() == 0
    assert rank_documents(frame([(1, None), (2, "")]), items).count() == 0
    assert rank_documents(frame([(1, "a b")]), items.where("false")).count() == 0


def tree_of(rng, n, width, clusters):
    rows = []
    for _ in range(n):
        base = rng.integers(0, clusters) * (width // clusters)
        rows.append(np.unique(base + rng.integers(0, width // clusters, rng.integers(1, 12))))
    heads = np.append(0, np.cumsum([len(r) for r in rows]))
    values = rng.integers(1, 1_000_000, heads[-1])
    weights = rng.integers(1, 12_000, width)
    return Matrix(heads, np.concatenate(rows), values), weights


@pytest.mark.parametrize("clusters", [1, 8])
def test_bounds_hold_and_leave_documents_out(clusters):
    rng = np.random.default_rng(clusters)
    documents, weights = tree_of(rng, 500, 64, clusters)
    tree = BallTree(documents, weights, 4)
    assert sorted(tree.order.tolist()) == list(range(500))
    for _ in range(20):
        query = Query(*np.unique(rng.integers(0, 8, 9), return_counts=True))
        dense = np.zeros(64, np.int64)
        dense[query.terms] = weights[query.terms] * query.times
        scores = documents.times(dense)
        for node, bound in enumerate(tree.bounds(query)):
            assert bound >= scores[tree.order[tree.first[node]:tree.end[node]]].max()
        best, tree.read = Best(5), 0
        best.names = list(range(500))
        tree.search(query, weights, best)
        want = sorted((-int(s), k) for k, s in enumerate(scores) if s > 0)[:5]
        assert [(s, k) for s, _, k in sorted(best.found)] == want
        if clusters > 1:
            assert tree.read < 250


def test_copies_make_a_tree_of_bounded_depth():
    documents = Matrix(np.arange(0, 2002, 2), np.tile([0, 3], 1000), np.tile([5, 7], 1000).astype(np.int64))
    tree = BallTree(documents, np.array([1, 1, 1, 2]), 4)
    assert len(tree.first) < 1000 and tree.sizes.max() == 1000
    best = Best(3)
    best.names = list(range(1000))
    tree.search(Query(np.array([3]), np.array([2])), np.array([1, 1, 1, 2]), best)
    assert {-s for s, _, _ in best.found} == {28} and len(best.found) == 3


def test_counts_of_very_long_documents_do_not_overflow():
    tf, n = np.array([1, 3_000_000_000]), np.array([10, 4_000_000_000])
    got = impacts(tf, n, 10**11, 10**13)
    m = [25 + 75 * int(k) * 10**11 // 10**13 for k in n]
    assert got.tolist() == [10**9 * int(t) // (1000 * int(t) + 8 * x) for t, x in zip(tf, m)]
