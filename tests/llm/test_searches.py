"""Repeated passages, near duplicates, the language model, the pipeline and the queries."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from check import compare, connect
from tallywire.llm import exchange
from tallywire.llm import lm_scoring as lm
from tallywire.llm import near_dedup as near
from tallywire.llm.exchange import CHUNK_SCHEMA, batch_of, questions
from tallywire.llm.near_dedup import drop_near_duplicates, linked, near_duplicate_groups
from tallywire.llm.queries import ORACLE_SQL, QUERIES
from tallywire.llm.recompression import remove_repeats
from tallywire.llm.run_index import RunIndex, remove_repeated_bytes
from tallywire.storage import materialize


def passages(seed, n=60):
    """Documents from few words, with runs, shared passages, edited copies and periodic parts."""
    rng = random.Random(seed)
    words = [f"{c}{n}" for c in "abcde" for n in range(8)]
    shared = [" ".join(rng.choices(words, k=rng.randint(30, 120))) for _ in range(6)]
    shared += ["z " * 130, "p q r " * 40]
    docs = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else
                 " ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(rng.randint(0, 5))]
        text = " ".join(parts)
        if rng.random() < 0.4:
            own = text.split()
            if own:
                own[rng.randrange(len(own))] = "edit"
            text = "  ".join(own)
        docs.append((i, text))
    rng.shuffle(docs)
    return docs


def without_repeated_bytes(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[k:k + window] for t in texts for k in range(len(t) - window + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - window + 1):
            if counts[t[k:k + window]] > 1:
                gone[k:k + window] = True
        out.append((str(i), len(t), int(gone.sum()), bytes(np.frombuffer(t, np.uint8)[~gone]),
                    int((np.diff(np.append(0, gone.astype(int))) == 1).sum())))
    return sorted(out)


@pytest.mark.parametrize("options", [
    {}, {"chunk_bytes": 2000, "bucket_bytes": 2000, "index_symbols": 300},
    {"chunk_bytes": 4000, "most_occurrences": 2}])
def test_repeated_bytes(frame, hard, options):
    rows = passages(1) + [(i, None if t is None else t[:2000]) for i, t in hard]
    got = remove_repeated_bytes(frame(rows), window=60, name=24, **options).collect()
    assert sorted((str(r.id), r.n_bytes, r.n_removed, bytes(r.kept), len(r.spans))
                  for r in got) == without_repeated_bytes(rows, 60)


def test_repeated_bytes_at_the_registered_parameters(frame, hard):
    rng = random.Random(9)
    words = [f"w{n}" for n in range(400)]
    # Shared passages of 50 to 60 words below and above 400 bytes, and edges of exactly that.
    short = [" ".join(rng.choices(words, k=55)) for _ in range(5)]
    long = [" ".join(rng.choices(words, k=130)) for _ in range(5)] + ["x" * 399, "y" * 400, "z" * 401]
    rows = hard + [(100 + n, " ".join([rng.choice(short), f"own{n} " * 9, rng.choice(long), str(n)]))
                   for n in range(40)]
    got = remove_repeated_bytes(frame(rows)).collect()
    want = without_repeated_bytes(rows, 400)
    assert sorted((str(r.id), r.n_bytes, r.n_removed, bytes(r.kept), len(r.spans)) for r in got) == want
    assert max(len(p.encode()) for p in short) < 400 and sum(removed > 0 for _, _, removed, _, _ in want) > 20


def test_the_run_index_gives_the_longest_match_elsewhere():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(5, 8, 400), [1])
    text[200:260] = text[20:80]
    text[100] = 0
    got = RunIndex(text).matches()
    for p in range(len(text)):
        best = 0
        for q in range(len(text)):
            k = 0
            while p != q and max(p, q) + k < len(text) and text[p + k] == text[q + k]:
                k += 1
            best = max(best, k)
        assert got[p] == best


def without_earlier_words(rows, window):
    order = {None: math.inf}
    docs = [(order.get(i, i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in docs:
        for k in range(len(words) - window + 1):
            g = tuple(words[k:k + window])
            first[g] = min(first.get(g, math.inf), i)
    out = []
    for (i, words), (name, _) in zip(docs, rows):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((str(name), len(words), len(gone),
                    b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"chunk_bytes": 3000, "bucket_bytes": 2000})])
def test_repeated_words(frame, hard, seed, options):
    rows = passages(seed, 80) + hard
    got = remove_repeats(frame(rows), **options).collect()
    assert sorted((str(r.id), r.n_words, r.n_removed, r.text) for r in got) == (
        without_earlier_words(rows, 50))


def test_repeats_in_nothing(frame):
    assert remove_repeats(frame([])).count() == remove_repeated_bytes(frame([])).count() == 0
    with pytest.raises(ValueError, match="windows of 40"):
        remove_repeats(frame([]), window=40)


def near_copies(seed):
    rng = random.Random(seed)
    docs = []
    for base in range(8):
        words = [f"b{base}w{rng.randrange(500)}" for _ in range(rng.choice([6, 40, 150]))]
        for copy in range(rng.choice([1, 2, 9])):
            own = list(words)
            for _ in range(rng.choice([0, 1, 2, 5])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10 ** 6)}"
            docs.append(" ".join(own).upper() if copy % 2 else " ".join(own))
    # A chain: only neighbours of a few steps are linked, and all of it is one group.
    drift = [f"d{rng.randrange(500)}" for _ in range(100)]
    for step in range(24):
        drift[4 * step] = f"s{step}"
        docs.append(" ".join(drift))
    return list(enumerate(docs, 100))


def groups_by_hand(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                label = [label[b] if x == label[a] else x for x in label]
    least = {}
    for (i, _), g in zip(rows, label):
        least[g] = min(least.get(g, math.inf), math.inf if i is None else i)
    return sorted((str(i), len(s), str(None if least[g] == math.inf else least[g]))
                  for (i, _), s, g in zip(rows, sets, label))


@pytest.mark.parametrize("block", [256, 2])
def test_near_duplicates(frame, hard, block):
    rows = near_copies(5) + hard
    got = near_duplicate_groups(frame(rows), words=3, percent=85, block=block).collect()
    assert sorted((str(r.id), r.n_shingles, str(r.component_id)) for r in got) == (
        groups_by_hand(rows, 3, 85))
    if block == 2:
        return
    left = drop_near_duplicates(frame(rows), words=3, percent=85)
    assert left.schema.names == frame([]).schema.names
    want = Counter(str(r.id) for r in got if r.kept)
    assert Counter(str(r.doc_id) for r in left.collect()) == want
    assert near_duplicate_groups(frame([])).count() == drop_near_duplicates(frame([])).count() == 0


def template_family(templates, others, seed=3):
    """Texts that share a long template: two nearly only that, many with much of their own."""
    rng, docs, pairs = random.Random(seed), [], []
    for t in range(templates):
        words = [f"t{t}w{n}" for n in range(100)]
        pairs.append((len(docs), len(docs) + 1))
        for own in [8, 8, *[70] * others]:
            docs.append(" ".join(words + [f"o{rng.randrange(10 ** 9)}" for _ in range(own)]))
    return list(enumerate(docs)), pairs


def test_two_alike_among_many_with_the_same_template_are_found(frame):
    rows, pairs = template_family(3, 400)
    got = near_duplicate_groups(frame(rows), words=3, percent=85, band_block=100)
    found = {r.id: r.component_id for r in got.where("id <> component_id").collect()}
    assert found == {b: a for a, b in pairs}


def test_nodes_of_a_band_whose_pivot_is_unlike_both_are_compared(spark):
    alone = [[i * 0x0123456789ABCDE % (1 << 62)] * 16 for i in range(3, 9)]
    rows = [(i, [7] * near.BANDS, sketch) for i, sketch in enumerate(alone)]
    rows += [(20, [7] * near.BANDS, [5] * 16), (21, [7] * near.BANDS, [5] * 16)]
    nodes = spark.createDataFrame(rows, "node long, bands array<long>, sketch array<long>")
    for block in (2, 100):
        got = near._clusters(nodes, 85, block).collect()
        assert sorted(got) == [(20, 20), (21, 20)]


def test_links_within_and_between_blocks():
    sets = [np.array(s, np.uint64) for s in ([1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3, 5, 6], [9])]
    assert list(linked(sets, 0, 80)) == [(0, 1)]
    assert list(linked(sets, 1, 80)) == [(0, 1)]
    assert list(linked(sets, 2, 60)) == [(1, 2)]


def test_language_model(frame, hard):
    rows = [(n, f"{'The' if n % 3 else 'the'} cat {'sat on' if n % 2 else 'ran FROM'} the mat {n % 9}")
            for n in range(200)]
    rows += hard + [(500, "unseen words"), (501, None), (502, "É é ÀB àb THE")]
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    got = lm.score_documents(frame(rows), held, chunk_bytes=3000, bucket_bytes=2000).collect()
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    split = lambda t: [*(t or "").encode().lower().split(), None]  # noqa: E731  A-Z alone
    counts = Counter(w for i, t in rows if not is_held(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        w = split(t)
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want.append((str(i), is_held(i), len(w), sum(x in counts for x in w), n, round(base, 3)))
    assert sorted((str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 3)) for r in got) == sorted(want)
    cats = [r for r in got if r.held_out and r.id < 200]
    assert sum(r.score for r in cats) > sum(r.base_score for r in cats)
    assert lm.score_documents(frame([]), held).count() == 0
    alone = lm.score_documents(frame([(1, "a b")]), F.lit(True)).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens) == (3, 0, 0)
    assert math.isfinite(alone.score)


_BASE_OF_LM = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') || [' '] AS w,
    held FROM documents JOIN held USING (doc_id)),
t AS (SELECT doc_id, held, unnest(w) AS word FROM d),
c AS (SELECT word, count(*) AS c FROM t WHERE NOT held GROUP BY word),
a AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c)
SELECT doc_id, held, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens,
  round(sum(log10((coalesce(c, 0) + 0.1) / (n + 0.1 * (v + 1)))), 6) AS base_score
FROM t LEFT JOIN c USING (word), a GROUP BY doc_id, held"""


def test_language_model_counts_agree_with_sql(spark, small):
    got = queries()["op1_lm_scoring"](spark, small).collect()
    con = connect(small)
    held = pa.table({"doc_id": [r.doc_id for r in got],
                     "held": [zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in got]})
    con.register("held", held)
    want = con.execute(_BASE_OF_LM).fetchall()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == sorted(
        row[:5] for row in want)
    base = {row[0]: row[5] for row in want}
    assert all(r.base_score == pytest.approx(base[r.doc_id], abs=1e-5) for r in got)
    assert all(r.score < 0 for r in got)


def test_buckets_are_added_up_in_parts(frame, hard, monkeypatch):
    rows = passages(2) + [(i, None if t is None else t[:2000]) for i, t in hard]
    whole = {True: remove_repeats(frame(rows)).collect(),
             False: lm.score_documents(frame(rows), F.lit(False)).collect()}
    monkeypatch.setattr(exchange, "PART_KEYS", 7)
    assert len(exchange._cuts([np.arange(100, dtype=np.uint64), np.zeros(0, np.uint64)])) == 14
    key = lambda r: str(r[:3])
    assert sorted(remove_repeats(frame(rows)).collect(), key=str) == sorted(whole[True], key=str)
    for a, b in zip(*(sorted(rows_, key=key) for rows_ in (
            whole[False], lm.score_documents(frame(rows), F.lit(False)).collect()))):
        assert tuple(a)[:6] == tuple(b)[:6] and a.score == pytest.approx(b.score)


def test_counts_above_32_bits_are_exact_and_in_the_class_that_has_their_mass(spark):
    keys, shapes = np.array([5, 1 << 63], np.uint64), np.array([3, 4], np.uint8)
    rows = []
    for chunk in range(40):
        rows += [{"chunk": chunk, "bucket": -1, "ids": [chunk], "offsets": np.array([0, 2]).tobytes(),
                  "texts": lm.pack_numbers(np.array([0, 1])), "keys": np.zeros(2, np.uint16).tobytes(),
                  "counts": np.array([False]).tobytes(), "lows": shapes.tobytes()},
                 *questions(chunk, keys, np.array([2_000_000_000, 7]), shapes.astype(np.int64), 3)]
    asked = spark.createDataFrame(pa.Table.from_batches([batch_of(rows, CHUNK_SCHEMA)]))
    replies = lm._counted(asked)
    known = lm._vocabulary(replies)
    assert (known.n, known.v) == (80_000_000_280, 2)
    coded = lm.Coded(rows[0], replies.where("chunk = 0").toArrow(), known)
    assert coded.count.tolist() == [80_000_000_000, 280]
    assert known.class_n[coded.classes].tolist() == [80_000_000_000, 280]
    assert known.base(coded.count)[0] == pytest.approx(0, abs=1e-6)


@pytest.mark.parametrize("fan", [3, 100])
def test_changes_are_averaged_by_levels_of_bounded_groups(spark, fan):
    random_ = np.random.default_rng(2)
    changes = random_.normal(size=(41, 2, 6, 4)).astype(np.float32)
    touched = random_.random((41, 2, 6)) < 0.5
    changes[~touched] = 0
    rows = [(2 * u + 1, b, changes[u, b].tobytes(), touched[u, b].tobytes())
            for u in range(41) for b in range(2)]
    mean = lm.averaged(spark.createDataFrame(rows, lm.CHANGES).repartition(5), 2, 83, fan)
    levels = mean._jdf.queryExecution().analyzed().toString().count("FlatMapGroupsInArrow")
    assert levels == (4 if fan == 3 else 1)
    got = {r.block: np.frombuffer(r.change, np.float32).reshape(6, 4) for r in mean.collect()}
    want = changes.astype(np.float64).sum(axis=0) / np.maximum(1, touched.sum(axis=0))[:, :, None]
    assert sorted(got) == [0, 1]
    for b in got:
        np.testing.assert_allclose(got[b], want[b], rtol=1e-6)


def test_probabilities_add_up_to_one():
    shapes = np.arange(40) % lm.SHAPES
    counts = np.array([1, 2, 50, 7] * 10)
    known = lm.Vocabulary.build(lm._cell_sums(counts, shapes).astype(float))
    own = known.classes[lm.cell(counts, shapes)]
    share = np.exp(lm._log_softmax(np.random.default_rng(1).normal(size=(9, lm.CLASSES)),
                                   known.prior(), np.array([[0], [1], [2]])))[0]
    inside = np.bincount(own, 10.0 ** known.within(counts, own), lm.CLASSES)
    inside += 10.0 ** known.within(np.zeros(lm.CLASSES), np.arange(lm.CLASSES))
    assert share.sum() == pytest.approx(1) and np.allclose(inside, 1)
    numbers = np.array([0, 5, 70_000, 3 << 24], np.int64)
    assert lm.unpack_numbers(lm.pack_numbers(numbers), 4).tolist() == numbers.tolist()
    got = lm._group_sums(np.arange(40.0).reshape(20, 2), np.array([0, 1, 15]))
    assert np.allclose(got, np.add.reduceat(np.arange(40.0).reshape(20, 2), [0, 1, 15]))


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, small), name)
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == names
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] >= sizes[4] > 0
    own = docs.agg(F.countDistinct("doc_id")).first()[0]
    assert own == sizes[4]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "benchmark_decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, small, name):
    outcome, rows = compare(spark, connect(small), small, name)
    assert outcome == "ok" and rows > 0


def test_all_operators_are_registered():
    numbers = {name.split("_")[0] for name in QUERIES}
    assert numbers == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(queries())
