"""Spelling variants, against every two words compared."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallywire.llm.spelling import _cut_long, crc_after, damaged_words, near_words, spelling_variants


def counted(rows, least=3):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[same + (len(a) >= len(b)):] == b[same + (len(b) >= len(a)):]


def variants(counts):
    forms, out = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [n, len(near), forms[w], counts[forms[w]] if forms[w] else None]
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def words_of(seed):
    """Words over few letters, so that runs, ties and chains of forms are common."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(150)]
    words += ["internationali" + "".join(rng.choices("abcz", k=rng.randint(0, 3))) for _ in range(60)]
    base = "".join(rng.choices("xyÿ", k=40))
    words += [base[:32], base[:33], base[:31], base[:34], base, base[:-1], base[:20] + "q" + base[21:],
              "q" + base, base + "q", "a" * 32, "a" * 33, "a" * 34, "z" * 5000, "z" * 5001]
    return {w: rng.choice([3, 3, 4, 7, 16, 40]) for w in words}


@pytest.mark.parametrize("options", [{"depth": 12}, {"depth": 8, "hot_rows": 1}])
def test_variants_are_those_of_all_pairs(spark, options):
    counts = words_of(1)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling_variants(df, **options).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == variants(counts)
    assert len(got) == len(counts)


def test_words_are_counted_over_whole_texts_and_damaged_alike(frame, hard):
    rng = random.Random(3)
    some = ["Straße", "über", "überall", "Überall", "naïve", "×÷×÷×", "ÀÉÎõü", "abcdef", "abcdéf", "x" * 6]
    rows = hard + [(n, " ".join(rng.choices(some, k=60)) + "1abcdef_ABCDEF") for n in range(100, 150)]
    rows += [(100, "abcdef Œuvre Œuvre Œuvre abcďefgh"), (None, "überall " * 400 + "y" * 100_000)]
    got = damaged_words(frame(rows)).collect()
    assert {r.word: r.n for r in got} == counted(rows)
    assert {r.word: r.n for r in got}.keys() > {"überall", "abcdef", "straße"}


def test_long_texts_are_cut_between_runs():
    rng = random.Random(1)
    text = "".join(rng.choices("abcÀé×÷œ.-1 \n", k=5000)) + "z" * 3000 + "!" + "é" * 900 + " end"
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", None, "d"]), pa.array(["x", text, None, "yy"])],
                                       ["id", "text"])
    for limit in (1, 7, 1000, 20_000):
        rows = [(i, t) for part in _cut_long([batch], limit) for i, t in zip(*(c.to_pylist() for c in part.columns))]
        assert "".join(t for i, t in rows if i == "b") == text
        runs = [r for i, t in rows if i == "b" for r in re.findall("[A-Za-zÀ-ÿ]+", t)]
        assert runs == re.findall("[A-Za-zÀ-ÿ]+", text)
        assert [t for i, t in rows if i is None] == [None] and "".join(t for i, t in rows if i == "d") == "yy"


def test_variants_of_nothing_and_of_one_word(spark, frame):
    assert damaged_words(frame([])).count() == 0
    none = spark.createDataFrame([], "word string, n long")
    assert spelling_variants(none).count() == 0
    one = spark.createDataFrame([("abcde", 3), (None, 5)], "word string, n long")
    row = spelling_variants(one).collect()
    assert [(r.word, r.form, r.root, r.n_near, r.form_n) for r in row] == [("abcde", None, "abcde", 0, None)]


def test_pairs_come_in_both_directions_once(spark):
    words = spark.createDataFrame([("aaaaa",), ("aaaaaa",), ("aaaab",), ("baaaa",)], "word string")
    got = sorted(tuple(r) for r in near_words(words).collect())
    assert got == sorted([("aaaaa", "aaaaaa"), ("aaaaaa", "aaaaa"), ("aaaaa", "aaaab"), ("aaaab", "aaaaa"),
                          ("aaaaa", "baaaa"), ("baaaa", "aaaaa")])


def test_checksums_go_on_from_what_stands_before():
    texts = [b"", b"a", b"\xc3\xa9t\xc3\xa9", b"x" * 200, b"abc" * 20]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    before = np.array([zlib.crc32(b"%d:" % n) for n in range(5)], np.uint32)
    got = crc_after(before, data, ends - [len(t) for t in texts], ends)
    assert got.tolist() == [zlib.crc32(b"%d:" % n + t) for n, t in enumerate(texts)]
