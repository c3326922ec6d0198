"""Decontamination, licences, exact dedup, WARC, toxicity and packing."""

import hashlib
import io
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywire.llm import toxicity as tox
from tallywire.llm import warc
from tallywire.llm.decontaminate import _item_blocks, decontaminate, match_items
from tallywire.llm.exact_dedup import drop_exact_duplicates, duplicate_groups
from tallywire.llm.inputs import fitted_grammar, fold, vocabulary
from tallywire.llm.license_scan import PHRASES, scan_licenses
from tallywire.llm.packing import pack
from tallywire.llm.tokenizer import ByteBPE

PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return PLAIN.findall((text or "").encode().lower())


def found_by_hand(text, items, window):
    words, hit, names = plain(text), set(), set()
    for name, item in items:
        own = plain(item)
        size = min(window, len(own))
        windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                names.add(str(name))
    return len(words), hit, sorted(names)


ITEMS = [(1, "w1 w2 w3 w4 w5 w6"), (2, "a b"), (3, ""), (4, None), (5, "w4 W5 w6 w7 w8 w9 w10"),
         (5, "w4 W5 w6 w7 w8 w9 w10"), (6, "w1 w2 zzz")]


@pytest.mark.parametrize("block_words", [100_000, 4])
def test_matches_are_those_found_by_hand(spark, frame, hard, block_words):
    rows = hard + [(20, "q w1 w2 w3 w4, a b"), (21, "w1 w2 w3 a A b B w4 w5 w6 w7")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = match_items(frame(rows), items, window=4, block_words=block_words)
    assert got.columns == [*frame([]).columns]
    out = [(r.doc_id, r.match.n_words, [(s.first, s.last) for s in r.match.spans], r.match["items"])
           for r in got.collect()]
    want = []
    for i, text in rows:
        n, hit, names = found_by_hand(text, ITEMS, 4)
        spans = []
        for place in sorted(hit):
            if spans and spans[-1][1] + 1 == place:
                spans[-1][1] = place
            else:
                spans.append([place, place])
        want.append((i, n, [tuple(s) for s in spans], names))
    assert sorted(out, key=str) == sorted(want, key=str)


def test_repeated_and_long_items_go_in_small_blocks(spark, frame):
    long = " ".join(f"w{n * n % 911} Ünï{n % 7}," for n in range(2000))
    items = spark.createDataFrame([("r", "one two three four five")] * 500 + [("l", long), ("n", None)],
                                  "item_id string, text string")
    pieces, blocks = _item_blocks(items, "item_id", "text", 4, 320)
    held = [sum(len(plain(r.text)) for r in pieces.where(F.col("block") == b).collect())
            for b in range(blocks)]
    assert pieces.where("name = 'r'").count() == 1 and max(held) < 2 * 320
    words = long.split()
    texts = [" ".join(words[n:n + 4]) for n in range(0, 3900, 13)] + ["two three four five", "n"]
    got = match_items(frame(list(enumerate(texts))), items, window=4,
                      block_words=5000).select("doc_id", "match").collect()
    assert {r.doc_id: r.match["items"] for r in got} == {
        i: ["l"] if i < len(texts) - 2 else ["r"] if i == len(texts) - 2 else []
        for i in range(len(texts))}


def test_many_blocks_read_the_documents_once(spark, frame, tmp_path):
    rng = random.Random(8)
    words = [f"v{n}" for n in range(300)]
    items = [(n, " ".join(rng.choices(words, k=12))) for n in range(150)]
    rows = [(n, " ".join([*rng.choices(words, k=8), rng.choice(items)[1], "x", rng.choice(items)[1][:30]]))
            for n in range(60)]
    frame(rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert _item_blocks(table, "item_id", "text", 4, 20)[1] > 50
    many = match_items(docs, table, window=4, block_words=20)
    one = match_items(docs, table, window=4)
    assert sorted(many.collect()) == sorted(one.collect())
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    assert str(tmp_path / "docs") in many.inputFiles()[0]


def test_decontaminated_documents_keep_their_columns_and_lose_the_passages(spark, frame, hard):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(20, "Keep this, W1 w2 w3 w4 w5 w6. And that text too."), (21, "a b c"), *hard]
    docs = frame(rows)
    left = decontaminate(docs, items, window=4)
    assert left.schema.names == docs.schema.names
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[20] == "Keep this, . And that text too."
    assert 21 not in texts and 3 not in texts and texts[1] is None and texts[2] == ""
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, nothing).count() == len(rows)
    assert decontaminate(frame([]), items).count() == 0


@pytest.mark.parametrize("block_words", [100_000, 4])
def test_one_worker_finds_and_cuts_passages(spark, frame, block_words):
    docs = frame([(1, "x a b c d y z u v"), (2, "a b c d"), (3, None), (4, "ü a b c d ö b c d e f g h i j w"),
                  (5, ""), (6, "no hit")])
    items = spark.createDataFrame([("q", "a b c d"), ("r", "b c d e"), ("s", "k l m n o p q")],
                                  "item_id string, text string")
    left = decontaminate(docs, items, window=4, block_words=block_words)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    found = {row["doc_id"]: row["text"] for row in left.collect()}
    assert found == {1: "x  y z u v", 3: None, 4: "ü  ö  f g h i j w", 5: "", 6: "no hit"}


def test_licences(frame, hard):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(20, f"x {notice} y"), (21, "CC-BY cc by, All Rights reserved"), (22, "all rights"),
            (23, f"{notice} " * 3000), *hard]
    got = scan_licenses(frame(rows)).collect()
    for row in got:
        words = plain(row.text)
        want = sorted((i, label) for phrase, label in PHRASES.items()
                      for i in range(len(words)) if words[i:i + len(phrase.split())] ==
                      phrase.encode().split())
        assert [(p.first, p.label) for p in row.licenses.places] == want
        assert row.licenses.n_words == len(words)
    spans = {r.doc_id: r.licenses.spans for r in got}
    assert [(s.first, s.end, s.label) for s in spans[20]] == [(1, 9, "apache-2.0")]
    assert len(spans[23]) == 3000 and not spans[22] and not spans[1]
    assert scan_licenses(frame([])).count() == 0


@pytest.mark.parametrize("bucket_bytes", [128 << 20, 400])
def test_exact_groups(frame, hard, bucket_bytes):
    rows = hard + [(30 + n, f"t{n % 7}") for n in range(60)]
    got = duplicate_groups(frame(rows), bucket_bytes=bucket_bytes).collect()
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in groups}
    want = Counter((i, keep[t or ""], len(groups[t or ""]), sha[t or ""]) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(sha.values())
    assert all(r.doc_id == r.keep_id for r in kept)
    left = drop_exact_duplicates(frame(rows), bucket_bytes=bucket_bytes)
    assert left.schema.names == frame([]).schema.names
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == sorted(
        (keep[t], t) for t in groups)


def test_exact_dedup_of_nothing(frame):
    assert duplicate_groups(frame([])).count() == drop_exact_duplicates(frame([])).count() == 0


PAGES = [(n, f"http://x/{n % 5}", "page <b>" + "text " * (n % 4) * 40) for n in range(40)] + [
    (90, None, None), (91, "u\r\nX: y", ""), (92, "u", None)]


@pytest.mark.parametrize("range_bytes", [37, 1 << 20])
def test_archives_come_back_whole(spark, tmp_path, range_bytes):
    pages = spark.createDataFrame([(*p, 7) for p in PAGES],
                                  "page_id long, url string, html string, digest int")
    assert warc.write_warc(warc.with_revisits(pages.repartition(3)), str(tmp_path)) == len(PAGES)
    got = warc.read_warc(spark, str(tmp_path), range_bytes=range_bytes).collect()
    first = {}
    for i, _, html in PAGES:
        first.setdefault(html or "", i)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        revisit = len(data) >= 100 and first[html] != i
        want.append((str(i), "revisit" if revisit else "response",
                     str(first[html]) if revisit else None, len(data),
                     hashlib.sha256(data).hexdigest(), None if revisit else data))
    assert sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
                   None if r.payload is None else bytes(r.payload)) for r in got) == sorted(want)


def test_an_empty_page_table_makes_an_empty_archive(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_warc(warc.with_revisits(pages), str(tmp_path)) == 0
    assert warc.read_warc(spark, str(tmp_path)).count() == 0


def test_magic_inside_a_member_and_gaps_between_members_mislead_no_range():
    inner = b"--" + warc.GZIP_MAGIC + b"\x00" * 20 + warc.member(b"not a record") + b"--"
    records = [warc.record(str(n), "u", inner * n, hashlib.sha256(inner * n).hexdigest(), None)
               for n in range(5)]
    data = b"junk" + b"gap".join(warc.member(r, level=0) for r in records)
    for size in (1, 17, 1000, len(data)):
        got = [content for start in range(0, len(data), size)
               for _, content in warc.RangeReader(io.BytesIO(data), start,
                                                  min(len(data), start + size))]
        assert got == records


def weights(texts):
    grammar = tox._grammar(tox._known(), tox.UNFITTED)
    return [[c["weight"] for c in row["clauses"]]
            for row in grammar.match(pa.array(texts)).to_pylist()]


def test_clauses_are_weighed_by_what_stands_around():
    plain_, aimed, negated, reported, threat, none, split = weights(
        ["an idiot", "you idiot", "not an idiot", "they wrote about some idiot", "kill them",
         "kill time", "never. an idiot"])
    assert plain_ == [tox.KNOWN_INSULT] and aimed[0] > plain_[0] > negated[0] > 0
    assert reported[0] < plain_[0] and threat == [tox.KNOWN_THREAT] and none == []
    assert split == plain_


def test_toxicity_held_out_and_hard_rows(spark, frame, hard):
    sf = "/root/testdata/sf0.01"
    grammar = fitted_grammar(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(fold("doc_id", 3) == 1)
    rows = tox.score_toxicity(docs, grammar).join(labels, "doc_id").select(
        "toxic", "toxicity.score").collect()
    right = sum((r.score >= tox.THRESHOLD) == bool(r.toxic) for r in rows)
    assert right / len(rows) > 0.93
    kept = tox.drop_toxic(frame([*hard, (40, "You are an idiot and scum.")]), grammar)
    assert kept.schema.names == frame([]).schema.names
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in hard)
    assert tox.drop_toxic(frame([]), grammar).count() == 0


def test_a_grammar_without_labels_is_the_known_words(spark, frame, hard):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert tox.fit_grammar(frame(hard), none).scale == tox.UNFITTED


def test_ids_are_those_of_the_tokenizers_library(hard):
    from tokenizers import Tokenizer

    with open(vocabulary(), encoding="utf-8") as file:
        own = ByteBPE(file.read())
    theirs = Tokenizer.from_file(vocabulary())
    for text in [t or "" for _, t in hard] + ["a<|endoftext|>b <|endoftext|>", "don't 12 ,,\n\n  x",
                                              "emoji 🙂 ​", "<|endoftext|>"]:
        assert own.ids(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("partitions", [1, 70])
def test_packed_pieces_make_up_the_documents(frame, hard, partitions):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(vocabulary())
    rows = [(i, t) for i, t in hard if i is not None and i != 5] + [
        (100 + n, "some words " * (n % 50)) for n in range(300)]
    ids = {i: [*theirs.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    got = pack(frame(rows, partitions), vocabulary(), length=64, windows=4).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert own == ids[r.doc_id][r.start:r.start + len(own)] and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, len(own)))
        sequences[r.sequence_id].append((r.offset, len(own)))
    for runs, ends in ((pieces, {i: len(x) for i, x in ids.items()}), (sequences, {})):
        for name, parts in runs.items():
            at = 0
            for start, size in sorted(parts):
                assert start == at
                at += size
            assert at == ends[name] if ends else at <= 64
    assert set(pieces) == set(ids)
    padding = sum(64 - sum(n for _, n in s) for s in sequences.values())
    assert padding < 0.05 * sum(map(len, ids.values()))


def test_packing_of_nothing_and_of_repeated_rows(frame):
    assert pack(frame([]), vocabulary()).count() == 0
    got = pack(frame([(None, None), (1, "a"), (1, "a")]), vocabulary()).collect()
    assert sorted((str(r.doc_id), r.start, r.doc_tokens) for r in got) == [
        ("1", 0, 2), ("1", 0, 2), ("None", 0, 1)]
