"""The toxicity grammar and the whole pipeline, against plain versions of what they do."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallywire.llm import toxicity as tox
from tallywire.llm.inputs import fitted_grammar, vocabulary
from tallywire.llm.text import text_bytes

PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(text):
    return [(m.start(), m.group()) for m in PLAIN.finditer((text or "").encode().lower())]


def features(word):
    """A word and its stems, by the numbers the grammar knows them by."""
    data, _ = text_bytes(pa.array([word], pa.binary()))
    found = tox._features(data, np.array([0]), np.array([len(word)]))
    return [int(f[0]) for f in found]


class ByHand:
    """Scores a text clause by clause, word by word, from a grammar's lexicon and scale."""

    def __init__(self, grammar):
        self.lexicon = {int(h): (int(c), float(w)) for h, c, w in zip(
            grammar.hashes, grammar.classes, grammar.weights)}
        self.scale, self.known = grammar.scale, {}

    def word(self, word):
        if word not in self.known:
            whole, short, long = features(word)
            self.known[word] = next((self.lexicon[f] for f in (whole, long, short) if f and f in self.lexicon),
                                    (tox.OTHER, 0.0))
        return self.known[word]

    def clauses(self, text):
        data = (text or "").encode()
        words = plain(text)
        clauses = defaultdict(list)
        stops = [k for k, b in enumerate(data) if b in tox.CLAUSE_ENDS]
        at = 0
        for start, word in words:
            while at < len(stops) and stops[at] <= start:
                at += 1
            clauses[at].append(word)
        return list(clauses.values())

    def weight(self, words):
        last = {tox.NEGATION: None, tox.TARGET: None, tox.THREAT: None}
        reported, total = False, 0.0
        for place, word in enumerate(words):
            cls, own = self.word(word)
            near = {c: k is not None and place - k <= tox.REACH for c, k in last.items()}
            factor = (tox.NEGATED if near[tox.NEGATION] else 1) * (tox.REPORTED if reported else 1)
            if cls == tox.INSULT:
                total += factor * own * (tox.AIMED if near[tox.TARGET] else 1)
            elif cls == tox.TARGET and near[tox.THREAT]:
                total += factor * tox.KNOWN_THREAT
            if cls in last:
                last[cls] = place
            reported |= cls == tox.REPORT
        return total

    def score(self, text):
        weights = [w for w in map(self.weight, self.clauses(text)) if w > 0]
        bias, top, total = self.scale
        z = bias + top * max(weights, default=0) + total * math.log1p(sum(weights))
        return 1 / (1 + math.exp(-z))


def chat(rng, n, toxic=()):
    words = ["the", "cat", "is", "not", "you", "they", "said", "an", "idiot", "beat", "people", "never", "fool",
             "Vermin", "über", "wörtlich", "a", "of", *toxic]
    return ["".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ". ", "\n", "; ", " - "])
                    for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_scores_are_those_of_every_clause_word_by_word():
    rng = random.Random(4)
    lexicon = tox._known() | {features(b"snarkling")[1]: (tox.INSULT, 2.5), features(b"grumble")[0]: (tox.INSULT, 1.25)}
    grammar = tox._grammar(lexicon, (-3.0, 1.1, 0.7))
    texts = [*chat(rng, 400, ["snarkish", "snar", "grumble", "grumbles"]), None, "", "...", "idiot" * 3]
    got = grammar.match(pa.array(texts)).to_pylist()
    hand = ByHand(grammar)
    assert [r["score"] for r in got] == pytest.approx([hand.score(t) for t in texts], abs=1e-12)
    assert len({round(r["score"], 6) for r in got}) > 100


def learned_by_hand(toxic, clean):
    contexts, texts, counts = defaultdict(set), Counter(), Counter()
    for text in toxic:
        before, own = None, set()
        for _, word in plain(text):
            for f in filter(None, features(word)):
                contexts[f].add(before)
                own.add(f)
            before = word
        texts.update(own)
    for text in clean:
        counts.update({f for _, word in plain(text) for f in features(word) if f})
    candidates = [f for f, before in contexts.items() if len(before) >= 3]
    prior, out = len(toxic) / (len(toxic) + len(clean)), {}
    for f in candidates:
        seen, n = min(len(contexts[f]), texts[f]), min(len(contexts[f]), texts[f]) + counts[f]
        share = min(max(seen / n, 1e-9), 1 - 1e-9)
        excess = n * (share * math.log(share / prior) + (1 - share) * math.log((1 - share) / (1 - prior)))
        odds = math.log((seen + 0.5) / (len(toxic) + 1)) - math.log((counts[f] + 0.5) / (len(clean) + 1))
        if share > prior and excess >= math.log(len(candidates)) + 3 and odds >= 2:
            out[f] = (tox.INSULT, min(odds, 2 * tox.KNOWN_INSULT))
    return out


def test_learned_words_are_those_that_toxic_texts_have_too_often(spark):
    rng = random.Random(6)
    toxic = chat(rng, 150, ["gronk", "gronks", "blorfing"]) + ["always gronkette here"] * 40 + [None]
    clean = chat(rng, 600) + ["a gronk"] * 2
    frames = [spark.createDataFrame([(t,) for t in texts], "text string").repartition(3) for texts in (toxic, clean)]
    got = tox._learned(*frames, len(toxic), len(clean))
    want = learned_by_hand(toxic, clean)
    assert got.keys() == want.keys() and features(b"gronk")[0] in got and features(b"blorfing")[0] in got
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert [got[k][1] for k in want] == pytest.approx([v[1] for v in want.values()])
    # Copies of one text are no evidence for its own words.
    assert features(b"gronkette")[0] not in got


def shingles(text):
    words = SPACED.findall((text or "").encode().lower())
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_by_hand(rows):
    """Of each group linked by a similarity of 0.8 the smallest id; links by shared shingles."""
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    holders, label = defaultdict(list), {i: i for i in sets}
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, own in sets.items():
        shared = Counter(j for s in own for j in holders[s] if j < i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [r for r in rows if root(r["doc_id"]) == r["doc_id"]]


def decontaminated_by_hand(rows, items):
    windows = defaultdict(set)
    for item in items:
        own = [w for _, w in plain(item)]
        size = min(10, len(own))
        windows[size] |= {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if own else set()
    kept = []
    for row in rows:
        words, hit = plain(row["text"]), set()
        for size, known in windows.items():
            for k in range(len(words) - size + 1):
                if size and tuple(w for _, w in words[k:k + size]) in known:
                    hit |= set(range(k, k + size))
        if 2 * len(hit) > len(words):
            continue
        data, out, at = (row["text"] or "").encode(), b"", 0
        for k in sorted(hit):
            start, word = words[k]
            if k - 1 not in hit:
                out += data[at:start]
            at = start + len(word)
        text = row["text"] if not hit else (out + data[at:]).decode()
        kept.append(row | {"text": text, "n_chars": None if text is None else len(text)})
    return kept


def test_the_pipeline_is_what_its_stages_say(spark, small):
    from tokenizers import Tokenizer

    rows = [r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    hand = ByHand(fitted_grammar(spark, small))
    rows = [r for r in rows if hand.score(r["text"]) < tox.THRESHOLD]
    last = {}
    for r in rows:
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    rows = [r for r in rows if last[r["text"]] == r["doc_id"]]
    rows = decontaminated_by_hand(near_by_hand(rows), items)

    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, small), name)
    key = lambda r: r["doc_id"]
    assert sorted((r.asDict() for r in docs.collect()), key=key) == sorted(rows, key=key)

    theirs = Tokenizer.from_file(vocabulary())
    ids = {r["doc_id"]: [*theirs.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in rows}
    own, sequences = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, small).collect():
        piece = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(piece) and r.doc_tokens == len(ids[r.doc_id])
        own[r.doc_id].append((r.start, piece))
        sequences[r.sequence_id].append((r.offset, len(piece)))
    assert {i: sum((piece for _, piece in sorted(parts)), []) for i, parts in own.items()} == ids
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum(n for s in sequences.values() for _, n in s) > 0.97 * 2048 * (len(sequences) - 1)
