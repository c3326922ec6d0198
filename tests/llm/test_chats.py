"""Conversations as text: spans against whole renderings, and every text read back."""

import hashlib
import itertools
import random
import sys

import pytest
from pyspark import cloudpickle

from tallywire.llm.chat_format import (
    digests, escape, format_chats, located, read_back, render, unescape,
)
from tallywire.storage import materialize

# The templates below are the caller's, and workers have no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "conv_id long, turn long, role string, text string, part int, n_parts string, size long"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[END]", "\\", "<\\/s>", "[\\\\INST]",
           " ", "\n", "a", "é", "<", "[", "s>", "/INST]"]


def chat_rows(seed=0):
    rng = random.Random(seed)
    rows = []
    for conv, length in enumerate([1, 2, 3, 31, 32, 33, 64, 65, 130]):
        for turn in range(length):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, "".join(rng.choices(CONTROL, k=rng.randint(0, 12)))))
    rows += [(50, 0, None, None), (50, 0, None, None), (50, None, "tool [END]", ""), (50, 1, "user", "x"),
             (None, 0, "user", "no id"), (51, 5, "assistant", "y" * 100_000), (52, 0, "user", "<s>")]
    rng.shuffle(rows)
    return rows


def chats_of(rows):
    """conv_id: turns in order."""
    place = lambda r: (r[0] is not None, r[0] or 0)
    order = lambda r: (*place(r), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    rows = sorted(rows, key=order)
    return {k: [(r[2] or "", r[3] or "") for r in own]
            for k, own in itertools.groupby(rows, lambda r: r[0])}


@pytest.fixture(scope="module")
def chat_frame(spark):
    def make(rows):
        df = spark.createDataFrame([(*r, 7, "clash", 9) for r in rows], SCHEMA)
        return df.repartition(3) if rows else df
    return make


def joined(parts):
    """Text, and spans from its start, of one conversation's parts."""
    text, spans = "", []
    for part in sorted(parts, key=lambda p: p.part):
        text = text[:len(text) - part.takes_back]
        for span in part.turns:
            moved = span.asDict()
            for name in ("first", "end", "text_first", "text_end"):
                moved[name] = None if moved[name] is None else moved[name] + len(text)
            spans.append(moved)
        text += part.text
    return text, spans


def by_chat(df):
    rows = sorted(df.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0))
    return {k: list(own) for k, own in itertools.groupby(rows, lambda r: r.conv_id)}


def test_every_text_comes_back(chat_frame):
    rows = chat_rows()
    want = chats_of(rows)
    chats = materialize(format_chats(chat_frame(rows)), "chats")
    got = by_chat(chats)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        text, spans = joined(got[conv])
        assert text == render(turns) and list(read_back(text)) == turns
        assert [(s["role"], unescape(text[s["text_first"]:s["text_end"]])) for s in spans] == turns
        assert [s["first"] for s in spans][1:] == [s["end"] for s in spans][:-1]
        assert all(s["loss"] == (s["role"] == "assistant") for s in spans)
        assert {p.n_parts for p in got[conv]} == {-(-len(turns) // 32)} == {len(got[conv])}
        assert all(p.rewrites == 0 and p.takes_back == 0 for p in got[conv])
    for row in digests(chats).collect():
        turns = want[row.conv_id]
        learned = "".join(t for r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (row.n_turns, row.loss_chars, row.formatted_chars) == (
            len(turns), len(learned), len(render(turns)))
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert row.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()


def test_escapes_are_undone_and_leave_no_control_string():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(CONTROL, k=rng.randint(0, 9)))
        hidden = escape(text)
        assert unescape(hidden) == text
        assert not any(c in hidden for c in CONTROL[:7])
    assert escape("plain <b> [x] text\\") == "plain <b> [x] text\\"


def prompted(turns):
    """Ends with a prompt for the next answer, which the next turn replaces."""
    return "".join(f"<{r}>{t}\n" for r, t in turns) + "<assistant>"


def forgetful(turns):
    """Leaves earlier answers' thoughts out, as soon as another turn follows."""
    shown = [(r, t if n == len(turns) - 1 else t.split("|")[-1]) for n, (r, t) in enumerate(turns)]
    return "".join(f"<{r}>{t}\n" for r, t in shown)


def numbered(turns):
    """Depends on all turns before."""
    return "".join(f"{n}. {r}: {t}\n" for n, (r, t) in enumerate(turns))


def plain_rows(n):
    return [(1, k, ("user", "assistant")[k % 2], f"thought {k}|said {k}") for k in range(n)]


@pytest.mark.parametrize("n", [1, 5, 100])
def test_a_replaced_ending_is_no_rewriting(chat_frame, n):
    [parts] = by_chat(format_chats(chat_frame(plain_rows(n)), prompted)).values()
    text, spans = joined(parts)
    turns = chats_of(plain_rows(n))[1]
    assert text == prompted(turns) and sum(p.rewrites for p in parts) == 0
    assert [text[s["text_first"]:s["text_end"]] for s in spans] == [t for _, t in turns]
    assert [p.takes_back for p in sorted(parts, key=lambda p: p.part)][1:] == [10] * (len(parts) - 1)  # all but the "<"


def test_rewriting_templates_are_found(chat_frame):
    [parts] = by_chat(format_chats(chat_frame(plain_rows(6)), forgetful)).values()
    assert sum(p.rewrites for p in parts) == 5
    assert parts[0].text == forgetful(chats_of(plain_rows(6))[1])
    assert [s.text_first is None for s in parts[0].turns] == [True] * 5 + [False]
    assert located(forgetful, [], [("user", "a|b"), ("user", "c")], ())["rewrites"] == 1
    assert located(forgetful, [], [("user", "b"), ("user", "c")], ())["rewrites"] == 0


def test_windows_that_disagree_are_rendered_whole(chat_frame):
    rows = plain_rows(90) + [(2, k, "user", f"other {k}") for k in range(70)] + [(3, 0, "user", "short")]
    got = by_chat(format_chats(chat_frame(rows), numbered))
    for conv, turns in chats_of(rows).items():
        text, spans = joined(got[conv])
        assert text == numbered(turns)
        assert [text[s["text_first"]:s["text_end"]] for s in spans] == [t for _, t in turns]


def test_many_long_conversations_are_joined(chat_frame):
    rows = chat_rows(1)
    got = by_chat(format_chats(chat_frame(rows), most_shared=0))
    assert {k: joined(v)[0] for k, v in got.items()} == {k: render(t) for k, t in chats_of(rows).items()}


def test_no_conversations(chat_frame):
    chats = format_chats(chat_frame([]))
    assert chats.count() == 0 and digests(chats).count() == 0
