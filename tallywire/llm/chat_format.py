"""Conversations as training text: a template is a black box, and its output tells what it does.

Successive prefixes of a conversation are rendered and consecutive outputs compared: what the
next one adds is the span of its turn, and what it no longer begins with was taken back or
rewritten. Two renderings of a turn that differ in one letter show where its own text stands.
Long conversations are cut into windows of bounded size that begin with the turns before; windows
have to agree on the turns they share, and where they don't, whole prefixes are rendered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.shared import Shared
from tallywire.operators.ranking import with_rank
from tallywire.storage import materialize

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

# Turns of one window, and turns before it that it begins with.
WINDOW = 32
CONTEXT = 2
# So many conversations longer than a window are looked up in each task; more are joined.
MOST_SHARED = 100_000

_SPAN = ("struct<role: string, loss: boolean, first: bigint, end: bigint, text_first: bigint, "
         "text_end: bigint>")
_PART = ("conv_id {id}, part long, n_parts long, text string, takes_back long, rewrites long, "
         f"turns array<{_SPAN}>, before string, last string")

# Fixed values of the default template: what begins a conversation, and its control strings.
BEGIN = "<s>"
_CONTROL = r"/?s>|/?INST\]|/?ROLE\]|END\]"
_ESCAPE = re.compile(rf"([<\[])(\\*(?:{_CONTROL}))")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*(?:{_CONTROL}))")
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]| (.*?)</s>|\[ROLE\] (.*?) \[/ROLE\] (.*?) \[END\]", re.S)


def escape(text: str) -> str:
    """Control strings get a backslash after their bracket, one more than they may have had."""
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(turns: list[Turn]) -> str:
    """The default template. Roles but ``user`` and ``assistant`` are named."""
    parts = [BEGIN]
    for role, text in turns:
        if role == "user":
            parts.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            parts.append(f" {escape(text)}</s>")
        else:
            parts.append(f"[ROLE] {escape(role)} [/ROLE] {escape(text)} [END]")
    return "".join(parts)


def read_back(text: str) -> Iterator[Turn]:
    """The turns of what the default template rendered, with or without its beginning."""
    at = len(BEGIN) if text.startswith(BEGIN) else 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError(f"No turn at character {at}")
        user, assistant, role, other = found.groups()
        if user is not None:
            yield "user", unescape(user)
        elif assistant is not None:
            yield "assistant", unescape(assistant)
        else:
            yield unescape(role), unescape(other)
        at = found.end()


def common_start(a: str, b: str) -> int:
    """Length of what two texts begin with alike."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def located(render: Render, history: list[Turn], own: list[Turn], learn: Sequence[str]) -> dict:
    """What ``own`` turns after ``history`` add to the output: text, spans, what they take back.

    ``takes_back`` counts the characters at the end of the history's output that the first own turn
    replaces. ``rewrites`` counts turns that change the texts before them. A span is null
    where the text doesn't stand there any more in the end. ``pieces`` are what single turns add.
    """
    out = render(history) if history else ""
    known, spans, pieces = list(history), [], []
    start = rewrites = text_end = 0
    for number, (role, text) in enumerate(own):
        full = render([*known, (role, text)])
        one, other = render([*known, (role, "a")]), render([*known, (role, "b")])
        same = common_start(out, full)
        if number == 0:
            start, text_end = same, same
            takes_back = len(out) - same
            rewrites += bool(history) and same < _last_text_end(render, history, out)
        else:
            rewrites += same < text_end
            spans[-1][3] = max(spans[-1][2], same)
        head = common_start(one, other)
        tail = common_start(one[:head - 1:-1] if head else one[::-1],
                            other[:head - 1:-1] if head else other[::-1])
        text_end = max(head, len(full) - tail)
        spans.append([role, role in learn, same, len(full), head, text_end, full[head:text_end]])
        pieces.append(full[same:])
        known.append((role, text))
        out = full
    turns = []
    for role, loss, first, end, text_first, text_end, text in spans:
        stands = out[text_first:text_end] == text
        turns.append({"role": role, "loss": loss, "first": first - start, "end": end - start,
                      "text_first": text_first - start if stands else None,
                      "text_end": text_end - start if stands else None})
    return {"text": out[start:], "takes_back": takes_back, "rewrites": rewrites, "turns": turns,
            "pieces": pieces}


def _last_text_end(render: Render, history: list[Turn], out: str) -> int:
    """Where the text of the last turn ends in its output."""
    *before, (role, _) = history
    one, other = render([*before, (role, "a")]), render([*before, (role, "b")])
    head = common_start(one, other)
    return len(out) - common_start(one[:head:-1], other[:head:-1])


def _digest(piece: str) -> str:
    return hashlib.sha256(piece.encode("utf-8", "surrogatepass")).hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["text"]) + 100 * len(row["turns"])
        if size > most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _renderer(shared: Shared, schema: pa.Schema, learn: Sequence[str], window: int, whole: bool):
    """Sorted turns to parts. A group (a conversation, or a window of one) is a run of rows.

    With ``whole`` a group is a whole conversation, whose parts know all turns before them.
    """

    def format_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = shared.value()

        def parts() -> Iterator[dict]:
            # Rows: conversation, part, number of parts, whether a turn before the part, role, text.
            key = (lambda r: (r[0],)) if whole else (lambda r: (r[0], r[1]))
            for _, rows in groupby(_rows(batches), key):
                rows = list(rows)
                before = [] if whole else [row[4:6] for row in rows if row[3]]
                own = [row for row in rows if not row[3]]
                for first in range(0, len(own), window):
                    part = own[first:first + window]
                    history = before + [row[4:6] for row in own[:first]]
                    found = located(template, history, [row[4:6] for row in part], learn)
                    pieces = found.pop("pieces")
                    again = None
                    if len(history) > 1:
                        again = _digest(located(template, history[:-1], history[-1:], learn)["text"])
                    yield {"conv_id": part[0][0], "part": part[0][1], "n_parts": part[0][2],
                           "before": again, "last": _digest(pieces[-1]), **found}

        yield from _batches(parts(), schema)
    return format_


def _with_few(rows: DataFrame, few: DataFrame, keys: list[str], how: str, most: int) -> DataFrame:
    """A join on ``keys``, null-safe, whose small side is sent to the tasks if it has few rows."""
    few = few.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    side = F.broadcast(few) if few.count() <= most else few
    return rows.join(side, same, how).drop(*(f"_{key}" for key in keys))


def format_chats(rows: DataFrame, template: Render = render, *, conv_id: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text",
                 learn: Sequence[str] = ("assistant",), window: int = WINDOW,
                 most_shared: int = MOST_SHARED) -> DataFrame:
    """Conversations as text with the spans of their turns, one row for each part of ``window`` turns.

    Columns: ``conv_id, part, n_parts, text, takes_back, rewrites, turns``. A conversation is
    its parts' texts end to end, each without the last ``takes_back`` characters of what
    the next one replaces. ``turns`` has for each turn, in order, ``role``, ``loss`` (its role is in
    ``learn``), ``first`` and ``end`` (what the turn added) and ``text_first`` and ``text_end`` (its
    text as the template shows it), in characters from the part's first one. ``rewrites`` counts
    turns at which the template changed texts before them; spans that no longer hold are null.

    ``template`` gets a list of (role, text) and returns the whole text; it is pickled for
    the tasks, which need its module unless that is registered to be pickled by value.
    Turns are ordered by ``turn`` (null first), then role and text; repeated rows are turns of
    their own; null roles and texts are empty; a null ``conv_id`` is a conversation. Only
    conversations longer than a window are cut. Their turns are numbered by a sort over
    ranges, so that a very long one is many tasks' work. If a window renders the turn before
    it otherwise than the window that has it, the template looks farther back than
    ``CONTEXT`` turns: such conversations are rendered again by whole prefixes, each by one task.
    """
    spark = rows.sparkSession
    id_type = rows.schema[conv_id].dataType.simpleString()
    shape = spark.createDataFrame([], _PART.format(id=id_type)).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(shape)
    shared = Shared(spark, template)
    empty = F.lit("")
    turns = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), empty).alias("role"),
                        F.coalesce(F.col(text).cast("string"), empty).alias("text"))
    order = ["turn", "role", "text"]
    inputs = ["conv_id", "part", "n_parts", "context", "role", "text"]

    def formatted(turns: DataFrame, keys: list[str], whole: bool = False) -> DataFrame:
        return (turns.repartition(*keys).sortWithinPartitions(*keys, *order).select(*inputs)
                .mapInArrow(_renderer(shared, schema, learn, window, whole), shape))

    lengths = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("size"))
                          .where(F.col("size") > window), "chats")
    short = _with_few(turns, lengths.select("conv_id"), ["conv_id"], "left_anti", most_shared)
    zero = F.lit(0).cast("long")
    short = formatted(short.withColumns({
        "part": zero, "n_parts": zero + 1, "context": F.lit(False)}), ["conv_id"])
    if lengths.isEmpty():
        return short.drop("before", "last")

    long = _with_few(turns, lengths.select("conv_id"), ["conv_id"], "left_semi", most_shared)
    ranked = materialize(with_rank(long, [F.col(c) for c in ("conv_id", *order)], "_rank"), "chats")
    sizes = ranked.groupBy("conv_id").agg(F.min("_rank").alias("_first"), F.count("*").alias("_size"))
    placed = _with_few(ranked, sizes, ["conv_id"], "inner", most_shared)
    place = F.col("_rank") - F.col("_first")
    placed = placed.withColumns({
        "part": F.floor(place / window), "turn": F.col("_rank"),
        "n_parts": F.ceil(F.col("_size") / window), "context": F.lit(False),
        "_tail": (place % window >= window - CONTEXT) & (place < F.floor((F.col("_size") - 1) / window) * window)})
    ahead = placed.where("_tail").withColumns({"part": F.col("part") + 1, "context": F.lit(True)})
    cut = materialize(formatted(placed.unionByName(ahead), ["conv_id", "part"]), "chats",
                      compression="zstd")
    ends = cut.select("conv_id", (F.col("part") + 1).alias("part"), "last")
    heads = cut.where("before is not null").select("conv_id", "part", "before")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.part") == F.col("b.part"))
    unlike = materialize(heads.alias("a").join(ends.alias("b"), same).where("before <> last")
                         .select("a.conv_id").distinct(), "chats")
    parts = short.unionByName(cut)
    if not unlike.isEmpty():
        agreed = _with_few(cut, unlike, ["conv_id"], "left_anti", most_shared)
        again = _with_few(placed, unlike, ["conv_id"], "left_semi", most_shared)
        parts = short.unionByName(agreed).unionByName(formatted(again, ["conv_id"], whole=True))
    return parts.drop("before", "last")


_READ = ("conv_id {id}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
         "formatted_chars long")


def digests(chats: DataFrame) -> DataFrame:
    """Per conversation what is read back from parts that the default template rendered.

    ``n_turns`` and ``turns_sha256`` (role, line feed, text, line feed for each turn) come from the
    text, ``loss_chars`` and ``loss_sha256`` from what the spans with ``loss`` hold, without
    escapes. Parts of a conversation are read in order and not kept.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    id_type = chats.schema["conv_id"].dataType.simpleString()
    shape = chats.sparkSession.createDataFrame([], _READ.format(id=id_type)).schema
    schema = to_arrow_schema(shape)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for conv_id, parts in groupby(_rows(batches), lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, _, text, takes_back, spans in parts:
                for role, content in read_back(text):
                    turns.update(f"{role}\n{content}\n".encode())
                    n_turns += 1
                for span in spans:
                    if span["loss"]:
                        content = unescape(text[span["text_first"]:span["text_end"]])
                        loss.update(content.encode())
                        loss_chars += len(content)
                chars += len(text) - takes_back
            done.append({"conv_id": conv_id, "n_turns": n_turns, "turns_sha256": turns.hexdigest(),
                         "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(),
                         "formatted_chars": chars})
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    rows = chats.select("conv_id", "part", "text", "takes_back", "turns", "n_parts")
    whole = rows.where("n_parts = 1").drop("n_parts").mapInArrow(read, shape)
    split = (rows.where("n_parts > 1").drop("n_parts").repartition("conv_id")
             .sortWithinPartitions("conv_id", "part").mapInArrow(read, shape))
    return whole.unionByName(split)
