"""The jobs one runs, from polls to answers. See ``python -m tallywire --help``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallywire.functions.json_codec import rejected_responses
from tallywire.operators.rollups import total_per_key
from tallywire.plans.answers import answer, ask_store, totals_store
from tallywire.plans.compaction import compact as compact_counts
from tallywire.plans.counting import articles_from_messages, author_counts, source_counts
from tallywire.plans.dashboard import bars_or_status
from tallywire.plans.ingest import POLL_INTERVAL, messages_from_responses, polled_responses
from tallywire.plans.store import DocumentStore
from tallywire.plans.totals import DayTotals
from tallywire.schemas import AUTHOR_COUNTS, SOURCE_COUNTS
from tallywire.session import pin_utc, stateful
from tallywire.sources.directories import json_directory, json_rejects, parquet_directory
from tallywire.sources.messages import kafka_messages, landed_messages
from tallywire.sources.polls import landed_responses
from tallywire.storage import make_folder, materialize, scratch_run
from tallywire.streaming.fanout import console_target, fan_out
from tallywire.streaming.late import LateRows, late_messages, recover
from tallywire.streaming.publish import committed_messages, committed_sink
from tallywire.streaming.refresh import REFRESH_INTERVAL, delta_sink, running_counts
from tallywire.streaming.state import whole_counts
from tallywire.streaming.sinks import console_sink, json_sink, kafka_sink, parquet_sink

# A running query, a table to show, or one that is there once all queries have ended.
Result = StreamingQuery | DataFrame | Callable[[], DataFrame]

# Per kind of count: key, count column, schema, plan, file format, stream writer, reader.
_KINDS = {
    "source": ("source_id", "article_count", SOURCE_COUNTS, source_counts,
               "parquet", parquet_sink, parquet_directory),
    "author": ("author", "article_count_by_author", AUTHOR_COUNTS, author_counts,
               "json", json_sink, json_directory),
}


def ingest(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Clean the articles of landed or fetched poll responses and publish them."""
    if args.fetch:
        module, _, function = args.fetch.partition(":")
        client = importlib.import_module(module)
        # Sent as it is, so that workers need no copy of the module.
        cloudpickle.register_pickle_by_value(client)
        # Beside the checkpoint whose batches may be run again.
        landing = args.landing or f"{args.checkpoint}-polls"
        responses = polled_responses(spark, getattr(client, function), landing=landing)
    else:
        responses = landed_responses(spark, args.responses)
    messages = messages_from_responses(responses)
    if args.messages:
        writer = parquet_sink(messages, args.messages, args.checkpoint)
    elif args.publish:
        writer = committed_sink(messages, args.publish, args.checkpoint)
    else:
        writer = kafka_sink(messages, args.servers, args.topic, args.checkpoint)
    return [_start(writer, args.once, POLL_INTERVAL)]


def count(spark: SparkSession, args: argparse.Namespace) -> list[Result]:
    """Windowed counts of a message stream into a sink, optionally shown as well.

    The sink keeps a log of its files, which ``refresh`` follows. With ``--console`` a second
    query follows it too and prints what has been committed, so counts are computed once.
    At its end the job prints how many rows were dropped as late; ``--late`` keeps a log of the
    batches, from which the job ``late`` finds the messages.
    """
    late = LateRows(spark, args.late)
    if args.late:
        recover(spark, args.late, args.checkpoint)
    spark.streams.addListener(late)
    _, _, schema, plan, fmt, sink, _ = _KINDS[args.key]
    if args.messages:
        messages = landed_messages(spark, args.messages)
    elif args.publish:
        messages = committed_messages(spark, args.publish, stream=True)
    else:
        messages = kafka_messages(spark, args.servers, args.topic)
    counts = plan(messages)
    started = []
    with stateful(spark, args.partitions):
        if args.console:
            started.append(_start(console_sink(articles_from_messages(messages)), args.once))
        started.append(_start(sink(counts, args.sink, args.checkpoint, args.by_day), args.once))
        late.follow(started[-1])
        if args.console:
            if args.once:
                started[-1].awaitTermination()
            make_folder(spark, args.sink)
            shown = spark.readStream.schema(schema).format(fmt).load(args.sink)
            writer = fan_out(shown, [console_target()], f"{args.checkpoint}-console")
            started.append(_start(writer, args.once))

    def dropped() -> DataFrame:
        late.wait()
        spark.streams.removeListener(late)
        return spark.createDataFrame([(late.total(),)], "late_rows long")

    return [*started, dropped]


def late(spark: SparkSession, args: argparse.Namespace) -> list[Result]:
    """Write the landed messages that a count dropped as late to a folder, and show how many."""
    recover(spark, args.late, args.checkpoint)
    late_messages(spark, args.late, args.checkpoint).write.mode("overwrite").parquet(args.into)
    return [spark.read.parquet(args.into).agg(F.count("*").alias("late_messages"))]


def rejects(spark: SparkSession, args: argparse.Namespace) -> list[Result]:
    """What was left out: polls without articles, or lines of a JSON sink, each with its file."""
    if args.sink:
        return [json_rejects(spark, args.sink, AUTHOR_COUNTS).orderBy("file", "line")]
    responses = spark.read.text(args.responses).select("value", F.col("_metadata.file_path").alias("file"))
    return [rejected_responses(responses, ["file"]).orderBy("file", "value")]


def refresh(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Keep the number of windows per key of a growing sink up to date."""
    key, _, schema, _, fmt, _, _ = _KINDS[args.key]
    counts = running_counts(spark, args.sink, schema, key, fmt)
    writer = delta_sink(counts, args.snapshots, args.checkpoint)
    with stateful(spark, args.partitions):
        return [_start(writer, args.once, REFRESH_INTERVAL)]


def compact(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """Rewrite the closed days of a sink into few files, in a folder of their own."""
    _, _, schema, _, fmt, _, read = _KINDS[args.key]
    own = pin_utc(spark.newSession())
    compact_counts(read(own, args.sink, schema), args.into, fmt, args.before)
    return []


def totals(spark: SparkSession, args: argparse.Namespace) -> list[Result]:
    """Totals of a sink that is written by day, from kept totals of the days that did not change."""
    key, total, schema, _, fmt, _, _ = _KINDS[args.key]
    kept = DayTotals(spark, args.sink, args.kept, schema, key, total, fmt)
    kept.refresh()
    return [kept.totals().orderBy(key)]


def windows(spark: SparkSession, args: argparse.Namespace) -> list[Result]:
    """All windows of a count, those not written yet as well."""
    _, _, schema, _, _, _, read = _KINDS[args.key]
    rows = whole_counts(spark, read(spark, args.sink, schema), args.checkpoint, schema)
    return [rows.orderBy("window")]


def index(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """Embed the totals of a sink as it is now, for many questions."""
    key, total, schema, _, _, _, read = _KINDS[args.key]
    totals = materialize(total_per_key(read(spark, args.sink, schema), key, total), "totals")
    totals_store(totals, key, total, args.store, update=args.update)
    return []


def ask(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """Contexts for questions from a store, or bars, status, context and exact answer of a sink."""
    key, total, schema, _, _, _, read = _KINDS[args.key]
    if args.store:
        return [ask_store(DocumentStore(spark, args.store, "document_id"), key, args.question)]
    counts = read(spark, args.sink, schema)
    bars, status = bars_or_status(counts, key, total)
    context, exact = answer(counts, key, total, args.question[0] if args.question else None)
    return [bars.orderBy("rank"), status, context, exact]


def _start(writer: DataStreamWriter, once: bool, every: str | None = None) -> StreamingQuery:
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallywire")
    jobs = top.add_subparsers(required=True)

    def job(run, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=run.__doc__.splitlines()[0])
        sub.set_defaults(run=run)
        for option in options:
            sub.add_argument(option, required=True)
        return sub

    def stream(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--once", action="store_true", help="process what is there and stop")
        sub.add_argument("--partitions", type=int, help="state partitions, fixed at first start")

    def topic_or_folder(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--messages", help="a folder of message files instead of a topic")
        sub.add_argument("--publish", help="a folder of committed batches instead of a topic")
        sub.add_argument("--servers")
        sub.add_argument("--topic")

    def one_of(sub: argparse.ArgumentParser, **options: str) -> None:
        group = sub.add_mutually_exclusive_group(required=True)
        for option, text in options.items():
            group.add_argument(f"--{option}", help=text)

    ingesting = job(ingest, "--checkpoint")
    one_of(ingesting, responses="a folder of landed responses",
           fetch="module:function called with keyword, news source and language")
    ingesting.add_argument("--landing", help="a shared folder for fetched responses, as long as needed")
    counting = job(count, "--sink", "--checkpoint")
    job(late, "--late", "--checkpoint", "--into")
    one_of(job(rejects), responses="a folder of landed responses", sink="a folder of counts by author")
    refreshing = job(refresh, "--sink", "--snapshots", "--checkpoint")
    compacting = job(compact, "--sink", "--into")
    compacting.add_argument("--before", help="a date; its day and later ones are left out")
    totalling = job(totals, "--sink", "--kept")
    showing = job(windows, "--sink", "--checkpoint")
    indexing = job(index, "--sink", "--store")
    asking = job(ask)
    one_of(asking, sink="a folder of counts", store="a folder written by index")
    asking.add_argument("--question", action="append",
                        help="instead of the one for the key; a store takes several")
    indexing.add_argument("--update", action="store_true",
                          help="embed what changed since the store was built, if there is one")
    for sub in (ingesting, counting):
        topic_or_folder(sub)
    for sub in (ingesting, counting, refreshing):
        stream(sub)
    for sub in (counting, refreshing, compacting, totalling, showing, indexing, asking):
        sub.add_argument("--key", choices=sorted(_KINDS), required=True)
    counting.add_argument("--by-day", action="store_true", help="a folder of the sink for each day")
    counting.add_argument("--late", help="a folder for the log of late rows")
    counting.add_argument("--console", action="store_true", help="also print articles and counts")
    return top


def wait_for_all(queries: Sequence[StreamingQuery]) -> None:
    """Return when every query has ended; when one fails, stop the others and raise."""
    try:
        while not all([query.awaitTermination(1) for query in queries]):
            pass
    finally:
        for query in queries:
            query.stop()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = pin_utc(spark or SparkSession.builder.appName("tallywire").getOrCreate())
    with scratch_run(spark):
        results = args.run(spark, args)
        wait_for_all([result for result in results if isinstance(result, StreamingQuery)])
        for result in results:
            if not isinstance(result, StreamingQuery):
                (result if isinstance(result, DataFrame) else result()).show(truncate=False)
