"""Runnable jobs: ``spark-submit churnkit/jobs.py <job> ..`` or ``python -m churnkit.jobs <job> ..``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from churnkit.operators.clean import coerce_numbers
from churnkit.operators.stats import require_rows
from churnkit.plans import values as v
from churnkit.plans import increments, warehouse
from churnkit.plans.silver import build_silver
from churnkit.scratch import clear
from churnkit.session import build_session, size_shuffles
from churnkit.sinks import format_sink, full_refresh, jdbc_sink, ledger_sink, parquet_sink, write_messages, write_silver
from churnkit.sources import kafka_topics, read_csv, read_silver, require_inputs, split_once
from churnkit.sources.topics import TopicReader
from churnkit.streaming import await_any, copy_topic, start_scoring

EVENTS = ("usage", "network", "calls")
STAGING = ("silver", *EVENTS, "risk")
SCORE_TABLE = "churn_risk"


def run_silver(spark: SparkSession, client: str, record: str, out: str, fmt: str = "parquet") -> int:
    """Raw client and record files to the silver files; gives the row count."""
    require_inputs(spark, {"client": ("csv", client), "record": ("csv", record)})
    silver = build_silver(
        read_csv(spark, client, v.CLIENT_FIELDS), read_csv(spark, record, v.RECORD_FIELDS)
    )
    write_silver(silver, out, fmt)
    return require_rows(spark.read.format(fmt).option("header", True).load(out), "silver")


def run_load(spark: SparkSession, silver: str, table: str) -> int:
    """Silver files to a staging table, replaced as a whole."""
    full_refresh(read_silver(spark, silver), table)
    return require_rows(spark.table(table), table)


def run_warehouse(
    spark: SparkSession,
    staging: Mapping[str, DataFrame],
    out: str,
    keys: str | None = None,
    load: int | None = None,
    sums: str | None = None,
) -> dict[str, int]:
    """All dimensions, facts and marts as Parquet below ``out``; each must hold rows.

    ``keys`` names a folder that keeps the keys of customers, loyalty tuples and devices from one ``load`` to the next. ``sums``
    names one that ``run_increment`` feeds: the means of the marts then come from it and the event facts are not read for them.
    """
    if (keys is None) != (load is None):
        raise ValueError("kept keys need both a folder and the number of the load")
    counts = {}

    def keep(models: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        kept = {}
        for name, df in models.items():
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            kept[name] = spark.read.schema(df.schema).parquet(f"{out}/{name}")
            counts[name] = require_rows(kept[name], name)
        return kept

    dims = keep(warehouse.build_dims(staging, kept_keys=None if keys is None else (keys, load)))
    facts = keep(warehouse.build_facts(staging, dims))
    if sums is None:
        means = warehouse.fact_means(facts)
    else:
        means = increments.usage_means(spark, sums, dims), increments.care_means(spark, sums, dims)
    keep(warehouse.build_marts(facts, dims, *means))
    return counts


def run_increment(
    spark: SparkSession, usage: DataFrame, network: DataFrame, calls: DataFrame, sums: str, number: int, fold: bool = False
) -> None:
    """Add one increment of events to the sums behind the marts' means; ``fold`` merges the increments so far."""
    increments.add_events(sums, number, usage, network, calls)
    if fold:
        increments.fold(spark, sums)


def run_scoring(
    spark: SparkSession,
    reader_of: Callable[..., TopicReader],
    out: str,
    checkpoint: str,
    jdbc_url: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    every: str | None = v.TRIGGER,
    across_batches: bool = False,
    unique_within: str | None = None,
) -> None:
    """Raw topics and scores to files and, if a database is named, to tables; runs until a query ends.

    See ``start_scoring`` for ``across_batches`` and ``unique_within``.
    """
    sinks = {}
    for name in (*v.TOPIC_FIELDS, SCORE_TABLE):
        sinks[name] = {"files": parquet_sink(f"{out}/{name}")}
        if jdbc_url:
            sinks[name]["database"] = jdbc_sink(jdbc_url, f"{name}_tbl", jdbc or {})
    queries = start_scoring(spark, reader_of, sinks, checkpoint, every, across_batches, unique_within)
    if every is None:
        for query in queries:
            query.awaitTermination()
    else:
        await_any(spark)


def run_replay(spark: SparkSession, csv: str, topic: str, fmt: str = "kafka", **options: str) -> DataFrame:
    """Posts from CSV to keyed messages; lines of the wrong length are left out and given back."""
    kinds = dict(f.split() for f in v.POST_FIELDS.split(","))
    text = ", ".join(f"{name} string" for name in kinds)
    good, bad = split_once(read_csv(spark, csv, text, corrupt="_corrupt"))
    posts = coerce_numbers(
        good.fillna(""),
        doubles=[n for n, kind in kinds.items() if kind == "double"],
        integers=[n for n, kind in kinds.items() if kind == "int"],
    )
    write_messages(posts, v.POST_KEY, topic, fmt, **options)
    return bad


def _pairs(texts: Sequence[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        sub.add_argument("--option", action="append", default=[], help="name=value, handed to the data source")
        return sub

    job("silver", "client", "record", "out").add_argument("--format", default="parquet")
    job("load", "silver", "table")
    gold = job("warehouse", *STAGING, "out")
    gold.add_argument("--keys", help="folder that keeps keys from load to load")
    gold.add_argument("--load", type=int, help="number of this load, for --keys")
    gold.add_argument("--sums", help="folder of the increment job, to take means from")
    added = job("increment", *EVENTS, "sums")
    added.add_argument("--number", type=int, required=True)
    added.add_argument("--fold", action="store_true", help="merge the increments so far")
    score = job("score", "servers", "out", "checkpoint")
    score.add_argument("--jdbc-url")
    score.add_argument("--across-batches", action="store_true", help="score by all events so far, not those of one batch")
    score.add_argument("--unique-within", help="drop messages sent again within this time, such as '10 minutes'")
    copy = job("copy", "servers", "topic", "format")
    copy.add_argument("--mode", choices=("stream", "batch"), default="stream")
    copy.add_argument("--checkpoint")
    copy.add_argument(
        "--skip-lost-offsets", action="store_true", help="go on where the broker has dropped messages; else fail"
    )
    copy.add_argument(
        "--ledger", action="store_true", help="commit each batch to a ledger at the path option, in any file format"
    )
    copy.add_argument(
        "--at-least-once", action="store_true", help="accept that a retried batch may be appended twice"
    )
    job("replay", "csv", "topic", "servers")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"churnkit-{args.job}")
    try:
        run(spark, args)
    finally:
        clear(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    options = _pairs(args.option)
    inputs = {
        "silver": ("client", "record"), "load": ("silver",), "warehouse": STAGING, "increment": EVENTS, "replay": ("csv",)
    }
    if args.job in inputs:
        size_shuffles(spark, *(getattr(args, name) for name in inputs[args.job]))
    if args.job == "silver":
        print(run_silver(spark, args.client, args.record, args.out, args.format), "rows")
    elif args.job == "load":
        print(run_load(spark, args.silver, args.table), "rows")
    elif args.job == "warehouse":
        staging = {name: spark.read.parquet(getattr(args, name)) for name in STAGING}
        for name, n in run_warehouse(spark, staging, args.out, args.keys, args.load, args.sums).items():
            print(name, n, "rows")
    elif args.job == "increment":
        run_increment(spark, *(spark.read.parquet(getattr(args, name)) for name in EVENTS), args.sums, args.number, args.fold)
    elif args.job == "score":
        reader_of = partial(kafka_topics, args.servers, rows_per_trigger=v.ROWS_PER_TRIGGER)
        kept = {"across_batches": args.across_batches, "unique_within": args.unique_within}
        run_scoring(spark, reader_of, args.out, args.checkpoint, args.jdbc_url, options, **kept)
    elif args.job == "copy":
        reader = kafka_topics(
            args.servers, args.topic, rows_per_trigger=None, fail_on_data_loss=not args.skip_lost_offsets
        )
        if args.ledger:
            sink = ledger_sink(spark, options.pop("path"), args.format, **options)
        else:
            sink = format_sink(args.format, at_least_once=args.at_least_once, **options)
        query = copy_topic(spark, reader, v.POST_FIELDS, sink, args.mode, args.checkpoint)
        if query is not None:
            query.awaitTermination()
    else:
        servers = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
        bad = run_replay(spark, args.csv, args.topic, **servers, **options)
        print(bad.count(), "malformed lines left out")


if __name__ == "__main__":
    main()
