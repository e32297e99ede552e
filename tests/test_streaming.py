"""Streams: equal to the batch result, restartable, no rows lost to a failing sink."""

from functools import partial

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import views
from churnkit.operators import event_rate
from churnkit.plans import insights
from churnkit.plans import values as v
from churnkit.plans.scoring import score_events
from churnkit.sinks import STAMPS, parquet_sink
from churnkit.sources import as_messages, file_topics, parse_topics, read_topic, read_topics
from churnkit.streaming import (
    await_any,
    batch_metrics,
    copy_topic,
    raw_writer,
    score_writer,
    start_batches,
    start_scoring,
    watched,
    windowed,
)

SF_DIR = "/root/testdata/sf0.001"


def all_messages(spark):
    parts = []
    for topic, measures, df in zip(
        (v.CALLS_TOPIC, v.NETWORK_TOPIC, v.USAGE_TOPIC),
        (v.CALL_MEASURES, v.NETWORK_MEASURES, v.USAGE_MEASURES),
        views.events(spark, SF_DIR),
    ):
        text_time = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time")
        parts.append(as_messages(df.select("customer_id", *measures, text_time), "customer_id", topic))
    return parts[0].union(parts[1]).union(parts[2]).withColumn("timestamp", F.lit(None).cast("timestamp"))


@pytest.fixture
def topic_dir(spark, tmp_path):
    """Messages in three files."""
    path = tmp_path / "topics"
    all_messages(spark).repartition(3, "key").write.parquet(str(path))
    return str(path)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_raw_topic_in_several_batches_and_restart(spark, topic_dir, tmp_path):
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    expected = read_topic(spark, file_topics(topic_dir, v.USAGE_TOPIC), v.USAGE_FIELDS, streaming=False)

    def run():
        reader = file_topics(topic_dir, v.USAGE_TOPIC, files_per_trigger=1)
        stream = watched(read_topic(spark, reader, v.USAGE_FIELDS, watermark=v.WATERMARK))
        query = start_batches(stream, raw_writer("usage", {"files": parquet_sink(out)}), offsets, every=None)
        query.awaitTermination()
        return query

    query = run()
    written = spark.read.parquet(out)
    assert bag(written.drop(*STAMPS)) == bag(expected)
    assert written.select("batch_id").distinct().count() == 3
    assert sum(m["n_rows"] for m in batch_metrics(query).values()) == expected.count()
    run()
    assert spark.read.parquet(out).count() == expected.count()


def test_scores_of_one_batch_equal_the_batch_result(spark, topic_dir, tmp_path):
    out = str(tmp_path / "scores")
    reports = {}
    stream = read_topics(spark, file_topics(topic_dir), v.TOPIC_FIELDS, watermark=v.WATERMARK)
    writer = score_writer({"files": parquet_sink(out)}, lambda batch_id, m: reports.update({batch_id: m}))
    start_batches(stream, writer, str(tmp_path / "offsets"), every=None).awaitTermination()
    events = parse_topics(spark.read.parquet(topic_dir), v.TOPIC_FIELDS)
    assert bag(spark.read.parquet(out).drop(*STAMPS)) == bag(score_events(events))
    counts = {r.topic: r["count"] for r in events.groupBy("topic").count().collect()}
    assert {t: r["n_rows"] for t, r in reports[0]["topics"].items()} == counts
    assert 0 < len(reports[0]["sample"]) <= 5


def test_failing_sink_loses_and_doubles_nothing(spark, topic_dir, tmp_path):
    first, second, offsets = (str(tmp_path / n) for n in ("first", "second", "offsets"))
    reader = file_topics(topic_dir, v.CALLS_TOPIC)
    good = parquet_sink(first)

    def down(batch, batch_id):
        raise OSError("down")

    def start(sink):
        stream = read_topic(spark, reader, v.CALL_FIELDS)
        writer = raw_writer("calls", {"second": sink, "first": good})
        return start_batches(stream, writer, offsets, every=None)

    with pytest.raises(StreamingQueryException, match="down"):
        start(down).awaitTermination()
    expected = read_topic(spark, reader, v.CALL_FIELDS, streaming=False)
    assert spark.read.parquet(first).count() == expected.count()
    start(parquet_sink(second)).awaitTermination()
    for path in (first, second):
        assert bag(spark.read.parquet(path).drop(*STAMPS)) == bag(expected)


def test_empty_batches_write_nothing(spark, topic_dir, tmp_path):
    wrote = []
    stream = read_topic(spark, file_topics(topic_dir, "no such topic"), v.CALL_FIELDS)
    writer = raw_writer("none", {"s": lambda batch, batch_id: wrote.append(batch_id)})
    start_batches(stream, writer, str(tmp_path / "o1"), every=None).awaitTermination()
    # A batch without calls has no one to score.
    stream = read_topics(spark, file_topics(topic_dir, v.USAGE_TOPIC), v.TOPIC_FIELDS)
    scorer = score_writer({"s": lambda batch, batch_id: wrote.append(batch_id)})
    start_batches(stream, scorer, str(tmp_path / "o2"), every=None).awaitTermination()
    assert wrote == []


def test_all_four_queries(spark, topic_dir, tmp_path):
    names = [*v.TOPIC_FIELDS, "churn_risk"]
    paths = {n: str(tmp_path / n) for n in names}
    sinks = {n: {"files": parquet_sink(p)} for n, p in paths.items()}
    spark.streams.resetTerminated()  # other tests end in failure on purpose
    queries = start_scoring(spark, partial(file_topics, topic_dir), sinks, str(tmp_path / "offsets"), every=None)
    await_any(spark)
    for query in queries:
        query.awaitTermination()
    messages = spark.read.parquet(topic_dir)
    for topic in v.TOPIC_FIELDS:
        assert spark.read.parquet(paths[topic]).count() == messages.filter(F.col("topic") == topic).count()
    assert bag(spark.read.parquet(paths["churn_risk"]).drop(*STAMPS)) == bag(
        score_events(parse_topics(messages, v.TOPIC_FIELDS))
    )


def test_copy_modes(spark, topic_dir, tmp_path):
    reader = file_topics(topic_dir, v.NETWORK_TOPIC)
    once, live = str(tmp_path / "once"), str(tmp_path / "live")
    assert copy_topic(spark, reader, v.NETWORK_FIELDS, parquet_sink(once), mode="batch") is None
    copy_topic(
        spark, reader, v.NETWORK_FIELDS, parquet_sink(live), checkpoint=str(tmp_path / "o"), every=None
    ).awaitTermination()
    assert bag(spark.read.parquet(once).drop(*STAMPS)) == bag(spark.read.parquet(live).drop(*STAMPS))
    with pytest.raises(ValueError, match="stream"):
        copy_topic(spark, reader, v.NETWORK_FIELDS, parquet_sink(once), mode="both")
    with pytest.raises(ValueError, match="checkpoint"):
        copy_topic(spark, reader, v.NETWORK_FIELDS, parquet_sink(once))


@pytest.mark.parametrize("mode", ["complete", "append"])
def test_windows_over_a_stream(spark, topic_dir, tmp_path, mode):
    out = str(tmp_path / "out")
    reader = file_topics(topic_dir, v.NETWORK_TOPIC)

    def rate(df):
        return event_rate(df, "event_time", "1 hour", 3600)

    def write(batch, batch_id):
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    stream = windowed(read_topic(spark, reader, v.NETWORK_FIELDS), rate)
    start_batches(stream, write, str(tmp_path / "o"), every=None, mode=mode).awaitTermination()
    expected = bag(rate(read_topic(spark, reader, v.NETWORK_FIELDS, streaming=False)))
    found = bag(spark.read.parquet(out))
    if mode == "complete":
        assert found == expected
    else:
        # The newest windows stay open until the watermark passes them.
        assert set(found) < set(expected) and len(found) >= len(expected) - 2


def test_score_trend_over_a_stream_of_scores(spark, topic_dir, tmp_path):
    scores = score_events(parse_topics(spark.read.parquet(topic_dir), v.TOPIC_FIELDS))
    path, out = str(tmp_path / "scores"), str(tmp_path / "out")
    scores.write.parquet(path)
    stream = windowed(spark.readStream.schema(scores.schema).parquet(path), insights.score_trend)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(out)

    start_batches(stream, write, str(tmp_path / "o"), every=None, mode="complete").awaitTermination()
    assert bag(spark.read.parquet(out)) == bag(insights.score_trend(scores))


def test_time_ranges_are_written_by_many_tasks(spark):
    """Several files a range, none of which holds rows of two ranges; ranges follow each other in time of writing."""
    from checks.flows import in_files

    rows = spark.range(12_000).repartition(5).selectExpr("timestamp_seconds(id) AS ts", "id")
    path, tasks = in_files(spark, rows, "ts", "new")
    assert tasks == 3
    held = spark.read.parquet(path).selectExpr("_metadata.file_path AS f", "_metadata.file_modification_time AS m", "id")
    files = sorted(held.groupBy("f", "m").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).collect(), key=lambda r: r.m)
    assert len(files) == 9 and sum(r.n for r in files) == 12_000
    ranges = [{(r.low // 4000, r.high // 4000) for r in files[k : k + 3]} for k in (0, 3, 6)]
    assert ranges == [{(2, 2)}, {(1, 1)}, {(0, 0)}]
