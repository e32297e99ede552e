"""Streaming queries: raw topic writers, churn scoring, copying and windowed rates."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from churnkit.operators.latest import latest_per_key
from churnkit.operators.stats import topic_counts
from churnkit.plans import values as v
from churnkit.plans.scoring import score_events, score_latest
from churnkit.sinks.batches import BATCH, RUN, Sink, parquet_sink, write_to_all
from churnkit.sources.topics import TopicReader, parse_topic, parse_topics

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]
METRICS = "batch"


def raw_writer(label: str, sinks: Mapping[str, Sink], bounded: bool = False) -> BatchWriter:
    """Write each non-empty micro-batch to all sinks.

    A micro-batch is kept while it is written, so that all sinks and the look for rows share one read. A
    ``bounded`` read of a whole topic for a single sink is not kept, and is written without looking for rows first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = not bounded or len(sinks) > 1
        rows = batch.persist() if kept else batch
        try:
            if not bounded and rows.isEmpty():
                log.info("%s: batch %d is empty", label, batch_id)
                return
            write_to_all(rows, batch_id, sinks)
        finally:
            if kept:
                rows.unpersist()

    return write


def score_writer(
    sinks: Mapping[str, Sink],
    report: Callable[[int, dict[str, Any]], None] | None = None,
    sample: int = 5,
) -> BatchWriter:
    """Score the customers of each micro-batch and write the scores to all sinks.

    Only events of the same batch meet: a customer without a call in it gets no score.
    ``report`` is given row and customer counts per topic and a few scores.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        scored = score_events(rows).persist()
        try:
            if report is not None:
                topics = {r["topic"]: r.asDict() for r in topic_counts(rows).collect()}
                few = [r.asDict() for r in scored.limit(sample).collect()]
                report(batch_id, {"topics": topics, "sample": few})
            if scored.isEmpty():
                log.info("scores: nothing to write for batch %d", batch_id)
                return
            write_to_all(scored, batch_id, sinks)
        finally:
            scored.unpersist()
            rows.unpersist()

    return write


def start_batches(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    name: str | None = None,
    every: str | None = v.TRIGGER,
    mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``write``; ``every=None`` drains the source and stops."""
    writer = stream.writeStream.foreachBatch(write).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def start_scoring(
    spark: SparkSession,
    reader_of: Callable[..., TopicReader],
    sinks: Mapping[str, Mapping[str, Sink]],
    checkpoint: str,
    every: str | None = v.TRIGGER,
    across_batches: bool = False,
    unique_within: str | None = None,
) -> list[StreamingQuery]:
    """One raw query per topic and the scoring query, each with its own checkpoint.

    ``reader_of(*topics)`` gives a reader of these topics only: each raw query subscribes to its own, so that
    no message is fetched for a query that drops it and rate limits are not shared.
    ``sinks`` holds the sinks of every topic and of ``"churn_risk"``. ``across_batches`` scores customers by all their events
    so far (``start_live_scores``); ``unique_within`` drops messages that are sent again within that time (``unique_messages``).
    """

    def messages(*topics: str) -> DataFrame:
        stream = reader_of(*topics)(spark, True)
        return unique_messages(stream, unique_within) if unique_within else stream

    # Repeats are told by a watermark on the time of messages, and a stream has only one.
    watermark = None if unique_within else v.WATERMARK
    queries = []
    for topic, fields in v.TOPIC_FIELDS.items():
        stream = parse_topic(messages(topic), fields, watermark=watermark)
        queries.append(
            start_batches(stream, raw_writer(topic, sinks[topic]), f"{checkpoint}/{topic}", topic, every)
        )
    if across_batches:
        events = parse_topics(messages(*v.TOPIC_FIELDS), v.TOPIC_FIELDS)
        live = start_live_scores(events, sinks["churn_risk"], f"{checkpoint}/churn_risk", "churn_risk", every)
        return [*queries, live]
    events = parse_topics(messages(*v.TOPIC_FIELDS), v.TOPIC_FIELDS, watermark=watermark)
    scores = score_writer(sinks["churn_risk"])
    queries.append(start_batches(events, scores, f"{checkpoint}/churn_risk", "churn_risk", every))
    return queries


def start_live_scores(
    events: DataFrame, sinks: Mapping[str, Sink], checkpoint: str, name: str | None = None, every: str | None = v.TRIGGER
) -> StreamingQuery:
    """Score customers by all their events so far, not only those of one micro-batch.

    Each batch writes the scores of the customers it brought events of; ``windows_now(written, ["customer_id"])`` reads the
    latest score of each. The opposite of ``score_writer``, for which a call needs the others in its own batch.
    """
    return start_batches(score_latest(events), raw_writer("live scores", sinks), checkpoint, name, every, mode="update")


def await_any(spark: SparkSession, timeout: int | None = None) -> None:
    """Wait until one query ends; its failure is raised here."""
    spark.streams.awaitAnyTermination(timeout)


def copy_topic(
    spark: SparkSession,
    reader: TopicReader,
    fields: str,
    sink: Sink,
    mode: str = "stream",
    checkpoint: str | None = None,
    every: str | None = v.TRIGGER,
) -> StreamingQuery | None:
    """Copy parsed messages to a sink: continuously (``stream``) or what is there now (``batch``).

    Every batch copy is a run of its own and adds to what is there.
    """
    if mode == "batch":
        rows = parse_topic(reader(spark, False), fields, time=None)
        raw_writer("copy", {"sink": sink}, bounded=True)(rows, 0)
        return None
    if mode != "stream":
        raise ValueError("mode is 'stream' or 'batch'")
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    rows = parse_topic(reader(spark, True), fields, time=None)
    return start_batches(rows, raw_writer("copy", {"sink": sink}), checkpoint, every=every)


def watched(stream: DataFrame, topics: Sequence[str] = (), name: str = METRICS) -> DataFrame:
    """Count rows (and rows per topic) of each batch on the side, without another pass."""
    per_topic = [F.count_if(F.col("topic") == t).alias(t) for t in topics]
    return stream.observe(name, F.count("*").alias("n_rows"), *per_topic)


def batch_metrics(query: StreamingQuery, name: str = METRICS) -> dict[int, dict[str, int]]:
    """Metrics of ``watched`` for the batches that Spark still remembers, a hundred unless set otherwise.

    For watching a running query; ``sinks.counts_sink`` keeps the counts of every batch.
    """
    found = {}
    for progress in query.recentProgress:
        row = progress["observedMetrics"].get(name)
        if row is not None:
            found[progress["batchId"]] = row.asDict() if hasattr(row, "asDict") else dict(row)
    return found


class BatchReports(StreamingQueryListener):
    """Hands the metrics of ``watched`` of every batch to ``report(query name or id, batch id, metrics)``.

    Spark calls it for each batch when it ends, so none is missed however few it remembers. Register with
    ``spark.streams.addListener``; ``await_end`` waits until the reports of a query have come in.
    """

    def __init__(self, report: Callable[[str, int, dict[str, Any]], None] | None = None, name: str = METRICS):
        self.report, self.name = report, name
        self.batches: dict[str, dict[int, dict[str, Any]]] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        if found is None:
            return
        metrics = found.asDict()
        with self._news:
            self.batches.setdefault(str(progress.id), {})[progress.batchId] = metrics
        if self.report is not None:
            self.report(progress.name or str(progress.id), progress.batchId, metrics)

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.id))
            self._news.notify_all()

    def await_end(self, query: StreamingQuery, timeout: float = 60) -> dict[int, dict[str, Any]]:
        """Metrics by batch of a query that has ended, once Spark has reported its end, which comes last."""
        with self._news:
            if not self._news.wait_for(lambda: query.id in self._ended, timeout):
                raise TimeoutError(f"no end of {query.id} was reported")
            return dict(self.batches.get(query.id, {}))


def unique_messages(messages: DataFrame, within: str = v.WATERMARK, time: str = "timestamp") -> DataFrame:
    """Messages of a topic stream, each once: repeats of topic, key and value are dropped.

    A repeat is known while its first copy is no more than ``within`` behind the newest message, after which the state forgets
    it; a later repeat is itself behind the watermark and dropped as well, and so is any message that late. Values are
    compared by their SHA-256. Null keys and values are equal to nulls.
    """
    digest = F.sha2(F.coalesce(F.col("value").cast("binary"), F.lit(b"")), 256)
    marked = messages.withColumns({"_digest": digest, "_null": F.col("value").isNull()}).withWatermark(time, within)
    return marked.dropDuplicatesWithinWatermark(["topic", "key", "_digest", "_null"]).drop("_digest", "_null")


def windowed(
    stream: DataFrame, summarize: Callable[[DataFrame], DataFrame], time: str = "event_time",
    watermark: str = v.WATERMARK,
) -> DataFrame:
    """Apply a windowed summary (event rate, score or network trend) to a stream with a watermark."""
    return summarize(stream.withWatermark(time, watermark))


def windows_writer(path: str) -> BatchWriter:
    """Keep each batch's new or changed windows; for queries in update mode."""
    return raw_writer("windows", {"windows": parquet_sink(path)})


def start_windows(
    stream: DataFrame, path: str, checkpoint: str, name: str | None = None, every: str | None = v.TRIGGER
) -> StreamingQuery:
    """Run a windowed summary in update mode: Spark forgets windows that the watermark has passed.

    Only changed windows are written; ``windows_now`` reads the latest state of each.
    """
    return start_batches(stream, windows_writer(path), checkpoint, name, every, mode="update")


def windows_now(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest state of every window of one run of ``start_windows``: the last batch that changed it."""
    return latest_per_key(written, list(keys), BATCH, []).drop(RUN, BATCH)
