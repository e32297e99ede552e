"""End-to-end flows: files to silver, malformed lines, topics in batch and as streams."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from pyspark.sql import functions as F

from checks.registry import ORACLES, query, rounded
from checks.rowwise import FEATURE_NAMES
from checks.star import LONG_DOUBLES, NETWORK_TREND_SQL, SCORED, _rounded_columns
from checks.views import CUTS_SQL, FEATURES_SQL, SILVER_RAW, TABLES, bronze, ctes, events, load
from churnkit.functions import snake_case
from churnkit.operators import append_rows, event_rate
from churnkit.plans import insights
from churnkit.plans import values as v
from churnkit.plans.silver import build_silver
from churnkit.scratch import new_path
from churnkit.sinks import STAMPS, counts_sink, format_sink, parquet_sink, write_silver
from churnkit.sources import (
    as_messages,
    file_topics,
    read_csv,
    read_silver,
    read_topics,
    register_staging,
    require_inputs,
    split_malformed,
    split_once,
)
from churnkit.streaming import (
    copy_topic,
    raw_writer,
    score_writer,
    start_batches,
    start_live_scores,
    start_scoring,
    start_windows,
    windowed,
    windows_now,
)

KINDS = {snake_case(f.split()[0]): f.split()[1] for f in (v.CLIENT_FIELDS + "," + v.RECORD_FIELDS).split(",")}
KEPT = [snake_case(c) for c in v.KEPT_COLUMNS]
NUMBERS = [c for c in KEPT if KINDS[c] != "string" and c not in ("customer_id", "churn")]
TEXTS = [c for c in KEPT if KINDS[c] == "string" and c not in v.CONSTANT_FILL]
RUN_TEXTS = ["pipeline_version", "source_system"]
MEDIANS = [c for c in NUMBERS if c not in v.CONSTANT_FILL]
SIGNED = [c for c in NUMBERS if "change" in c]
WEIGHED = [*NUMBERS, "churn"]


def _silver_sql() -> str:
    """All cleaning steps in SQL with exact quantiles."""
    clamp = ", ".join(f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END AS {c}" for c in NUMBERS if c not in SIGNED)
    medians = ", ".join(f"quantile_disc({c}, 0.5) AS {c}_med" for c in MEDIANS)
    modes = ", ".join(
        f"(SELECT {c} FROM clamped WHERE {c} <> '' GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}_mode"
        for c in TEXTS
    )
    filled = ", ".join(
        [f"coalesce({c}, {c}_med) AS {c}" for c in MEDIANS]
        + [f"upper(trim(coalesce({c}, {c}_mode))) AS {c}" for c in TEXTS]
        + [
            "coalesce(income, -1) AS income",
            "coalesce(adults, 0) AS adults",
            "coalesce(prizm_social_one, 'Unknown') AS prizm_social_one",
        ]
    )
    fences = ", ".join(
        f"quantile_disc({c}, 0.25) AS {c}_q1, quantile_disc({c}, 0.75) AS {c}_q3, "
        f"quantile_disc({c}, 0.01) AS {c}_low, quantile_disc({c}, 0.99) AS {c}_high"
        for c in WEIGHED
    )
    shares = ", ".join(
        f"avg(CASE WHEN {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) "
        f"THEN 1.0 ELSE 0.0 END) AS {c}_share"
        for c in WEIGHED
    )
    caps = ", ".join(
        f"CASE WHEN {c}_share > 0.01 THEN "
        + (f"greatest(least({c}, {c}_high), {c}_low)" if c in SIGNED else f"least({c}, {c}_high)")
        + f" ELSE {c} END AS {c}"
        for c in WEIGHED
    )
    columns = ", ".join([*KEPT, "pipeline_run_ts", *RUN_TEXTS])
    new = [c for c in FEATURE_NAMES if c not in KEPT]
    raw = SILVER_RAW.format(**{t: t for t in TABLES})
    return f"""
    WITH silver_raw AS ({raw}),
    focused AS (SELECT * EXCLUDE (customer_id, pipeline_run_ts), customer_id::INTEGER AS customer_id,
      timestamp '2024-01-05 12:00:00' AS pipeline_run_ts, '1.0.0-LOCAL' AS pipeline_version,
      'GCS_CSV' AS source_system FROM silver_raw WHERE customer_id % 97 <> 0),
    clamped AS (SELECT * REPLACE ({clamp}) FROM focused),
    fills AS (SELECT {medians}, {modes} FROM clamped),
    filled AS (SELECT clamped.* REPLACE ({filled}) FROM clamped, fills),
    fences AS (SELECT {fences} FROM filled),
    shares AS (SELECT {shares} FROM filled, fences),
    capped AS (SELECT filled.* REPLACE ({caps}) FROM filled, fences, shares),
    base AS (SELECT {columns} FROM capped), {CUTS_SQL}, {FEATURES_SQL}
    SELECT {_rounded_columns([*KEPT, "pipeline_run_ts", *RUN_TEXTS, *new], LONG_DOUBLES)} FROM featured
    """


@query("silver_from_files", _silver_sql())
def silver_from_files(spark, sf_dir):
    """Bronze CSV files to silver Parquet and back, with exact statistics."""
    paths = {}
    for name, df in zip(("client", "record"), bronze(spark, sf_dir)):
        paths[name] = new_path(spark, name)
        write_silver(df, paths[name], "csv")
    require_inputs(spark, {name: ("csv", path) for name, path in paths.items()})
    client = read_csv(spark, paths["client"], v.CLIENT_FIELDS)
    record = read_csv(spark, paths["record"], v.RECORD_FIELDS)
    started = datetime(2024, 1, 5, 10, 0, tzinfo=timezone.utc)
    out = new_path(spark, "silver")
    write_silver(build_silver(client, record, started, rel_error=0, cap_error=0), out)
    silver = read_silver(spark, out)
    long = {c: F.round(c, 6) for c in LONG_DOUBLES}
    return silver.withColumns(long)


@query(
    "csv_malformed_split",
    """
    SELECT CASE WHEN p_partkey % 10 NOT IN (3, 5, 7) THEN p_partkey END AS p_partkey,
      CASE WHEN p_partkey % 10 NOT IN (3, 5, 7) THEN p_size END AS p_size,
      CASE WHEN p_partkey % 10 NOT IN (3, 5, 7) THEN p_brand END AS p_brand,
      CASE p_partkey % 10 WHEN 3 THEN concat(p_partkey, ',', p_size)
        WHEN 5 THEN concat(p_partkey, ',', p_size, ',', p_brand, ',more')
        WHEN 7 THEN concat(p_partkey, ',x', p_size, ',', p_brand) END AS line
    FROM part
    """,
)
def malformed(spark, sf_dir):
    """Short, long and ill-typed lines are told apart from good ones."""
    return append_rows(*split_malformed(part_lines(spark, sf_dir)))


def part_lines(spark, sf_dir):
    """Parts as CSV lines of which some are short, long or ill-typed, read back."""
    lines = load(spark, sf_dir, "part").selectExpr(
        """CASE p_partkey % 10 WHEN 3 THEN concat(p_partkey, ',', p_size)
        WHEN 5 THEN concat(p_partkey, ',', p_size, ',', p_brand, ',more')
        WHEN 7 THEN concat(p_partkey, ',x', p_size, ',', p_brand)
        ELSE concat(p_partkey, ',', p_size, ',', p_brand) END AS line"""
    )
    path = new_path(spark, "lines")
    lines.write.text(path)
    return read_csv(spark, path, "p_partkey bigint, p_size int, p_brand string", header=False, corrupt="_corrupt")


@query("csv_parsed_once", ORACLES["csv_malformed_split"])
def csv_parsed_once(spark, sf_dir):
    """The same split over one written table, so that the lines are parsed once."""
    return append_rows(*split_once(part_lines(spark, sf_dir)))


def write_topics(spark, sf_dir) -> str:
    """All three kinds of event as JSON messages in files."""
    path = new_path(spark, "topics")
    names = (v.CALLS_TOPIC, v.NETWORK_TOPIC, v.USAGE_TOPIC)
    measures = (v.CALL_MEASURES, v.NETWORK_MEASURES, v.USAGE_MEASURES)
    for topic, columns, df in zip(names, measures, events(spark, sf_dir)):
        text_time = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time")
        messages = as_messages(df.select("customer_id", *columns, text_time), "customer_id", topic)
        messages.withColumn("timestamp", F.lit(None).cast("timestamp")).write.mode("append").parquet(path)
    return path


@query(
    "topics_parsed",
    ctes("calls", "network", "usage")
    + """
    SELECT 'customer_care_calls' AS topic, customer_id, event_time, anger_rate, resolved, NULL AS dropped_calls,
      NULL AS package_usage_pct FROM calls
    UNION ALL SELECT 'network_events', customer_id, event_time, NULL, NULL, dropped_calls, NULL FROM network
    UNION ALL SELECT 'usage_events', customer_id, event_time, NULL, NULL, NULL, package_usage_pct FROM usage
    """,
)
def topics_parsed(spark, sf_dir):
    """Several topics as one table with the columns of all."""
    parsed = read_topics(spark, file_topics(write_topics(spark, sf_dir)), v.TOPIC_FIELDS, streaming=False)
    return parsed.select(
        "topic", "customer_id", "event_time", "anger_rate", "resolved", "dropped_calls", "package_usage_pct"
    )


def _by_measures(sql: str) -> str:
    """Messages carry no event id: equal times are settled by the measures, highest first."""
    for view_name, measures in (
        ("calls", v.CALL_MEASURES), ("network", v.NETWORK_MEASURES), ("usage", v.USAGE_MEASURES)
    ):
        order = ", ".join(f"{m} DESC NULLS LAST" for m in measures)
        start = sql.index(f"{view_name}_latest AS")
        sql = sql[:start] + sql[start:].replace("event_id DESC", order, 1)
    return sql


@query("stream_score", _by_measures(SCORED) + "SELECT * FROM scored")
def stream_score(spark, sf_dir):
    """Scoring query over a topic stream, drained once."""
    stream = read_topics(spark, file_topics(write_topics(spark, sf_dir)), v.TOPIC_FIELDS, watermark=v.WATERMARK)
    out = new_path(spark, "scores")
    start_batches(
        stream, score_writer({"files": parquet_sink(out)}), new_path(spark, "offsets"), every=None
    ).awaitTermination()
    return spark.read.parquet(out).drop(*STAMPS)


@query("stream_score_so_far", _by_measures(SCORED) + "SELECT * FROM scored")
def stream_score_so_far(spark, sf_dir):
    """Events of one customer come in different batches, and a restart; scores are those of all events together."""
    out, offsets, reader = new_path(spark, "scores"), new_path(spark, "offsets"), topic_files(spark, sf_dir)
    for _ in range(2):
        stream = read_topics(spark, reader(), v.TOPIC_FIELDS)
        start_live_scores(stream, {"files": parquet_sink(out)}, offsets, every=None).awaitTermination()
    written = spark.read.parquet(out)
    if written.select("batch_id").distinct().count() < 3:
        raise RuntimeError("the stream was to take several batches")
    return windows_now(written, ["customer_id"])


# A range of time is not cut into files of fewer rows.
ROWS_A_FILE = 1024


def in_files(spark, rows, time, first="old", files=3):
    """Rows as files by ranges of time, oldest or newest range first, and the number of files of each range.

    A stream takes one range a batch. All ranges are written by equally many tasks, as many as the smallest one fills.
    """
    path = new_path(spark, "files")
    cuts = rows.agg(F.min(time).alias("low"), F.max(time).alias("high")).select(
        F.col("low").cast("timestamp").cast("double"), F.col("high").cast("timestamp").cast("double")
    ).first()
    width = (cuts[1] - cuts[0]) / files
    part = F.least(F.floor((F.col(time).cast("timestamp").cast("double") - cuts[0]) / width), F.lit(files - 1))
    sizes = {r["part"]: r["count"] for r in rows.groupBy(part.alias("part")).count().collect()}
    tasks = min(sizes.get(i, 0) for i in range(files)) // ROWS_A_FILE
    tasks = max(1, min(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for i in range(files) if first == "old" else reversed(range(files)):
        rows.where(part == i).repartition(tasks).write.mode("append").parquet(path)
    if len(spark.read.parquet(path).inputFiles()) != tasks * files:
        raise RuntimeError("every range was to have equally many files")
    return path, tasks


def drain_windows(spark, stream, keys):
    """Run a windowed summary over everything there is, in update mode, and read the latest windows."""
    out = new_path(spark, "windows")
    query = start_windows(stream, out, new_path(spark, "offsets"), every=None)
    query.awaitTermination()
    written = spark.read.parquet(out)
    if written.select("batch_id").distinct().count() < 2:
        raise RuntimeError("the stream was to take several batches")
    return windows_now(written, keys)


def event_stream(spark, sf_dir, first="old"):
    """The event table as a stream of three batches."""
    rows = load(spark, sf_dir, "events")
    path, tasks = in_files(spark, rows, "ts", first)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", tasks).parquet(path)
    return stream.withColumn("event_time", F.col("ts").cast("timestamp"))


def hourly(events):
    return event_rate(events, "event_time", "1 hour", 3600, ["event_type"])


@query(
    "stream_event_rate",
    """
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events,
      round(count(*) / 3600.0, 6) AS events_per_sec FROM events GROUP BY ALL
    """,
)
def stream_event_rate(spark, sf_dir):
    """Hourly rates over several batches; closed windows leave the state."""
    rates = windowed(event_stream(spark, sf_dir), hourly)
    return rounded(drain_windows(spark, rates, ["window_start", "event_type"]))


@query(
    "late_rows",
    """
    WITH cuts AS (SELECT epoch(min(ts)) AS low, (epoch(max(ts)) - epoch(min(ts))) / 3 AS width FROM events),
    parts AS (SELECT ts, event_type, least(floor((epoch(ts) - low) / width), 2) AS part FROM events, cuts),
    marks AS (SELECT part, max(ts) OVER (ORDER BY part DESC RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
      - INTERVAL 10 MINUTE AS mark, ts, event_type FROM parts)
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events FROM marks
    WHERE mark IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark GROUP BY ALL
    """,
)
def late_rows(spark, sf_dir):
    """The newest file first: what the watermark drops of the older ones, and what it still takes in.

    A batch judges lateness by the watermark that the batch before it went by.
    """
    rates = windowed(event_stream(spark, sf_dir, "new"), hourly)
    written = new_path(spark, "windows")
    start_windows(rates, written, new_path(spark, "offsets"), every=None).awaitTermination()
    now = windows_now(spark.read.parquet(written), ["window_start", "event_type"])
    return now.drop("events_per_sec")


@query("stream_network_trend", NETWORK_TREND_SQL)
def stream_network_trend(spark, sf_dir):
    """Network trend over several batches of messages."""
    messages = spark.read.parquet(write_topics(spark, sf_dir)).where(F.col("topic") == v.NETWORK_TOPIC)
    sent = messages.withColumn("sent", F.get_json_object("value", "$.event_time"))
    path, tasks = in_files(spark, sent, "sent")
    topics = file_topics(path, v.NETWORK_TOPIC, files_per_trigger=tasks)
    stream = windowed(read_topics(spark, topics, {v.NETWORK_TOPIC: v.NETWORK_FIELDS}), insights.network_trend)
    return rounded(drain_windows(spark, stream, [stream.columns[0]]))


COPIED = (
    ctes("usage")
    + """
    SELECT customer_id, voice_minutes, data_usage_mb, sms_count, package_usage_pct,
      strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM usage
    """
)


@query("batch_copy", COPIED)
def batch_copy(spark, sf_dir):
    """Everything a topic holds, copied once."""
    out = new_path(spark, "copy")
    topics = file_topics(write_topics(spark, sf_dir), v.USAGE_TOPIC)
    copy_topic(spark, topics, v.USAGE_FIELDS, format_sink("parquet", path=out), mode="batch")
    return spark.read.parquet(out).drop(*STAMPS)


@query("stream_copy", COPIED)
def stream_copy(spark, sf_dir):
    """The same copy as a stream."""
    out = new_path(spark, "copy")
    topics = file_topics(write_topics(spark, sf_dir), v.USAGE_TOPIC)
    sink = format_sink("parquet", path=out)
    copy_topic(
        spark, topics, v.USAGE_FIELDS, sink, checkpoint=new_path(spark, "offsets"), every=None
    ).awaitTermination()
    return spark.read.parquet(out).drop(*STAMPS)


def topic_files(spark, sf_dir, topic_rows="topics"):
    """All messages in several files, a batch each."""
    messages = spark.read.parquet(write_topics(spark, sf_dir))
    path = new_path(spark, topic_rows)
    messages.repartition(4, F.xxhash64("key", "value")).write.parquet(path)
    return partial(file_topics, path, files_per_trigger=1)


TOPIC_ROWS = ctes("calls", "network", "usage") + """
    SELECT 'customer_care_calls' AS topic, count(*) AS n_rows FROM calls
    UNION ALL SELECT 'network_events', count(*) FROM network
    UNION ALL SELECT 'usage_events', count(*) FROM usage
    """


@query("stream_metrics", TOPIC_ROWS)
def stream_metrics(spark, sf_dir):
    """Rows per topic over all batches, although Spark itself remembers the last one only."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "1")
    try:
        stream = read_topics(spark, topic_files(spark, sf_dir)(), v.TOPIC_FIELDS)
        counts = new_path(spark, "counts")
        sinks = {"files": parquet_sink(new_path(spark, "raw")), "counts": counts_sink(counts)}
        start_batches(stream, raw_writer("events", sinks), new_path(spark, "offsets"), every=None).awaitTermination()
    finally:
        spark.conf.set(kept, before)
    written = spark.read.parquet(counts)
    if written.select("batch_id").distinct().count() < 3:
        raise RuntimeError("the stream was to take several batches")
    return written.groupBy("topic").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "two_runs_one_folder",
    ctes("usage") + "SELECT customer_id, voice_minutes, 4 * count(*) AS n_rows FROM usage GROUP BY ALL",
)
def two_runs_one_folder(spark, sf_dir):
    """Two streams with checkpoints of their own, one of them restarted, and two copies share a folder."""
    reader, out = topic_files(spark, sf_dir), new_path(spark, "shared")
    sink = parquet_sink(out)
    checkpoints = [new_path(spark, "offsets") for _ in range(2)]
    for checkpoint in (*checkpoints, checkpoints[0]):
        stream = read_topics(spark, reader(v.USAGE_TOPIC), {v.USAGE_TOPIC: v.USAGE_FIELDS})
        start_batches(stream.drop("topic"), raw_writer("usage", {"files": sink}), checkpoint, every=None).awaitTermination()
    for _ in range(2):
        copy_topic(spark, file_topics(write_topics(spark, sf_dir), v.USAGE_TOPIC), v.USAGE_FIELDS, sink, mode="batch")
    rows = spark.read.parquet(out)
    return rows.groupBy("customer_id", "voice_minutes").agg(F.count("*").alias("n_rows"))


COUNTED = TOPIC_ROWS.replace("count(*) AS n_rows", "count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers")


@query("raw_topics", COUNTED.replace("count(*) FROM", "count(*), count(DISTINCT customer_id) FROM"))
def raw_topics(spark, sf_dir):
    """The scoring service's raw folders, read back after several batches of each topic."""
    root = new_path(spark, "service")
    names = [*v.TOPIC_FIELDS, "churn_risk"]
    sinks = {n: {"files": parquet_sink(f"{root}/{n}")} for n in names}
    for running in start_scoring(spark, topic_files(spark, sf_dir), sinks, new_path(spark, "offsets"), every=None):
        running.awaitTermination()
    parts = []
    for topic in v.TOPIC_FIELDS:
        rows = spark.read.parquet(f"{root}/{topic}")
        if rows.select("batch_id").distinct().count() < 2:
            raise RuntimeError("the stream was to take several batches")
        counted = rows.agg(F.count("*").alias("n_rows"), F.countDistinct("customer_id").alias("n_customers"))
        parts.append(counted.select(F.lit(topic).alias("topic"), "*"))
    return append_rows(append_rows(parts[0], parts[1]), parts[2])


@query(
    "staging_views",
    ctes("calls", "usage")
    + """
    SELECT customer_id, count(*) AS n_calls, (SELECT count(*) FROM usage u WHERE u.customer_id = c.customer_id) AS n_usage
    FROM calls c GROUP BY customer_id
    """,
)
def staging_views(spark, sf_dir):
    """Plain SQL over named staging tables."""
    calls, _, usage = events(spark, sf_dir)
    register_staging({"calls": calls, "usage": usage})
    return spark.sql(
        """
        SELECT c.customer_id, n_calls, coalesce(n_usage, 0) AS n_usage
        FROM (SELECT customer_id, count(*) AS n_calls FROM stg_calls GROUP BY customer_id) c
        LEFT JOIN (SELECT customer_id, count(*) AS n_usage FROM stg_usage GROUP BY customer_id) u
          ON c.customer_id = u.customer_id
        """
    )
