"""What is kept from one load, increment or batch to the next: keys, sums, late rows, messages seen, commits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.flows import COPIED, TOPIC_ROWS, event_stream, in_files, topic_files, write_topics
from checks.registry import ORACLES, query, rounded
from checks.star import ALL_DIMS, EVENT_VIEWS, FACT_CALL, FACT_USAGE, MEANS, MEANS_SQL, _rounded_columns
from checks.views import ctes, customers, events, load
from churnkit.operators import append_rows, column_sketches
from churnkit.operators.distinct import distinct_sink, kept_distinct
from churnkit.plans import increments, warehouse
from churnkit.plans import values as v
from churnkit.scratch import new_path
from churnkit.sinks import STAMPS, Ledger, ledger_sink, parquet_sink
from churnkit.sources import file_topics, read_topics
from churnkit.streaming import (
    BatchReports,
    copy_topic,
    late_account,
    late_writer,
    raw_writer,
    start_batches,
    unique_messages,
    watched,
)


def _two_loads_sql(key: str, attributes: list[str]) -> str:
    """Keys of the first load's tuples in their order, then those of the tuples that only the second one brings."""
    columns = ", ".join(attributes)
    order = ", ".join(f"{a} NULLS FIRST" for a in attributes)
    return f"""
    first AS (SELECT DISTINCT {columns} FROM silver WHERE customer_id % 3 <> 0),
    known AS (SELECT row_number() OVER (ORDER BY {order}) AS {key}, * FROM first),
    added AS (SELECT DISTINCT {columns} FROM silver EXCEPT SELECT * FROM first)
    SELECT * FROM known UNION ALL
    SELECT row_number() OVER (ORDER BY {order}) + (SELECT count(*) FROM known), * FROM added
    """


def two_loads(spark, sf_dir, name):
    """A first load of two customers in three, which is repeated, then one of all."""
    rows, root = customers(spark, sf_dir), new_path(spark, "keys")
    model = {
        "dim_customer": ("customer_key", v.CUSTOMER_ATTRIBUTES),
        "dim_customer_loyalty": ("loyalty_key", v.LOYALTY_ATTRIBUTES),
        "dim_device": ("device_key", v.DEVICE_ATTRIBUTES),
    }[name]
    some = rows.where("customer_id % 3 <> 0")
    for load_id, loaded in ((1, some), (1, some), (2, rows)):
        known = warehouse.stable_keys(loaded, *model, root, load_id)
    return known


@query("stable_dim_customer", ctes("silver", more=_two_loads_sql("customer_key", v.CUSTOMER_ATTRIBUTES)))
def stable_dim_customer(spark, sf_dir):
    return two_loads(spark, sf_dir, "dim_customer")


@query("stable_dim_device", ctes("silver", more=_two_loads_sql("device_key", v.DEVICE_ATTRIBUTES)))
def stable_dim_device(spark, sf_dir):
    return two_loads(spark, sf_dir, "dim_device")


def three_increments(spark, sf_dir):
    """All events in three increments, a usage event and the network events of its hour often apart; one is run twice, two are folded."""
    calls, network, usage = events(spark, sf_dir)
    root = new_path(spark, "increments")
    for i in (0, 1, 1, 2):
        if i == 2:
            increments.fold(spark, root)
        increments.add_events(root, i, *(t.where(F.col("event_id") % 3 == i) for t in (usage, network, calls)))
    return root, {"dim_customer": warehouse.dim_customer(customers(spark, sf_dir))}


@query("usage_means_of_increments", ORACLES["usage_means"])
def usage_means_of_increments(spark, sf_dir):
    root, dims = three_increments(spark, sf_dir)
    return rounded(increments.usage_means(spark, root, dims))


CARE_COLUMNS = ["customer_key", "avg_anger_rate", "avg_call_duration_sec", "resolution_rate"]


@query(
    "care_means_of_increments",
    ctes("silver", *EVENT_VIEWS, more=f"{ALL_DIMS}, {FACT_USAGE}, {FACT_CALL}, {MEANS_SQL}")
    + f"SELECT {_rounded_columns(CARE_COLUMNS, MEANS)} FROM care_means",
)
def care_means_of_increments(spark, sf_dir):
    root, dims = three_increments(spark, sf_dir)
    return rounded(increments.care_means(spark, root, dims))


def _marked(select: str) -> str:
    """The newest third of the time range first; a batch is judged by the newest time up to two batches before it."""
    sql = ORACLES["late_rows"]
    return sql[: sql.index("SELECT date_trunc")] + select


@query(
    "late_kept",
    _marked(
        """SELECT event_type, count(*) FILTER (mark IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark) AS n_taken,
        count(*) FILTER (date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark) AS n_late FROM marks GROUP BY ALL"""
    ),
)
def late_kept(spark, sf_dir):
    """What the watermark of ``late_rows`` drops goes to a folder of its own; with what is taken these are all rows."""
    taken, late, account = (new_path(spark, name) for name in ("taken", "late", "account"))
    write = late_writer({"files": parquet_sink(taken)}, {"files": parquet_sink(late)}, account, width="1 hour", lag=2)
    start_batches(event_stream(spark, sf_dir, "new"), write, new_path(spark, "offsets"), every=None).awaitTermination()
    batches = late_account(spark, account).agg(F.count("*"), F.sum("n_taken"), F.sum("n_late")).first()
    kept = spark.read.parquet(taken).withColumn("is_late", F.lit(False))
    gone = spark.read.parquet(late).withColumn("is_late", F.lit(True))
    if batches[0] < 3 or (batches[1], batches[2]) != (kept.count(), gone.count()):
        raise RuntimeError("the account differs from the folders")
    return kept.unionByName(gone).groupBy("event_type").agg(
        F.count_if(~F.col("is_late")).alias("n_taken"), F.count_if("is_late").alias("n_late")
    )


@query(
    "stream_unique",
    ctes("usage")
    + """
    SELECT customer_id AS key, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS sent, count(*) AS n_rows FROM
      (SELECT DISTINCT customer_id, voice_minutes, data_usage_mb, sms_count, package_usage_pct, event_time FROM usage) GROUP BY ALL
    """,
)
def stream_unique(spark, sf_dir):
    """Every usage message is sent twice, and those of the last third of the time once more with the one before; each is kept once,
    also over a restart."""
    messages = spark.read.parquet(write_topics(spark, sf_dir)).where(F.col("topic") == v.USAGE_TOPIC)
    sent = messages.withColumn("timestamp", F.get_json_object("value", "$.event_time").cast("timestamp"))
    path, tasks = in_files(spark, append_rows(sent, sent), "timestamp")
    out, offsets = new_path(spark, "unique"), new_path(spark, "offsets")
    reader = file_topics(path, v.USAGE_TOPIC, files_per_trigger=tasks)

    def run():
        stream = unique_messages(reader(spark, True), "1 hour")
        start_batches(stream, raw_writer("usage", {"files": parquet_sink(out)}), offsets, every=None).awaitTermination()

    run()
    # The newest messages come once more after a restart.
    newest = sent.agg(F.max("timestamp")).first()[0]
    again = sent.where(F.col("timestamp") > F.lit(newest) - F.expr("INTERVAL 1 HOUR"))
    again.coalesce(1).write.mode("append").parquet(path)
    run()
    rows = spark.read.parquet(out)
    if rows.select("batch_id").distinct().count() < 3:
        raise RuntimeError("the stream was to take several batches")
    return rows.groupBy("key", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("sent")).agg(F.count("*").alias("n_rows"))


@query("reported_metrics", TOPIC_ROWS)
def reported_metrics(spark, sf_dir):
    """Rows per topic of every batch from a listener, although Spark itself remembers the last one only."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "1")
    reports = BatchReports()
    spark.streams.addListener(reports)
    try:
        stream = watched(read_topics(spark, topic_files(spark, sf_dir)(), v.TOPIC_FIELDS), list(v.TOPIC_FIELDS))
        running = start_batches(
            stream, raw_writer("events", {"files": parquet_sink(new_path(spark, "raw"))}), new_path(spark, "offsets"), every=None
        )
        running.awaitTermination()
        batches = reports.await_end(running)
    finally:
        spark.streams.removeListener(reports)
        spark.conf.set(kept, before)
    if len(batches) < 3:
        raise RuntimeError("the stream was to take several batches")
    rows = [(t, sum(m[t] for m in batches.values())) for t in v.TOPIC_FIELDS]
    return spark.createDataFrame(rows, "topic string, n_rows long")


@query("ledger_copy", COPIED)
def ledger_copy(spark, sf_dir):
    """A copy into JSON files through a ledger; every batch fails once after its rows are written, and is run again."""
    root, offsets = new_path(spark, "ledger"), new_path(spark, "offsets")
    reader = topic_files(spark, sf_dir)(v.USAGE_TOPIC)
    write, failed = ledger_sink(spark, root, "json"), set()

    def sink(batch, batch_id):
        if batch_id not in failed:
            failed.add(batch_id)
            Ledger(spark, root, "json").write_rows(batch)
            raise RuntimeError("lost after the rows, before the commit")
        write(batch, batch_id)

    while True:
        running = copy_topic(spark, reader, v.USAGE_FIELDS, sink, checkpoint=offsets, every=None)
        try:
            running.awaitTermination()
            break
        except Exception as error:
            if "before the commit" not in str(error):
                raise
    schema = f"{v.USAGE_FIELDS}, run_id string, batch_id long"
    return Ledger(spark, root, "json").read(schema=schema).drop(*STAMPS)


SKETCHED_PROBS = (0.1, 0.25, 0.5, 0.75, 0.9)


@query(
    "quantile_merged_error",
    "WITH x AS (SELECT value FROM events) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS prob, count(*) AS n, true AS within FROM x"
        for c in ("plain", "infinite")
        for p in SKETCHED_PROBS
    ),
)
def quantile_merged_error(spark, sf_dir):
    """Sketches of many tasks merged in groups and then over the groups; a fifth of one column is infinite at either end."""
    infinite = "CASE event_id % 5 WHEN 0 THEN double('Infinity') WHEN 1 THEN double('-Infinity') ELSE value END AS infinite"
    rows, error = load(spark, sf_dir, "events").selectExpr("event_id", "value AS plain", infinite), 0.01
    columns = ["plain", "infinite"]
    sketches = column_sketches(rows.repartition(24, "event_id"), columns, error, groups=4)
    probs = F.array(*map(F.lit, SKETCHED_PROBS))
    marks = {r["name"]: r["marks"] for r in sketches.select("name", F.kll_sketch_get_quantile_double("sketch", probs).alias("marks")).collect()}
    judged = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(p).alias("prob"),
            F.count("*").alias("n"),
            ((F.avg((F.col(c) <= m).cast("int")) >= p - error) & (F.avg((F.col(c) < m).cast("int")) <= p + error)).alias("within"),
        )
        for c in columns
        for p, m in zip(SKETCHED_PROBS, marks[c], strict=True)
    ]
    return rows.agg(F.array(*judged).alias("rows")).select(F.inline("rows"))


@query(
    "daily_customers",
    ctes(*EVENT_VIEWS)
    + """
    SELECT topic, event_time::DATE AS day, count(*) AS n_rows, true AS within FROM (
      SELECT 'customer_care_calls' AS topic, customer_id, event_time FROM calls UNION ALL
      SELECT 'network_events', customer_id, event_time FROM network UNION ALL
      SELECT 'usage_events', customer_id, event_time FROM usage) GROUP BY ALL
    """,
)
def daily_customers(spark, sf_dir):
    """Distinct customers of each day from sketches kept per batch, within 3 % of an exact count over all events."""
    root, by = new_path(spark, "sketches"), ["topic", "day"]
    stream = read_topics(spark, topic_files(spark, sf_dir)(), v.TOPIC_FIELDS).withColumn("day", F.to_date("event_time"))
    writer = raw_writer("customers", {"sketches": distinct_sink(spark, root, by, "customer_id")})
    start_batches(stream, writer, new_path(spark, "offsets"), every=None).awaitTermination()
    rows = read_topics(spark, topic_files(spark, sf_dir)(), v.TOPIC_FIELDS, streaming=False)
    exact = rows.groupBy("topic", F.to_date("event_time").alias("day")).agg(F.countDistinct("customer_id").alias("n"))
    within = F.abs(F.col("n_distinct") - F.col("n")) <= F.greatest(F.col("n") * 0.03, F.lit(1))
    return kept_distinct(spark, root, by).join(exact, by).select(*by, "n_rows", within.alias("within"))
