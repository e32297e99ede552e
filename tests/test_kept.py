"""What outlives a load, an increment or a batch: ledgers, keys, sums, late rows, repeated messages, reports."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from churnkit.operators.distinct import distinct_sink, distinct_sketches, kept_distinct, merged_distinct
from churnkit.operators.keys import stable_keys
from churnkit.operators.partials import fold_increments, merged_sums, store_increment
from churnkit.plans import increments
from churnkit.plans import values as v
from churnkit.plans.scoring import score_events, score_latest
from churnkit.sinks import Ledger, ledger_sink, numbered, parquet_sink
from churnkit.sources import read_csv, split_once
from churnkit.sources.topics import MESSAGE_FIELDS
from churnkit.streaming import BatchReports, late_account, late_writer, raw_writer, start_batches, unique_messages, watched


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Ledger


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_ledger_replaces_an_entry_and_hides_what_is_not_committed(spark, tmp_path, fmt):
    ledger = Ledger(spark, str(tmp_path / "ledger"), fmt)
    assert ledger.read() is None and ledger.commits() == {}
    ledger.commit(spark.range(3), "a")
    ledger.commit(spark.range(10, 12), "b")
    ledger.write_rows(spark.range(100, 200))  # lost before its commit
    assert bag(ledger.read(schema="id long")) == [(0,), (1,), (10,), (11,), (2,)]
    ledger.commit(spark.range(5, 6), "a")
    assert bag(ledger.read(schema="id long")) == [(10,), (11,), (5,)]
    assert bag(ledger.read(["b", "none"], schema="id long")) == [(10,), (11,)]
    assert ledger.read(["none"]) is None
    assert ledger.clear_replaced() == 2
    assert bag(ledger.read(schema="id long")) == [(10,), (11,), (5,)] and ledger.commits()["a"].attempt == 1


def test_ledger_refuses_names_it_cannot_tell_apart(spark, tmp_path):
    for name in ("a~b", "a/b"):
        with pytest.raises(ValueError, match="no name"):
            Ledger(spark, str(tmp_path)).commit(spark.range(1), name)


def test_failing_batches_through_a_ledger(spark, tmp_path):
    """Each batch fails once after its rows are there; readers see every row once."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    sink, failed = ledger_sink(spark, root), set()

    def faulty(batch, batch_id):
        if batch_id in failed:
            return sink(batch, batch_id)
        failed.add(batch_id)
        Ledger(spark, root).write_rows(batch)
        raise RuntimeError("down")

    for _ in range(4):
        try:
            start_batches(stream, raw_writer("ids", {"files": faulty}), str(tmp_path / "offsets"), every=None).awaitTermination()
        except StreamingQueryException:
            continue
    rows = Ledger(spark, root).read()
    assert failed == {0, 1, 2} and sorted(r.id for r in rows.collect()) == list(range(30))


# Keys


def tuples(spark, rows):
    return spark.createDataFrame(rows, "a string, b int, other string")


def test_keys_stay_and_new_ones_follow(spark, tmp_path):
    root = str(tmp_path / "keys")
    first = tuples(spark, [("x", 1, "p"), ("x", 1, "q"), (None, 2, "p"), ("b", None, "p")])
    assert bag(stable_keys(first, "k", ["a", "b"], root, 1)) == [(1, None, 2), (2, "b", None), (3, "x", 1)]
    second = tuples(spark, [("a", 9, "p"), (None, 2, "p"), (None, None, "p"), ("x", 1, "p"), ("b", None, "z"), ("a", 9, "q")])
    known = bag(stable_keys(second, "k", ["a", "b"], root, 2))
    assert known == [(1, None, 2), (2, "b", None), (3, "x", 1), (4, None, None), (5, "a", 9)]
    # Repeated with other rows: what the load added is replaced.
    more = second.unionAll(tuples(spark, [("0", 0, "p")]))
    assert bag(stable_keys(more, "k", ["a", "b"], root, 2)) == known[:3] + [(4, None, None), (5, "0", 0), (6, "a", 9)]
    with pytest.raises(ValueError, match="comes after"):
        stable_keys(first, "k", ["a", "b"], root, 1)


def test_keys_of_empty_loads(spark, tmp_path):
    root, none = str(tmp_path / "keys"), tuples(spark, [])
    assert bag(stable_keys(none, "k", ["a", "b"], root, 1)) == []
    assert bag(stable_keys(tuples(spark, [("x", 1, "p")]), "k", ["a", "b"], root, 2)) == [(1, "x", 1)]
    assert bag(stable_keys(none, "k", ["a", "b"], root, 3)) == [(1, "x", 1)]


def test_many_loads_give_gapless_keys(spark, tmp_path):
    root, seen = str(tmp_path / "keys"), {}
    for n in range(4):
        rows = spark.range(0, 100 * (n + 1), 3).selectExpr("id % 97 + id AS t")
        known = {r.t: r.k for r in stable_keys(rows, "k", ["t"], root, n).collect()}
        assert seen.items() <= known.items() and sorted(known.values()) == list(range(1, len(known) + 1))
        seen = known


# Sums


def test_sums_of_retried_and_folded_increments(spark, tmp_path):
    root = str(tmp_path / "sums")

    def sums(rows):
        df = spark.createDataFrame(rows, "key string, x int")
        return df.groupBy("key").agg(F.sum("x").alias("x_sum"), F.count("x").alias("x_n"), F.count("*").alias("n"))

    with pytest.raises(ValueError, match="no increment"):
        merged_sums(spark, root, ["key"])
    store_increment(sums([("a", 1), ("a", None), (None, 5)]), root, 0)
    store_increment(sums([("a", 100)]), root, 1)
    store_increment(sums([("a", 10), ("b", None)]), root, 1)
    expected = [("a", 11, 2, 3), ("b", None, 0, 1), (None, 5, 1, 1)]
    assert bag(merged_sums(spark, root, ["key"])) == expected
    assert fold_increments(spark, root, ["key"]) == 1
    assert bag(merged_sums(spark, root, ["key"])) == expected
    with pytest.raises(ValueError, match="part of the base"):
        store_increment(sums([("a", 1)]), root, 1)
    store_increment(sums([("b", 7)]), root, 2)
    expected = [("a", 11, 2, 3), ("b", 7, 1, 2), (None, 5, 1, 1)]
    assert bag(merged_sums(spark, root, ["key"])) == expected
    assert fold_increments(spark, root, ["key"], tasks=2) == 2 and bag(merged_sums(spark, root, ["key"])) == expected


def test_pairs_across_increments_count(spark, tmp_path):
    """A usage event meets the network event of its time whichever comes first."""
    hour = datetime(2024, 1, 1, 5)
    keys = "customer_id string, event_time timestamp"
    usage = spark.createDataFrame(
        [("1", hour, 10, 50), ("1", hour + timedelta(hours=1), 30, 70)], f"{keys}, data_usage_mb int, package_usage_pct int"
    )
    network = spark.createDataFrame(
        [("1", hour, 5, 100), ("1", hour, 7, 200)], f"{keys}, signal_strength int, internet_speed int"
    )
    calls = spark.createDataFrame(
        [("1", 3, 60, "Yes"), ("1", None, None, None)], "customer_id string, anger_rate int, call_duration_sec int, resolved string"
    )
    dims = {"dim_customer": spark.createDataFrame([(77, 1)], "customer_key long, customer_id int")}
    root = str(tmp_path)
    increments.add_events(root, 0, usage.limit(0), network, calls.where("anger_rate = 3"))
    increments.add_events(root, 1, usage, network.limit(0), calls.where("anger_rate IS NULL"))
    (row,) = increments.usage_means(spark, root, dims).collect()
    assert (row.customer_key, row.avg_data_usage_mb, row.avg_signal_strength) == (77, 50 / 3, 6.0)
    (care,) = increments.care_means(spark, root, dims).collect()
    assert (care.avg_anger_rate, care.avg_call_duration_sec, care.resolution_rate) == (3.0, 60.0, 0.5)


# Late rows


def timed(minutes):
    start = datetime(2024, 1, 1)
    return [(i, None if m is None else start + timedelta(minutes=m)) for i, m in minutes]


def late_run(spark, tmp_path, batches, sinks=None, **options):
    source = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(timed(rows), "i int, event_time timestamp").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("i int, event_time timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    taken, late, account = (str(tmp_path / n) for n in ("taken", "late", "account"))
    taken_sinks = {"files": parquet_sink(taken)} | (sinks or {})
    write = late_writer(taken_sinks, {"files": parquet_sink(late)}, account, **options)

    def run():
        start_batches(stream, write, str(tmp_path / "offsets"), every=None).awaitTermination()

    def ids(path):
        return sorted((r.batch_id, r.i) for r in spark.read.parquet(path).collect())

    return run, lambda: ids(taken), lambda: ids(late), account


BATCHES = [[(1, 100), (2, 30)], [(3, 89), (4, 90), (5, None), (6, 200)], [(7, 189), (8, 190), (9, 95)]]


def test_late_rows_are_kept_apart(spark, tmp_path):
    run, taken, late, account = late_run(spark, tmp_path, BATCHES)
    run()
    assert taken() == [(0, 1), (0, 2), (1, 4), (1, 5), (1, 6), (2, 8)] and late() == [(1, 3), (2, 7), (2, 9)]
    run()  # nothing new
    rows = sorted(late_account(spark, account).collect(), key=lambda r: r.batch_id)
    assert [(r.n_taken, r.n_late) for r in rows] == [(2, 0), (3, 1), (1, 2)]
    start = datetime(2024, 1, 1)
    assert [r.mark for r in rows] == [None, start + timedelta(minutes=90), start + timedelta(minutes=190)]


def test_a_retried_batch_is_judged_by_the_same_mark(spark, tmp_path):
    failed = set()

    def faulty(batch, batch_id):
        if batch_id == 1 and batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("down")

    run, taken, late, account = late_run(spark, tmp_path, BATCHES, {"faulty": faulty})
    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert taken() == [(0, 1), (0, 2), (1, 4), (1, 5), (1, 6), (2, 8)] and late() == [(1, 3), (2, 7), (2, 9)]
    assert late_account(spark, account).count() == 3


def test_late_by_windows_and_lag(spark, tmp_path):
    """Batch 2 is judged by batch 0, whose mark is minute 90: the hour up to minute 60 has ended by then, the next has not."""
    batches = [BATCHES[0], [(3, 10), (6, 200)], [(7, 59), (8, 60), (9, 95), (10, None)]]
    run, taken, late, _ = late_run(spark, tmp_path, batches, width="1 hour", lag=2)
    run()
    assert late() == [(2, 7)]
    assert taken() == [(0, 1), (0, 2), (1, 3), (1, 6), (2, 8), (2, 9), (2, 10)]


def test_account_of_nothing(spark, tmp_path):
    assert late_account(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(ValueError, match="judged by itself"):
        late_writer({}, {}, str(tmp_path), lag=0)


# Repeated messages


def test_each_message_once_over_batches_and_restart(spark, tmp_path):
    source, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    start = datetime(2024, 1, 1)

    def send(*rows):
        sent = [(k, x, t, start + timedelta(minutes=m)) for k, x, t, m in rows]
        spark.createDataFrame(sent, MESSAGE_FIELDS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(MESSAGE_FIELDS).option("maxFilesPerTrigger", 1).parquet(source)
        query = start_batches(unique_messages(stream, "1 hour"), raw_writer("m", {"files": parquet_sink(out)}), offsets, every=None)
        query.awaitTermination()
        return query

    send(("a", "1", "t", 0), ("a", "1", "t", 1), ("a", "2", "t", 2), ("a", "1", "u", 3))
    send((None, "1", "t", 4), (None, None, "t", 5), (None, "", "t", 5))
    send(("a", "1", "t", 20), ("b", "1", "t", 21), (None, None, "t", 22))
    run()
    send(("b", "1", "t", 40), ("a", "2", "t", 2), ("c", "1", "t", 200))
    send(("d", "1", "t", 300))
    send(("c", "1", "t", 201), ("e", "1", "t", 301))
    query = run()
    found = sorted((r.topic, r.key or "", r.value) for r in spark.read.parquet(out).collect() if r.value is not None)
    of_t = [("", ""), ("", "1"), ("a", "1"), ("a", "2"), ("b", "1"), ("c", "1"), ("d", "1"), ("e", "1")]
    assert found == [("t", *m) for m in of_t] + [("u", "a", "1")]
    assert spark.read.parquet(out).where("value IS NULL").count() == 1
    # Old messages leave the state.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


# Reports


def test_a_listener_misses_no_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(5):
        spark.range(10 * i, 10 * i + i + 1).coalesce(1).write.mode("append").parquet(source)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before, told = spark.conf.get(kept), []
    reports = BatchReports(lambda query, batch, metrics: told.append((query, batch, metrics["n_rows"])))
    spark.conf.set(kept, "1")
    spark.streams.addListener(reports)
    try:
        stream = watched(spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source))
        running = start_batches(stream, raw_writer("ids", {}), str(tmp_path / "offsets"), "five", every=None)
        running.awaitTermination()
        batches = reports.await_end(running)
    finally:
        spark.streams.removeListener(reports)
        spark.conf.set(kept, before)
    assert len(running.recentProgress) <= 1 and sorted(m["n_rows"] for m in batches.values()) == [1, 2, 3, 4, 5]
    assert sorted(told) == sorted(("five", b, m["n_rows"]) for b, m in batches.items())


# Distinct counts


def test_distinct_sketches_of_retried_batches(spark, tmp_path):
    root = str(tmp_path / "sketches")
    sink = distinct_sink(spark, root, ["day"], "key")
    with pytest.raises(ValueError, match="no batch"):
        kept_distinct(spark, root, ["day"])
    source, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")
    for low in (0, 3000, 6000):
        rows = spark.range(low, low + 5000).selectExpr("'d' || id % 2 AS day", "IF(id % 10 = 0, NULL, id) AS key")
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("day string, key long").option("maxFilesPerTrigger", 1).parquet(source)
    failed = set()

    def faulty(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("after the commit")

    for _ in range(2):
        try:
            start_batches(stream, raw_writer("d", {"sketches": faulty}), offsets, every=None).awaitTermination()
        except StreamingQueryException:
            continue
    rows = {r.day: r for r in kept_distinct(spark, root, ["day"]).collect()}
    assert failed == {1} and {d: r.n_rows for d, r in rows.items()} == {"d0": 7500, "d1": 7500}
    # Ids 0 to 10999; tens are null and even.
    assert abs(rows["d1"].n_distinct / 5500 - 1) < 0.03 and abs(rows["d0"].n_distinct / 4400 - 1) < 0.03


def test_distinct_sketches_merge_over_coarser_groups(spark):
    rows = spark.range(4000).selectExpr("id % 4 AS day", "id % 1000 AS key")
    fine = distinct_sketches(rows, ["day"], "key")
    (whole,) = merged_distinct(fine.withColumn("all", F.lit(1)), ["all"]).collect()
    assert whole.n_rows == 4000 and abs(whole.n_distinct - 1000) < 30
    assert merged_distinct(fine.limit(0), ["day"]).collect() == []


# Scores over batches


def test_scores_of_all_events_as_in_one_batch(spark):
    """Ties, nulls in every column, customers without calls, events without a customer."""
    measures = [f"{m} {'string' if m in ('issue_type', 'resolved') else 'int'}" for m in v.CALL_MEASURES]
    measures += [f"{m} int" for m in (*v.NETWORK_MEASURES, *v.USAGE_MEASURES)]
    fields = ", ".join(["topic string, customer_id string, event_time timestamp", *measures])
    start, none = datetime(2024, 1, 1), [None] * 4

    def row(topic, customer, minute, measures):
        at = None if minute is None else start + timedelta(minutes=minute)
        order = (v.CALLS_TOPIC, v.NETWORK_TOPIC, v.USAGE_TOPIC)
        return (topic, customer, at, *[x for t in order for x in (measures if t == topic else none)])

    c, n, u = v.CALLS_TOPIC, v.NETWORK_TOPIC, v.USAGE_TOPIC
    rows = [
        row(c, "a", 1, ["x", 9, 60, "No"]), row(c, "a", 1, ["x", 3, 60, "Yes"]), row(c, "a", 0, ["z", 10, 1, "No"]),
        row(n, "a", 5, [10, 3, 1, 0]), row(n, "a", 5, [10, 1, 9, 1]), row(n, "a", None, [99, 5, 1, 1]), row(u, "a", 2, [1, 1, 1, 5]),
        row(c, "b", None, ["x", None, None, None]), row(n, "b", 1, [None, None, None, None]), row(u, "b", 1, [1, 1, 1, None]),
        row(n, "c", 1, [1, 9, 1, 1]), row(c, None, 3, ["x", 9, 9, "No"]), row(n, None, 3, [1, 9, 9, 1]), row(u, None, 3, [1, 1, 1, 1]),
        row(c, "d", 4, ["x", 8, 9, None]),
    ]
    events = spark.createDataFrame(rows, fields)
    assert bag(score_latest(events)) == bag(score_events(events)) and score_latest(events).count() == 4
    assert score_latest(events.limit(0)).collect() == []


# Malformed lines


def test_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,x\nbad\n2,y,more\n,z\nq,r\n")
    read = read_csv(spark, str(tmp_path / "in.csv"), "a int, b string", corrupt="_corrupt")
    good, bad = split_once(read, str(tmp_path / "parsed"))
    assert bag(good) == [(1, "x"), (None, "z")] and bag(bad) == [("2,y,more",), ("bad",), ("q,r",)]
    for df, flag in ((good, "NOT malformed"), (bad, "malformed")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Scan csv" not in plan and "PartitionFilters: [isnotnull(malformed" in plan and flag.split()[-1] in plan
    assert [r.a for r in good.select("a").collect()].count(1) == 1  # a narrower query does not judge anew
    empty = read_csv(spark, str(tmp_path / "in.csv"), "a int, b string", corrupt="_corrupt").limit(0)
    assert [df.count() for df in split_once(empty, str(tmp_path / "none"))] == [0, 0]
