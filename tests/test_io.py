"""Files, topics and sinks."""

import json
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from churnkit.operators import coerce_numbers
from churnkit.plans import values as v
from churnkit.scratch import clear, materialize, new_path
from churnkit.sinks import batches
from churnkit.sinks import (
    SinkError,
    counts_sink,
    format_sink,
    full_refresh,
    jdbc_sink,
    parquet_sink,
    publish,
    write_messages,
    write_silver,
    write_to_all,
)
from churnkit.sources import (
    as_messages,
    file_topics,
    kafka_topics,
    parse_topic,
    parse_topics,
    read_csv,
    read_silver,
    read_topic,
    register_staging,
    require_inputs,
    split_malformed,
)

FIELDS = "id int, amount double, name string"


@pytest.fixture
def lines(tmp_path):
    def write(*rows, header="id,amount,name"):
        path = tmp_path / "in.csv"
        path.write_text("\n".join([header, *rows]) + "\n")
        return str(path)

    return write


def test_malformed_lines_are_split(spark, lines):
    path = lines("1,2.5,a", "2,3.5", "3,bad,b", "4,1.5,c,extra", "x,1,d", "5,,")
    good, bad = split_malformed(read_csv(spark, path, FIELDS, corrupt="_corrupt"))
    assert sorted(map(tuple, good.collect())) == [(1, 2.5, "a"), (5, None, None)]
    assert sorted(r.line for r in bad.collect()) == ["2,3.5", "3,bad,b", "4,1.5,c,extra", "x,1,d"]
    # The verdict does not depend on the columns a query reads.
    assert (good.count(), bad.count()) == (2, 4)
    assert sorted(r.id for r in good.select("id").collect()) == [1, 5]


def test_wrong_header_fails(spark, lines):
    path = lines("1,2.5,a", header="amount,id,name")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, FIELDS).collect()


def test_permissive_read_keeps_rows(spark, lines):
    rows = read_csv(spark, lines("1,2.5,a", "2,bad,b"), FIELDS).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 2.5, "a"), (2, None, "b")]


def test_inputs_are_checked_before_a_run(spark, lines, tmp_path):
    path = lines("1,2.5,a")
    assert require_inputs(spark, {"in": ("csv", path)}) == {"in": ["id", "amount", "name"]}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        require_inputs(spark, {"in": ("csv", path), "gone": ("parquet", str(tmp_path / "gone"))})


def test_silver_files_and_staging_views(spark, tmp_path):
    df = spark.createDataFrame([(1, " y "), (2, None)], "id int, t string")
    write_silver(df, str(tmp_path / "p"))
    write_silver(df, str(tmp_path / "c"), "csv")
    assert sorted(read_silver(spark, str(tmp_path / "p")).collect()) == sorted(df.collect())
    assert sorted(read_csv(spark, str(tmp_path / "c"), "id int, t string").collect()) == sorted(df.collect())
    assert register_staging({"silver": df}) == ["stg_silver"]
    assert spark.table("stg_silver").count() == 2


def test_field_lists_have_the_right_sizes(spark):
    counted = {name: len(getattr(v, name).split(",")) for name in ("CLIENT_FIELDS", "RECORD_FIELDS", "POST_FIELDS")}
    assert counted == {"CLIENT_FIELDS": 50, "RECORD_FIELDS": 51, "POST_FIELDS": 28}
    assert len(v.KEPT_COLUMNS) == 43 and len(v.SNAPSHOT_MEASURES) == 38


def messages(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, topic string, timestamp timestamp")


def test_broken_json_gives_nulls(spark):
    good = {"customer_id": "1", "anger_rate": 3, "event_time": "2024-01-01 10:00:00", "more": 1}
    wrong = {"customer_id": "2", "anger_rate": "high", "event_time": "soon"}
    rows = [(None, value, "t", None) for value in (json.dumps(good), json.dumps(wrong), "{oops")]
    out = parse_topic(messages(spark, rows), v.CALL_FIELDS).collect()
    assert (out[0].customer_id, out[0].anger_rate, str(out[0].event_time)) == ("1", 3, "2024-01-01 10:00:00")
    assert (out[1].customer_id, out[1].anger_rate, out[1].event_time) == ("2", None, None)
    assert set(out[2]) == {None}


def test_topics_share_one_schema_but_keep_their_own_columns(spark):
    call = {"customer_id": "1", "anger_rate": 3, "dropped_calls": 5}
    network = {"customer_id": "2", "anger_rate": 9, "dropped_calls": 4}
    rows = [
        (None, json.dumps(call), v.CALLS_TOPIC, None),
        (None, json.dumps(network), v.NETWORK_TOPIC, None),
        (None, json.dumps(call), "other", None),
    ]
    out = {r.topic: r for r in parse_topics(messages(spark, rows), v.TOPIC_FIELDS).collect()}
    assert set(out) == {v.CALLS_TOPIC, v.NETWORK_TOPIC}
    assert (out[v.CALLS_TOPIC].anger_rate, out[v.CALLS_TOPIC].dropped_calls) == (3, None)
    assert (out[v.NETWORK_TOPIC].anger_rate, out[v.NETWORK_TOPIC].dropped_calls) == (None, 4)
    with pytest.raises(ValueError, match="two types"):
        parse_topics(messages(spark, rows), {"a": "x int", "b": "x string"})


def test_posts_from_csv_text_to_messages(spark):
    """Text rows become typed, keyed messages and parse back."""
    names = [f.split()[0] for f in v.POST_FIELDS.split(",")]
    kinds = dict(f.split() for f in v.POST_FIELDS.split(","))
    text = spark.createDataFrame([tuple(f" {i} " if i % 2 else "junk" for i in range(28))], ", ".join(f"`{n}` string" for n in names))
    typed = coerce_numbers(
        text, [n for n in names if kinds[n] == "double"], [n for n in names if kinds[n] == "int"]
    )
    sent = as_messages(typed, v.POST_KEY, "posts")
    assert sent.first().key == "junk"
    back = parse_topic(sent, v.POST_FIELDS, time=None)
    assert back.first() == typed.first()
    assert back.first().sentiment_score == 0.0 and back.first().comments_count == 0


def test_broker_options(spark, monkeypatch):
    """No broker here: only what is asked of the reader is checked."""
    seen = []

    class Reader:
        def format(self, kind):
            assert kind == "kafka"
            return self

        def options(self, **options):
            seen.append(options)
            return self

        def load(self):
            return None

    class Session:
        read = readStream = Reader()

    reader = kafka_topics("host:1", "a", "b", fail_on_data_loss=False)
    reader(Session(), True)
    reader(Session(), False)
    assert seen[0]["subscribe"] == "a,b" and seen[0]["startingOffsets"] == "latest"
    assert seen[0]["maxOffsetsPerTrigger"] == "50000" and seen[0]["failOnDataLoss"] == "false"
    assert (seen[1]["startingOffsets"], seen[1]["endingOffsets"]) == ("earliest", "latest")


def test_bounded_topic_from_files(spark, tmp_path):
    path = str(tmp_path / "topic")
    rows = spark.createDataFrame([("1", 5), ("2", 6)], "customer_id string, voice_minutes int")
    sent = as_messages(rows, "customer_id", "usage_events").withColumn("timestamp", F.current_timestamp())
    sent.write.parquet(path)
    back = read_topic(spark, file_topics(path), "customer_id string, voice_minutes int", streaming=False, time=None)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_messages_to_any_format(spark, tmp_path):
    path = str(tmp_path / "out")
    write_messages(spark.range(3), "id", "t", fmt="json", path=path)
    assert sorted(r.key for r in spark.read.json(path).collect()) == ["0", "1", "2"]


def test_batch_folder_is_replaced_on_retry(spark, tmp_path):
    path = str(tmp_path / "batches")
    sink = parquet_sink(path)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "one query")
    try:
        sink(spark.range(3), 0)
        sink(spark.range(5), 1)
        sink(spark.range(3), 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 3), (1, 5)]
    # Outside of the query the same batch id is another run, and takes nothing away.
    sink(spark.range(2), 0)
    assert spark.read.parquet(path).count() == 10


def test_failed_batch_of_a_connector_is_cleared_before_the_retry(spark, tmp_path):
    """A data source without folders to replace: its first attempt fails after the rows are in."""
    path, cleared = str(tmp_path / "rows"), []

    def clear(run, batch_id):
        cleared.append((run, batch_id))
        if (tmp_path / "rows").exists():
            kept = spark.read.text(path).filter(~F.col("value").startswith(f"{run},{batch_id},")).collect()
            spark.createDataFrame(kept, "value string").coalesce(1).write.mode("overwrite").text(path)

    sink = format_sink("text", clear_batch=clear, path=path)
    stamped = batches.stamped
    attempts = []

    def lines(batch, run, batch_id):
        attempts.append(batch_id)
        return stamped(batch, run, batch_id).select(F.concat_ws(",", "run_id", "batch_id", "id").alias("value"))

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(batches, "stamped", lines)
        patch.setattr(batches, "run_of", lambda batch: "r")
        for _ in range(2):
            sink(spark.range(3), 4)
    assert attempts == [4, 4] and cleared == [("r", 4)] * 2
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["r,4,0", "r,4,1", "r,4,2"]
    with pytest.raises(ValueError, match="at_least_once"):
        format_sink("warehouse", table="t")


def test_counts_of_every_batch_stay(spark, tmp_path):
    path = str(tmp_path / "counts")
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "topic string")
    for batch_id in range(3):
        counts_sink(path)(rows, batch_id)
    found = spark.read.parquet(path).groupBy("topic").agg(F.sum("n_rows")).collect()
    assert sorted(map(tuple, found)) == [("a", 6), ("b", 3)]


def test_every_sink_gets_its_turn_and_failure_is_raised(spark, tmp_path):
    path = str(tmp_path / "batches")

    def broken(batch, batch_id):
        raise OSError("database is down")

    with pytest.raises(SinkError, match="database is down") as caught:
        write_to_all(spark.range(3), 4, {"db": broken, "files": parquet_sink(path)})
    assert list(caught.value.failures) == ["db"]
    assert spark.read.parquet(path).count() == 3


def test_database_sink_options(spark, monkeypatch):
    """No database is started: the call to the writer is recorded instead."""
    calls = []

    def record(self, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties, self._df.columns))

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    cleared = []
    sink = jdbc_sink("jdbc:x", "scores", {"user": "u"}, clear_batch=lambda run, batch: cleared.append((len(run), batch)))
    sink(spark.range(1), 7)
    assert cleared == [(36, 7)]
    assert calls == [
        ("jdbc:x", "scores", "append", {"user": "u", "batchsize": "1000", "numPartitions": "4"}, ["id", "run_id", "batch_id"])
    ]


def test_warehouse_append_and_full_refresh(spark, tmp_path):
    path = str(tmp_path / "wh")
    sink = format_sink("parquet", path=path)
    sink(spark.range(2), 0)
    sink(spark.range(2), 1)
    assert spark.read.parquet(path).count() == 4
    assert full_refresh(spark.range(4), "loaded") == 4
    assert full_refresh(spark.range(2), "loaded") == 2
    publish({"mart_x": spark.range(3), "dim_x": spark.range(1)})
    assert spark.catalog.tableExists("mart_x") and not spark.catalog.getTable("mart_x").isTemporary
    assert spark.catalog.getTable("dim_x").isTemporary


def test_scratch_folder_comes_from_the_session_and_is_cleared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = new_path(spark, "x")
    assert path.startswith(f"{root}/churnkit/x-")
    table = materialize(spark.range(3), path=path)
    assert table.count() == 3 and Path(path).exists()
    assert clear(spark) >= 1
    assert not Path(path).exists() and clear(spark) == 0
