"""The runnable jobs, end to end on files."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from checks import views
from checks.registry import rounded
from churnkit import jobs
from churnkit.plans import values as v
from churnkit.plans.scoring import score_events
from churnkit.session import size_shuffles, stored_bytes, tasks_for
from churnkit.sinks import write_silver
from churnkit.sources import as_messages, file_topics, read_topics
from churnkit.streaming import windows_now

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver_dir(spark, tmp_path_factory):
    work = tmp_path_factory.mktemp("silver")
    paths = [str(work / name) for name in ("client", "record")]
    for path, df in zip(paths, views.bronze(spark, SF_DIR)):
        write_silver(df, path, "csv")
    out = str(work / "out")
    assert jobs.run_silver(spark, *paths, out) == 148
    return out


def test_load(spark, silver_dir):
    assert jobs.run_load(spark, silver_dir, "stg_silver_telecom") == 148
    assert jobs.run_load(spark, silver_dir, "stg_silver_telecom") == 148


@pytest.fixture(scope="module")
def topics_dir(spark, tmp_path_factory):
    """All events as messages; each kind in two files, whose messages carry their event time."""
    topics = str(tmp_path_factory.mktemp("topics"))
    for topic, measures, df in zip(
        v.TOPIC_FIELDS, (v.CALL_MEASURES, v.NETWORK_MEASURES, v.USAGE_MEASURES), views.events(spark, SF_DIR)
    ):
        text = df.select("customer_id", *measures, F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))
        messages = as_messages(text, "customer_id", topic).withColumn("timestamp", F.get_json_object("value", "$.event_time").cast("timestamp"))
        messages.repartition(2, "value").write.mode("append").parquet(topics)
    return topics


def staged(spark, silver_dir, out):
    staging = {"silver": spark.read.parquet(silver_dir)}
    for name, folder in (("usage", v.USAGE_TOPIC), ("network", v.NETWORK_TOPIC), ("calls", v.CALLS_TOPIC), ("risk", jobs.SCORE_TABLE)):
        staging[name] = spark.read.parquet(f"{out}/{folder}")
    return staging


def test_topics_to_warehouse(spark, silver_dir, topics_dir, tmp_path):
    """Topics are scored by the streams; their files and the silver files become the warehouse."""
    out = str(tmp_path / "streams")
    jobs.run_scoring(spark, partial(file_topics, topics_dir), out, str(tmp_path / "offsets"), every=None)
    staging = staged(spark, silver_dir, out)
    counts = jobs.run_warehouse(spark, staging, str(tmp_path / "gold"))
    assert len(counts) == 13
    assert counts["mart_customer_overview"] == counts["fact_customer_snapshot"] == 148
    assert counts["fact_customer_care_call"] == staging["calls"].count()
    assert counts["dim_risk_level"] <= 3


def test_topics_to_warehouse_with_what_is_kept(spark, silver_dir, topics_dir, tmp_path):
    """Scores across batches, messages once, keys from load to load, means from increments: the same marts."""
    out, gold, sums, keys = (str(tmp_path / n) for n in ("streams", "gold", "sums", "keys"))
    reader_of = partial(file_topics, topics_dir, files_per_trigger=2)
    jobs.run_scoring(
        spark, reader_of, out, str(tmp_path / "offsets"), every=None, across_batches=True, unique_within="10000 days"
    )
    staging = staged(spark, silver_dir, out)
    assert staging["usage"].count() == file_topics(topics_dir, v.USAGE_TOPIC)(spark, False).select("key", "value").distinct().count()
    staging["risk"] = windows_now(staging["risk"], ["customer_id"])
    events = [staging[name].drop("run_id", "batch_id") for name in jobs.EVENTS]
    scores = score_events(read_topics(spark, file_topics(topics_dir), v.TOPIC_FIELDS, streaming=False))
    assert sorted(map(tuple, staging["risk"].collect())) == sorted(map(tuple, scores.collect()))
    half = F.hour("event_time") % 2 == 0
    for number, part in ((0, half), (1, ~half), (1, ~half)):
        jobs.run_increment(spark, *(e.where(part) for e in events), sums, number, fold=number == 0)
    some = staging | {"silver": staging["silver"].where("customer_id % 2 = 0")}
    jobs.run_warehouse(spark, some, f"{gold}0", keys, 1)
    first = {r.customer_id: r.customer_key for r in spark.read.parquet(f"{gold}0/dim_customer").collect()}
    jobs.run_warehouse(spark, staging, gold, keys, 2, sums)
    second = {r.customer_id: r.customer_key for r in spark.read.parquet(f"{gold}/dim_customer").collect()}
    assert first.items() <= second.items() and sorted(second.values()) == list(range(1, len(second) + 1)) and len(first) < len(second)
    jobs.run_warehouse(spark, staging, f"{gold}1")
    for mart in ("mart_customer_overview", "mart_network_service_quality"):
        rows = [rounded(spark.read.parquet(f"{g}/{mart}").drop("customer_key")).collect() for g in (gold, f"{gold}1")]
        assert sorted(map(tuple, rows[0]), key=repr) == sorted(map(tuple, rows[1]), key=repr)
    with pytest.raises(ValueError, match="both"):
        jobs.run_warehouse(spark, staging, gold, keys)


def test_replay(spark, tmp_path):
    names = [f.split()[0] for f in v.POST_FIELDS.split(",")]
    row = ["p1", *["1.5"] * 27]
    (tmp_path / "posts.csv").write_text(
        "\n".join([",".join(names), ",".join(row), "short,line", ",".join(["p2", *["junk"] * 27])]) + "\n"
    )
    out = str(tmp_path / "out")
    bad = jobs.run_replay(spark, str(tmp_path / "posts.csv"), "posts", fmt="parquet", path=out)
    assert [r.line for r in bad.collect()] == ["short,line"]
    sent = spark.read.parquet(out).select("key", F.from_json("value", v.POST_FIELDS).alias("d")).orderBy("key")
    first, second = sent.select("key", "d.*").collect()
    assert (first.key, first.sentiment_score, first.likes_count, first.language) == ("p1", 1.5, 0, "1.5")
    assert (second.key, second.sentiment_score, second.likes_count) == ("p2", 0.0, 0)


def test_command_lines():
    args = jobs.parser().parse_args(
        ["copy", "--servers", "h:1", "--topic", "t", "--format", "parquet", "--mode", "batch", "--option", "path=/x"]
    )
    assert (args.mode, jobs._pairs(args.option)) == ("batch", {"path": "/x"})
    args = jobs.parser().parse_args(["score", "--servers", "h:1", "--out", "o", "--checkpoint", "c", "--across-batches", "--unique-within", "1 hour"])
    assert (args.across_batches, args.unique_within) == (True, "1 hour")
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["copy", "--servers", "h:1", "--topic", "t", "--format", "x", "--mode", "both"])


def test_shuffles_follow_the_input(spark, tmp_path):
    for name, size in (("a", 5), ("b", 7)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_bytes(b"x" * size)
    paths = [str(tmp_path / name) for name in "ab"]
    assert stored_bytes(spark, *paths) == 12
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, *paths) == 200 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (tasks_for(1 << 40), tasks_for(100 << 40)) == (8192, 200_000)
