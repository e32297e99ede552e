"""Keyed JSON topics, streaming or bounded.

A topic reader is a function ``(spark, streaming) -> DataFrame`` with the columns ``key``,
``value``, ``topic`` and ``timestamp``; one reads a message broker, one reads files with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TopicReader = Callable[[SparkSession, bool], DataFrame]

MESSAGE_FIELDS = "key string, value string, topic string, timestamp timestamp"
EVENT_TIME = "event_time"


def kafka_topics(
    servers: str,
    *topics: str,
    starting: str | None = None,
    rows_per_trigger: int | None = 50_000,
    fail_on_data_loss: bool = True,
    **options: str,
) -> TopicReader:
    """Broker topics: streams start at the latest offset, bounded reads run from earliest to latest."""

    def read(spark: SparkSession, streaming: bool) -> DataFrame:
        chosen = {
            "kafka.bootstrap.servers": servers,
            "subscribe": ",".join(topics),
            "startingOffsets": starting or ("latest" if streaming else "earliest"),
            "failOnDataLoss": str(fail_on_data_loss).lower(),
        }
        if not streaming:
            chosen["endingOffsets"] = "latest"
        elif rows_per_trigger:
            chosen["maxOffsetsPerTrigger"] = str(rows_per_trigger)
        source = spark.readStream if streaming else spark.read
        return source.format("kafka").options(**chosen, **options).load()

    return read


def file_topics(
    path: str, *topics: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> TopicReader:
    """Messages kept as files; ``topics`` restricts what is read."""

    def read(spark: SparkSession, streaming: bool) -> DataFrame:
        source = (spark.readStream if streaming else spark.read).format(fmt).schema(MESSAGE_FIELDS)
        if streaming and files_per_trigger:
            source = source.option("maxFilesPerTrigger", files_per_trigger)
        messages = source.load(path)
        return messages.filter(F.col("topic").isin(*topics)) if topics else messages

    return read


def _event_time(df: DataFrame, time: str | None, watermark: str | None) -> DataFrame:
    if time is None:
        return df
    df = df.withColumn(time, F.try_to_timestamp(time))
    return df.withWatermark(time, watermark) if watermark else df


def parse_topic(
    messages: DataFrame, fields: str, time: str | None = EVENT_TIME, watermark: str | None = None
) -> DataFrame:
    """JSON values of one topic as columns; broken text gives a row of nulls."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), fields).alias("d"))
    return _event_time(parsed.select("d.*"), time, watermark)


def parse_topics(
    messages: DataFrame,
    fields: Mapping[str, str],
    time: str | None = EVENT_TIME,
    watermark: str | None = None,
) -> DataFrame:
    """JSON values of several topics as one table with the columns of all and the topic.

    The source is read and parsed once with the union of the schemas; a column is then blanked
    where the row's topic does not declare it. Other topics are dropped.
    """
    types: dict[str, T.DataType] = {}
    owners: dict[str, list[str]] = {}
    for topic, ddl in fields.items():
        for f in T.StructType.fromDDL(ddl):
            if types.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{f.name} has two types among the topics")
            owners.setdefault(f.name, []).append(topic)
    union = T.StructType([T.StructField(name, kind) for name, kind in types.items()])
    topic = F.col("topic")
    parsed = messages.filter(topic.isin(*fields)).select(
        topic, F.from_json(F.col("value").cast("string"), union).alias("d")
    )

    def owned(name: str):
        value = F.col(f"d.{name}")
        if len(owners[name]) < len(fields):
            value = F.when(topic.isin(*owners[name]), value)
        return value.alias(name)

    return _event_time(parsed.select(*map(owned, types), topic), time, watermark)


def read_topic(
    spark: SparkSession, reader: TopicReader, fields: str, streaming: bool = True, **parse
) -> DataFrame:
    return parse_topic(reader(spark, streaming), fields, **parse)


def read_topics(
    spark: SparkSession, reader: TopicReader, fields: Mapping[str, str], streaming: bool = True, **parse
) -> DataFrame:
    return parse_topics(reader(spark, streaming), fields, **parse)


def as_messages(
    df: DataFrame, key: str, topic: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows as keyed JSON messages; a null field is left out of the JSON."""
    names = list(columns or df.columns)
    message = [
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*names)).alias("value"),
    ]
    if topic is not None:
        message.append(F.lit(topic).alias("topic"))
    return df.select(*message)
