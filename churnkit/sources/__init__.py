from churnkit.sources.files import read_csv, read_silver, register_staging, require_inputs, split_malformed, split_once
from churnkit.sources.topics import (
    as_messages,
    file_topics,
    kafka_topics,
    parse_topic,
    parse_topics,
    read_topic,
    read_topics,
)

__all__ = [
    "as_messages",
    "file_topics",
    "kafka_topics",
    "parse_topic",
    "parse_topics",
    "read_csv",
    "read_silver",
    "read_topic",
    "read_topics",
    "register_staging",
    "require_inputs",
    "split_malformed",
    "split_once",
]
