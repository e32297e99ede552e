from churnkit.sinks.batches import (
    STAMPS,
    SinkError,
    counts_sink,
    folder_sink,
    format_sink,
    jdbc_clear,
    jdbc_sink,
    parquet_sink,
    write_to_all,
)
from churnkit.sinks.ledger import Ledger, ledger_sink, numbered
from churnkit.sinks.tables import (
    full_refresh,
    publish,
    write_messages,
    write_silver,
)

__all__ = [
    "Ledger",
    "STAMPS",
    "SinkError",
    "counts_sink",
    "folder_sink",
    "format_sink",
    "full_refresh",
    "jdbc_clear",
    "jdbc_sink",
    "ledger_sink",
    "numbered",
    "parquet_sink",
    "publish",
    "write_messages",
    "write_silver",
    "write_to_all",
]
