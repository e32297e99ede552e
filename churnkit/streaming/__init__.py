from churnkit.streaming.late import late_account, late_writer
from churnkit.streaming.queries import (
    BatchReports,
    await_any,
    batch_metrics,
    copy_topic,
    raw_writer,
    score_writer,
    start_batches,
    start_live_scores,
    start_scoring,
    start_windows,
    unique_messages,
    watched,
    windowed,
    windows_now,
)

__all__ = [
    "BatchReports",
    "await_any",
    "batch_metrics",
    "copy_topic",
    "late_account",
    "late_writer",
    "raw_writer",
    "score_writer",
    "start_batches",
    "start_live_scores",
    "start_scoring",
    "start_windows",
    "unique_messages",
    "watched",
    "windowed",
    "windows_now",
]
