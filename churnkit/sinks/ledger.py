"""Batches that count only once they are committed, for any format that can write to a folder.

The rows of an entry (a batch, a load, an increment) go to a fresh folder. When all are there, one empty file whose name holds
the entry and the folder is created; that is one step on any file system. Readers take what the names
say, so half-written folders are never seen, and an entry that is written again replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnkit.sinks.batches import Sink, run_of, stamped

_SEPARATOR = "~"


class Commit(NamedTuple):
    """An entry, how often it was written before, and the folder with its rows."""

    entry: str
    attempt: int
    folder: str


class Ledger:
    """Committed entries below ``root``. Names of entries sort as text; they hold no ``~`` or ``/``.

    One writer an entry at a time; different entries may be written at once.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", **options: str):
        self.spark, self.root, self.fmt, self.options = spark, root.rstrip("/"), fmt, options

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> dict[str, Commit]:
        """The last commit of every entry."""
        path, files = self._files("commits")
        last: dict[str, Commit] = {}
        if not files.exists(path):
            return last
        for status in files.listStatus(path):
            entry, attempt, folder = status.getPath().getName().split(_SEPARATOR)
            if entry not in last or last[entry].attempt < int(attempt):
                last[entry] = Commit(entry, int(attempt), folder)
        return last

    def write_rows(self, rows: DataFrame) -> str:
        """The first half of a commit: rows in a folder that no reader looks at yet."""
        folder = uuid.uuid4().hex
        rows.write.format(self.fmt).options(**self.options).mode("append").save(f"{self.root}/data/{folder}")
        return folder

    def commit(self, rows: DataFrame, entry: str) -> None:
        """Write the rows of an entry, then make them count in place of what it held."""
        if _SEPARATOR in entry or "/" in entry:
            raise ValueError(f"{entry!r} is no name for an entry")
        folder = self.write_rows(rows)
        before = self.commits().get(entry)
        attempt = before.attempt + 1 if before else 0
        path, files = self._files(f"commits/{entry}{_SEPARATOR}{attempt}{_SEPARATOR}{folder}")
        files.create(path, False).close()

    def read(self, entries: Iterable[str] | None = None, schema: T.StructType | str | None = None) -> DataFrame | None:
        """Rows of the named entries (default: all), or None if none of them was committed."""
        known = self.commits()
        chosen = known if entries is None else [e for e in dict.fromkeys(entries) if e in known]
        folders = [f"{self.root}/data/{known[e].folder}" for e in chosen]
        if not folders:
            return None
        reader = self.spark.read.format(self.fmt).options(**self.options)
        return (reader.schema(schema) if schema is not None else reader).load(folders)

    def clear_replaced(self) -> int:
        """Delete folders that no commit names any more, and the commits that named them; for when nobody writes or reads them."""
        last = {c.folder for c in self.commits().values()}
        gone = 0
        for name in ("commits", "data"):
            path, files = self._files(name)
            for status in files.listStatus(path) if files.exists(path) else ():
                if status.getPath().getName().split(_SEPARATOR)[-1] not in last:
                    files.delete(status.getPath(), True)
                    gone += name == "data"
        return gone


def numbered(entry: int) -> str:
    """Name of a numbered entry; names sort as the numbers do."""
    return f"{entry:012d}"


def ledger_sink(spark: SparkSession, root: str, fmt: str = "parquet", **options: str) -> Sink:
    """Micro-batches through a ledger: a failed or retried batch is there once or not at all, in any file format."""
    ledger = Ledger(spark, root, fmt, **options)

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        ledger.commit(stamped(batch, run, batch_id), f"{run}-{numbered(batch_id)}")

    return write
