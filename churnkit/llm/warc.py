"""WARC archives: whole-file gzip streams, rewritten with one gzip member per record and an offset index.

``write_archives`` puts the records of a task in one gzip stream, as crawlers' exports often come. Such a
file can only be read from its start. ``normalise_archives`` inflates each file once, without holding more than
one record, writes every record as its own gzip member and lists the members in a sidecar index.
``read_archives`` takes records from the index, each by itself.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm import shared_files
from churnkit.llm.frames import spread_join
from churnkit.scratch import materialize, new_path

_GZIP = 31  # zlib's window bits for gzip framing
_READ = 1 << 20
_RECORD_ID = "urn:x-page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of one record's header lines; more is taken as a broken file.
_MOST_HEADER = 1 << 20


def mark_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000
) -> DataFrame:
    """id, url, payload (binary) and refers_to: of equal payloads of at least ``least`` bytes, the row with the largest
    id is the response and the others refer to it.

    Null payloads are empty. Rows without an id refer to the response, or stay responses if no equal row has an
    id. Rows that repeat the largest id are all responses. Equality is that of SHA-256 digests.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), payload.alias("_payload")
    ).withColumn("_key", F.when(F.octet_length("_payload") >= least, F.sha2("_payload", 256)))
    # Summed up per task before the shuffle; only repeated payloads are looked up.
    repeated = (
        rows.where("_key is not null")
        .groupBy("_key")
        .agg(F.max("_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select("_key", "_first")
    )
    found = spread_join(rows, repeated, ["_key"], F.col("_id"), row_bytes=96)
    return found.select(
        F.col("_id").alias("page_id"),
        F.col("_url").alias("url"),
        F.col("_payload").alias("payload"),
        F.when(~F.col("_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("refers_to"),
    )


def _lines(first: str, fields: list[tuple[str, str]]) -> bytes:
    return "".join([first, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record with HTTP headers; a revisit keeps the headers, with the full length, and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = _lines(
        "HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    )
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_RECORD_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        # Control characters and spaces would break the line.
        ("WARC-Target-URI", quote(url or "urn:x-none", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[3:3] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_RECORD_ID}{refers_to}>")]
    return _lines("WARC/1.1", fields) + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a repeated name keeps the last."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Cut an inflated stream into records; a stream that ends inside one is an error."""
    held = bytearray()
    need = None  # length of the record at the front, once its header is known
    searched = 0
    for chunk in chunks:
        held += chunk
        while held:
            if need is None:
                end = held.find(b"\r\n\r\n", searched)
                if end < 0:
                    searched = max(0, len(held) - 3)
                    if len(held) > _MOST_HEADER:
                        raise ValueError("no end of a WARC header")
                    break
                if not held.startswith(b"WARC/"):
                    raise ValueError("not a WARC record")
                need = end + 4 + int(header_fields(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need, searched = None, 0
    if held:
        raise ValueError("the stream ends inside a record")


def inflate(source: pa.NativeFile) -> Iterator[bytes]:
    """Inflate a gzip file of one or many members, bounded piece by piece."""
    stream = zlib.decompressobj(_GZIP)
    while data := source.read(_READ):
        while data:
            out = stream.decompress(data, _READ)
            if out:
                yield out
            data = stream.unconsumed_tail
            if stream.eof:
                data = stream.unused_data
                stream = zlib.decompressobj(_GZIP)
    if rest := stream.flush():
        yield rest


def _files_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        rows, pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
    )


_FILES = "path string, n_records long, n_bytes long"


def write_archives(
    marked: DataFrame, folder: str | None = None, date: str = "2024-01-01T00:00:00Z", roll_bytes: int = 256 << 20
) -> DataFrame:
    """Write rows of ``mark_revisits`` as archives of one gzip stream each: path, n_records, n_bytes.

    A task starts a new file once one holds ``roll_bytes`` of records. An empty table gives no files.
    """
    folder = folder or new_path(marked.sparkSession, "warc")
    shared_files.make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path, out, pack, n, size = None, None, None, 0, 0

        def end() -> dict:
            out.write(pack.flush())
            out.close()
            return {"path": path, "n_records": n, "n_bytes": size}

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, refers = (batch.column(c)[i].as_py() for c in range(4))
                record = record_bytes(page, url, payload, refers, date)
                if out is None:
                    path = shared_files.own_name(folder, f"stream-{part:06d}", ".warc.gz")
                    out, pack, n, size = shared_files.writer(path), zlib.compressobj(6, zlib.DEFLATED, _GZIP), 0, 0
                out.write(pack.compress(record))
                n, size = n + 1, size + len(record)
                if size >= roll_bytes:
                    yield _files_batch([end()])
                    out = None
        if out is not None:
            yield _files_batch([end()])

    columns = ["page_id", "url", "payload", "refers_to"]
    return materialize(marked.select(*columns).mapInArrow(write, _FILES), "streams")


def normalise_archives(files: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite each file with a gzip member per record and a sidecar index: path, index, n_records, n_bytes.

    The index (``.index.jsonl`` beside the archive) has a line per record: offset, length, type, id, uri. A null path fails; an
    empty table of files gives an empty one.
    """
    folder = folder or new_path(files.sparkSession, "warc-members")
    shared_files.make_folder(folder)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in (row["path"] for batch in batches for row in batch.to_pylist()):
            path = shared_files.own_name(folder, f"members-{TaskContext.get().partitionId():06d}", ".warc.gz")
            offset = n = 0
            with (
                shared_files.reader(source) as packed,
                shared_files.writer(path) as out,
                shared_files.writer(path + ".index.jsonl") as index,
            ):
                for record in split_records(inflate(packed)):
                    head = header_fields(record[: record.index(b"\r\n\r\n")])
                    member = zlib.compress(record, 6, _GZIP)
                    line = {
                        "offset": offset,
                        "length": len(member),
                        "type": head.get("warc-type"),
                        "id": head.get("warc-record-id"),
                        "uri": head.get("warc-target-uri"),
                    }
                    out.write(member)
                    index.write(json.dumps(line).encode() + b"\n")
                    offset, n = offset + len(member), n + 1
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "index": path + ".index.jsonl", "n_records": n, "n_bytes": offset}],
                pa.schema([("path", pa.string()), ("index", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]),
            )

    dealt = files.select("path", "n_records", "n_bytes").repartition(files.sparkSession.sparkContext.defaultParallelism, "path")
    return materialize(
        dealt.mapInArrow(rewrite, "path string, index string, n_records long, n_bytes long"), "members"
    )


def read_archives(normalised: DataFrame, records_together: int = 2000) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to, payload.

    Records are taken by the offsets in the index, ``records_together`` at a time, dealt among all tasks. A response's digest is taken anew from
    its payload and must agree with its header. A revisit has the length and digest in its headers, and no payload. Pages without an
    id come back without one. No archives give no rows.
    """

    def page(record_id: str | None) -> int | None:
        number = (record_id or "").strip("<>").removeprefix(_RECORD_ID)
        return int(number) if number else None

    def parse(member: bytes) -> dict:
        record = zlib.decompress(member, _GZIP)
        head_end = record.index(b"\r\n\r\n")
        head = header_fields(record[:head_end])
        block = record[head_end + 4 : head_end + 4 + int(head["content-length"])]
        http_end = block.index(b"\r\n\r\n")
        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        row = {
            "page_id": page(head["warc-record-id"]),
            "url": head["warc-target-uri"],
            "payload_bytes": int(header_fields(block[:http_end])["content-length"]),
            "payload_digest": digest,
            "record_type": head["warc-type"],
            "refers_to": page(head.get("warc-refers-to")),
            "payload": None,
        }
        if row["record_type"] == "response":
            payload = block[http_end + 4 :]
            if len(payload) != row["payload_bytes"] or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"record {row['page_id']} does not agree with its digest")
            row["payload"] = payload
        return row

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of members that lie side by side."""
        for path in (row["path"] for batch in batches for row in batch.to_pylist()):
            with shared_files.reader(path + ".index.jsonl") as index:
                lines, low = [], 0
                for line in _text_lines(index):
                    lines.append(json.loads(line)["length"])
                    if len(lines) == records_together:
                        yield _run(path, low, lines)
                        low, lines = low + sum(lines), []
                if lines:
                    yield _run(path, low, lines)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                ("payload", pa.binary()),
            ]
        )
        for run in (row for batch in batches for row in batch.to_pylist()):
            with shared_files.reader(run["path"]) as archive:
                at, rows, size = run["offset"], [], 0
                for length in run["lengths"]:
                    rows.append(parse(bytes(archive.read_at(length, at))))
                    at, size = at + length, size + rows[-1]["payload_bytes"]
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    width = normalised.sparkSession.sparkContext.defaultParallelism
    found = normalised.select("path").mapInArrow(runs, "path string, offset long, lengths array<long>")
    return found.repartition(4 * width, "path", "offset").mapInArrow(
        take,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def _text_lines(source: pa.NativeFile) -> Iterator[bytes]:
    held = b""
    while data := source.read(_READ):
        *whole, held = (held + data).split(b"\n")
        yield from whole
    if held:
        yield held


def _run(path: str, offset: int, lengths: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([offset], pa.int64()), pa.array([lengths], pa.list_(pa.int64()))],
        ["path", "offset", "lengths"],
    )
