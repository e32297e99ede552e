import hashlib
import json
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnkit.llm import frames, shared_files, warc

SCHEMA = "page_id long, url string, html string, payload string, refers_to int, path string"


def pages(spark):
    long, other = "<p>é</p>" * 300, "y" * 1000
    rows = [
        (1, "http://a/", long), (2, "http://b/ x\r\n", long), (9, None, long), (3, "u", None), (4, "u", ""), (5, "u", "short"),
        (6, "u", "short"), (7, "ü", other), (8, "u", other[:-1]), (10, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
        (11, "u", "z" * 400_000), (12, "u", "z" * 400_000), (12, "u", "z" * 400_000), (None, "u", other), (None, None, "w" * 2000),
    ]
    return spark.createDataFrame([(*r, "p", 1, "q") for r in rows], SCHEMA)


def expected(rows):
    first = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 1000 and r.page_id is not None:
            first[body] = max(first.get(body, r.page_id), r.page_id)
    out = Counter()
    for r in rows:
        body = (r.html or "").encode()
        to = first.get(body, r.page_id)
        to = None if to == r.page_id else to
        kind = "response" if to is None else "revisit"
        out[r.page_id, len(body), hashlib.sha1(body).hexdigest(), kind, to, None if to else body] += 1
    return out


@pytest.mark.parametrize("limit", [frames.BROADCAST_BYTES, -1])
def test_round_trip(spark, monkeypatch, limit):
    monkeypatch.setattr(frames, "BROADCAST_BYTES", limit)
    df = pages(spark)
    files = warc.write_archives(warc.mark_revisits(df).repartition(3), roll_bytes=100_000)
    normal = warc.normalise_archives(files)
    rows = warc.read_archives(normal, records_together=2).collect()
    found = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in rows
    )
    assert found == expected(df.collect())
    # Each index line is one gzip member, and the members are the whole file.
    for r in normal.collect():
        with shared_files.reader(r.path) as archive, shared_files.reader(r["index"]) as index:
            data, at = bytes(archive.read()), 0
            for line in map(json.loads, bytes(index.read()).splitlines()):
                assert line["offset"] == at
                stream = zlib.decompressobj(31)
                assert stream.decompress(data[at : at + line["length"]]).startswith(b"WARC/1.1\r\n") and stream.eof
                at += line["length"]
            assert at == len(data)


def test_streams_are_one_member(spark):
    files = warc.write_archives(warc.mark_revisits(pages(spark)).coalesce(1)).collect()
    with shared_files.reader(files[0].path) as source:
        data = bytes(source.read())
    stream = zlib.decompressobj(31)
    assert len(files) == 1 and stream.decompress(data).count(b"WARC-Type") == 15 and stream.eof and not stream.unused_data


def test_many_members_and_small_reads(monkeypatch):
    records = [warc.record_bytes(i, "u", bytes([i]) * (i * 37), None, "d") for i in range(60)]
    data = b"".join(zlib.compress(r, 6, 31) for r in records)
    monkeypatch.setattr(warc, "_READ", 7)
    assert list(warc.split_records(warc.inflate(pa.BufferReader(data)))) == records


def test_broken_streams():
    record = warc.record_bytes(1, "u", b"abc", None, "d")
    for bad in (record[:-1], b"junk" + record, record + b"WARC/1.1\r\n"):
        with pytest.raises(ValueError):
            list(warc.split_records(iter([bad])))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.read_archives(warc.normalise_archives(warc.write_archives(warc.mark_revisits(none)))).collect() == []
    assert warc.mark_revisits(none.withColumn("html", F.lit(None).cast("string"))).collect() == []
