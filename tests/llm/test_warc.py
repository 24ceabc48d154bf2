import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rosterlake.llm import warc
from rosterlake.llm.tables import read_table
from rosterlake.session import new_path

from .conftest import FOLDER


def brute(rows, least=0):
    by_payload = defaultdict(list)
    for row in rows:
        by_payload[(row.html or "").encode()].append(row.page_id)
    out = []
    for payload, keys in by_payload.items():
        top = max((k for k in keys if k is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for key in keys:
            same = len(payload) >= least and top is not None and key != top
            out.append((key, len(payload), digest, "revisit" if same else "response", top if same else None))
    return sorted(out, key=str)


def found(pages, least=0, chunk=warc.CHUNK):
    rows = warc.archive_round_trip(pages, least=least, chunk=chunk).drop("url").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("chunk,least", [(1 << 20, 0), (1000, 0), (1000, 50)])
def test_round_trip(spark, monkeypatch, chunk, least):
    monkeypatch.setattr(warc, "BATCH", 3000)
    rows = [
        (1, "http://a/", "x" * 10), (2, None, None), (3, "h ü\r\nX: y", "é" * 70_000), (4, "", "WARC/1.1\r\n\r\nWARC-Type: a\r\n\r\n"),
        (5, "z", "é" * 70_000), (6, "z", ""), (6, "z", ""), (None, "n", "x" * 10), (None, "n", "alone"), (7, "q" * 40_000, "\r\n" * 999),
    ]
    pages = spark.createDataFrame([(*r, 0, "s") for r in rows], "page_id bigint, url string, html string, record int, sha string")
    assert found(pages, least, chunk) == brute(pages.collect(), least)
    urls = {r.page_id: r.url for r in warc.archive_round_trip(pages).collect()}
    assert urls[3] == "h ü\r\nX: y" and urls[2] == "" and len(urls[7]) == 40_000


def test_pages(spark):
    pages = read_table(spark, FOLDER, "pages")
    assert found(pages) == brute(pages.collect())
    assert found(pages, chunk=700) == brute(pages.collect())
    assert found(pages.limit(0)) == []


def test_an_archive_is_a_byte_stream(spark):
    """The rows in order, joined and fed in pieces of any size, are records one after another."""
    pages = spark.createDataFrame([(i, f"u{i}", "payload " * i * 10) for i in range(30)], "page_id bigint, url string, html string")
    path = warc.write_archives(pages.coalesce(1), chunk=100)
    rows = spark.read.parquet(path).orderBy("archive", "record", "chunk").collect()
    assert max(r.chunks for r in rows) > 10 and max(len(r.data) for r in rows) < 100 + 1000
    for archive in {r.archive for r in rows}:
        stream = b"".join(r.data for r in rows if r.archive == archive)
        assert stream.startswith(b"WARC/1.1\r\n") and stream.endswith(b"\r\n\r\n")
        whole = list(warc.RecordReader().feed(stream))
        reader, parts = warc.RecordReader(), []
        for at in range(0, len(stream), 7):
            parts += reader.feed(stream[at : at + 7])
        assert [f["WARC-Type"] for f in parts] == [f["WARC-Type"] for f in whole]
        assert [f["payload_digest"] for f in parts] == [f["payload_digest"] for f in whole]


def test_damaged_chunks_are_refused(spark):
    """A chunk whose bytes or checksum were changed, a chunk that is missing, are noticed."""
    pages = spark.createDataFrame([(1, "u", "payload " * 100)], "page_id bigint, url string, html string")
    chunks = spark.read.parquet(warc.write_archives(pages, chunk=90)).cache()
    assert chunks.count() == 10
    damaged = {
        "differs from its checksum": chunks.withColumn("data", F.when(F.col("chunk") == 3, F.expr("overlay(data PLACING X'20' FROM 40)")).otherwise(F.col("data"))),
        "is not whole": chunks.filter("chunk < 8"),
    }
    for message, rows in damaged.items():
        path = new_path(spark, "damaged")
        rows.write.parquet(path)
        with pytest.raises(Exception, match=message):
            warc.read_archives(spark, path).collect()


def test_damaged_records_are_refused():
    (data, _), = warc.record_chunks("1", "u", memoryview(b"payload"), None)
    with pytest.raises(ValueError, match="differs"):
        list(warc.RecordReader().feed(data.replace(b"payload\r", b"Payload\r")))
    with pytest.raises(ValueError, match="not a WARC record"):
        list(warc.RecordReader().feed(b"HTTP/1.1 200 OK\r\n\r\n"))
