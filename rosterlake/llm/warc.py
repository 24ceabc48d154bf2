"""Web archives as tables of chunks.

An archive is a WARC byte stream kept as rows: a record's bytes are cut into chunks, and each
row has the record, the chunk's number, how many chunks the record has, and the running CRC of
the payload up to there. Joined in order the rows of an archive are a valid WARC 1.1 file.
Payloads are hashed and written chunk by chunk, and read the same way: a reader holds one chunk
and a hash state, whatever the size of the record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import new_path, small_side

CHUNK = 64 << 10  # bytes of a payload in a row, if not said otherwise
BATCH = 4 << 20  # bytes of chunks that are handed over at once
RECORD_FIELDS = "archive int, record bigint, chunk int, chunks int, data binary, payload_crc32 bigint"
# Fixed values of the WARC format and of the messages in it.
VERSION = b"WARC/1.1\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, key)}>"


def _header(fields: dict[str, str], length: int) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return VERSION + lines.encode() + f"Content-Length: {length}\r\n\r\n".encode()


def record_chunks(
    key: str | None, url: str, payload: memoryview, refers_to: str | None, chunk: int = CHUNK
) -> Iterator[tuple[bytes, int]]:
    """The bytes of one record, with ``chunk`` bytes of the payload at a time, each with the
    payload's CRC up to its end. The payload is hashed and copied in such pieces, never whole."""
    sha1 = hashlib.sha1()
    for at in range(0, len(payload), chunk):
        sha1.update(payload[at : at + chunk])
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _id(key or ""),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(sha1.digest())}",
        "Content-Type": "application/http; msgtype=response",
        "X-Payload-Length": str(len(payload)),
    }
    if key is not None:
        fields["X-Key"] = quote(key, safe="")
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _id(refers_to), "X-Refers-To-Key": quote(refers_to, safe="")}
        payload = payload[:0]
    begin = _header(fields, len(HTTP) + len(payload)) + HTTP
    running = 0
    for at in range(0, max(len(payload), 1), chunk):
        part = payload[at : at + chunk]
        running = zlib.crc32(part, running)
        last = at + chunk >= len(payload)
        yield b"".join([begin if at == 0 else b"", part, b"\r\n\r\n" if last else b""]), running


class RecordReader:
    """Reads a WARC byte stream that is fed in pieces; keeps no payload."""

    def __init__(self) -> None:
        self.kept = b""
        self.fields: dict[str, str] | None = None
        self.crc = 0  # of the last record's payload so far

    def feed(self, data: bytes) -> Iterator[dict[str, str]]:
        """The fields of each record that ends in ``data``, with the payload's figures.

        ``payload_bytes`` and ``payload_digest`` are measured for responses and taken from the
        header for revisits. A record that differs from its own header is refused.
        """
        view = memoryview(self.kept + data if self.kept else data)
        self.kept = b""
        while len(view):
            if self.fields is None:
                end = bytes(view[: 1 << 14]).find(b"\r\n\r\n")
                if end < 0 and len(view) > 1 << 14:  # a header of unusual length
                    end = bytes(view).find(b"\r\n\r\n")
                if end < 0:
                    break
                lines = bytes(view[:end]).decode().split("\r\n")
                if lines[0].encode() + b"\r\n" != VERSION:
                    raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
                self.fields = dict(line.split(": ", 1) for line in lines[1:])
                self.left, self.http = int(self.fields["Content-Length"]), b""
                self.sha1, self.size, self.crc = hashlib.sha1(), 0, 0
                self.body = self.fields["WARC-Type"] == "warcinfo"
                view = view[end + 4 :]
                continue
            part, view = view[: self.left], view[self.left :]
            self.left -= len(part)
            if not self.body:  # the HTTP header comes before the payload
                self.http += bytes(part)
                end = self.http.find(b"\r\n\r\n")
                if end >= 0:
                    part, self.body = memoryview(self.http)[end + 4 :], True
            if self.body:
                self.sha1.update(part)
                self.crc = zlib.crc32(part, self.crc)
                self.size += len(part)
            if self.left:
                continue
            if len(view) < 4:
                break
            view = view[4:]
            yield self._ended()
        self.kept = bytes(view)

    def _ended(self) -> dict[str, str]:
        fields, self.fields = self.fields, None
        if fields["WARC-Type"] == "revisit":
            size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        else:
            size, digest = self.size, base32_sha1(self.sha1.digest())
            stated = fields.get("WARC-Payload-Digest", f"sha1:{digest}")
            if stated != f"sha1:{digest}":
                raise ValueError(f"payload of {fields.get('WARC-Record-ID')} differs from its digest")
        return fields | {"payload_bytes": size, "payload_digest": digest}


def write_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, chunk: int = CHUNK
) -> str:
    """Write one record per row to a new chunk table in shared storage and return its path.

    A row of the table has at most ``chunk`` bytes of a payload.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest key is a
    response, the others are revisits of it without a payload; rows that repeat that key are
    responses too. Smaller payloads are responses. A NULL payload is empty, a NULL key is
    smaller than any other, a NULL url is empty. Every task writes archives of its own, each
    beginning with an information record. An empty table gives no archive.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), body.alias("body"))
    rows = rows.withColumns({"sha": F.sha1("body"), "size": F.octet_length("body")})
    # copies are counted before anything is moved; if few payloads occur again, none is moved
    copies = rows.filter(F.col("size") >= least).groupBy("sha", "size").agg(F.count("*").alias("n"), F.max("key").alias("top"))
    copies = copies.filter((F.col("n") > 1) & F.col("top").isNotNull()).drop("n")
    joined = rows.join(small_side(copies), ["sha", "size"], "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "body",
        F.when(~F.col("key").eqNullSafe(F.col("top")), F.col("top").cast("string")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, record, size = TaskContext.get().partitionId(), 0, 0
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["archive", "record", "chunk", "chunks", "data", "payload_crc32"])

        for batch in batches:
            keys, urls, targets = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i in range(batch.num_rows):
                if record == 0:
                    about = b"format: WARC File Format 1.1\r\n"
                    fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": _id(f"archive {part}"), "WARC-Date": "1970-01-01T00:00:00Z"}
                    head = _header(fields | {"Content-Type": "application/warc-fields"}, len(about))
                    out.append((part, 0, 0, 1, head + about + b"\r\n\r\n", zlib.crc32(about)))
                    record = 1
                value = batch.column(2)[i].as_buffer()
                view = memoryview(value) if value is not None else memoryview(b"")
                count = 1 if targets[i] is not None else max(1, -(-len(view) // chunk))
                for number, (data, running) in enumerate(record_chunks(keys[i], urls[i], view, targets[i], chunk)):
                    out.append((part, record, number, count, data, running))
                    size += len(data)
                    if size >= BATCH:
                        size = 0
                        yield flush()
                record += 1
        if out:
            yield flush()

    path = new_path(spark, "archives")
    joined.mapInArrow(run, RECORD_FIELDS).write.option("compression", "zstd").parquet(path)
    return path


def read_archives(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    """key, url, payload_bytes, payload_digest, record_type, refers_to of every record with a key
    or without, information records aside.

    Records of one chunk are read where they lie. Those of several are brought together by
    record and read in the order of their chunks, one chunk at a time. Every chunk is held
    against its checksum, every record against its digest and length.
    """
    names = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now = RecordReader(), None
        for batch in batches:
            found = []
            places = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            crcs = batch.column(3).to_pylist()
            for i, place in enumerate(places):
                if place != now:
                    if reader.kept or reader.fields is not None:
                        raise ValueError(f"record {now} is not whole")
                    now = place
                ended = list(reader.feed(batch.column(2)[i].as_py()))
                if reader.crc != crcs[i]:
                    raise ValueError(f"a chunk of record {place} differs from its checksum")
                for fields in ended:
                    if fields["WARC-Type"] != "warcinfo":
                        key, target = (fields.get(f) for f in ("X-Key", "X-Refers-To-Key"))
                        found.append(
                            (
                                None if key is None else unquote(key),
                                unquote(fields["WARC-Target-URI"]),
                                fields["payload_bytes"],
                                fields["payload_digest"],
                                fields["WARC-Type"],
                                None if target is None else unquote(target),
                            )
                        )
            if found:
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if reader.kept or reader.fields is not None:
            raise ValueError(f"record {now} is not whole")

    schema = "key string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
    chunks = spark.read.schema(RECORD_FIELDS).parquet(path)
    columns = ["archive", "record", "data", "payload_crc32"]
    short = chunks.filter("chunks = 1").select(*columns)
    long = (
        chunks.filter("chunks > 1")
        .repartition("archive", "record")
        .sortWithinPartitions("archive", "record", "chunk")
        .select(*columns)
    )
    found = short.mapInArrow(run, schema).unionByName(long.mapInArrow(run, schema))
    return found.withColumn("key", F.col("key").cast(key_type)).withColumn("refers_to", F.col("refers_to").cast(key_type))


def archive_round_trip(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, chunk: int = CHUNK
) -> DataFrame:
    """Write the rows to archives (see ``write_archives``) and read them back, one row per record.

    key, url, payload_bytes, payload_digest (bare upper-case base32 SHA-1 of the full payload),
    record_type, refers_to (the response's key for revisits). Other columns are not archived.
    """
    kind = pages.schema[key].dataType.simpleString()
    return read_archives(pages.sparkSession, write_archives(pages, key, url, payload, least, chunk), kind).withColumnRenamed("key", key)
