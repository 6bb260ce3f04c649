"""Content-addressed WARC archive.

``write_archive`` turns each page into a WARC/1.1 record and stores it in two tables:
``payloads`` holds every distinct payload once, keyed by its SHA-256, and ``records`` holds
one row per record with its exact head bytes (WARC header, blank line, HTTP header) and that
key. ``read_archive`` rebuilds whole records by joining the two, checks every payload
against the digests, and parses the records again.

Payloads are equal if SHA-256, SHA-1 and length all agree; the SHA-256 is verified
against the stored bytes on every read and a mismatch raises. Of records with equal payloads of
at least ``min_revisit`` bytes, those with the smallest page id are responses and the others
revisit that page.

Defined results: null html is an empty payload; a null page id counts as larger than any other and
gets a record id of its own digest; rows that repeat the smallest page id of a payload are all
responses; a null url is written as an empty target. Extra columns are ignored.

Scale: only digests are shuffled to find the first page of a payload; payload bytes are
deduplicated in each map task before the shuffle, so a payload shared by a third of all
rows moves once per task. The rebuild is an equi-join that adaptive execution splits on
a hot digest.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.session import fresh_dir

MIN_REVISIT = 0
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    """Bare upper-case base32 SHA-1, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _bytes(x) -> bytes:
    return bytes(x.as_buffer()) if x.is_valid else b""


def _digest(batches):
    """(page_id, url, sha256, sha1, size) of each page; the payload itself stays behind."""
    for batch in batches:
        payloads = [_bytes(x) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
                pa.array([sha1_base32(p) for p in payloads], pa.string()),
                pa.array([len(p) for p in payloads], pa.int64()),
            ],
            ["page_id", "url", "sha256", "sha1", "size"],
        )


def _record_id(page: int | None, sha1: str) -> bytes:
    return b"<urn:page:%d>" % page if page is not None else b"<urn:sha1:%s>" % sha1.encode()


def record_head(page: int | None, url: bytes, sha1: str, size: int, first: int | None) -> bytes:
    """WARC and HTTP headers of a response (``first`` is null) or of a revisit of page ``first``."""
    url = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m.group()[0], url)
    http = _HTTP % size
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if first is None else b"revisit"),
        b"WARC-Record-ID: " + _record_id(page, sha1),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Target-URI: " + url,
        b"WARC-Payload-Digest: sha1:" + sha1.encode(),
        b"Content-Type: application/http; msgtype=response",
    ]
    if first is not None:
        lines += [b"WARC-Refers-To: " + _record_id(first, sha1), b"WARC-Profile: " + _PROFILE]
    lines.append(b"Content-Length: %d" % (len(http) + (size if first is None else 0)))
    return b"\r\n".join(lines) + b"\r\n\r\n" + http


def _heads(batches):
    for batch in batches:
        get = {c: batch.column(c).to_pylist() for c in ("page_id", "sha1", "size", "first")}
        urls = [_bytes(x) for x in batch.column("url")]
        heads = [record_head(*row) for row in zip(get["page_id"], urls, get["sha1"], get["size"], get["first"])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("sha256"), pa.array(heads, pa.binary())], ["page_id", "sha256", "head"]
        )


def write_archive(pages: DataFrame, path: str | None = None, min_revisit: int = MIN_REVISIT) -> str:
    """Write ``pages`` (page_id, url, html) as an archive under ``path``; returns the path."""
    path = path or fresh_dir(pages.sparkSession, "warc")
    plain = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("binary").alias("url"), F.col("html").cast("binary").alias("html")
    )
    rows = plain.mapInArrow(_digest, "page_id long, url binary, sha256 binary, sha1 string, size long")
    key = ["sha256", "sha1", "size"]
    firsts = rows.groupBy(*key).agg(F.min("page_id").alias("smallest"))
    revisits = F.expr(f"size >= {min_revisit} AND smallest IS NOT NULL AND NOT (page_id <=> smallest)")
    records = rows.join(firsts, key).withColumn("first", F.when(revisits, F.col("smallest")))
    records.mapInArrow(_heads, "page_id long, sha256 binary, head binary").write.option("compression", "zstd").parquet(f"{path}/records")
    stored = plain.select(F.coalesce("html", F.lit(b"")).alias("payload"))
    stored = stored.withColumn("sha256", F.unhex(F.sha2("payload", 256)))
    stored.groupBy("sha256").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")
    return path


_NAME = re.compile(rb"^([A-Za-z-]+): (.*)$")


def parse_record(record: bytes) -> tuple[dict[str, bytes], bytes]:
    """Headers and payload of one whole record; raises if it is malformed."""
    head, _, block = record.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    headers = {m[1].decode(): m[2] for m in map(_NAME.match, lines)}
    http, _, payload = block[:-4].partition(b"\r\n\r\n")
    if first != b"WARC/1.1" or block[-4:] != b"\r\n\r\n" or int(headers["Content-Length"]) != len(block) - 4:
        raise ValueError(f"malformed WARC record {headers.get('WARC-Record-ID')}")
    return headers, payload


def _page_of(record_id: bytes | None) -> int | None:
    return int(record_id[10:-1]) if record_id and record_id.startswith(b"<urn:page:") else None


def _parse(batches):
    """Rebuild each record, parse it and verify the full payload against both digests."""
    for batch in batches:
        out = [[] for _ in range(6)]
        for head, payload, sha256 in zip(*(batch.column(c) for c in ("head", "payload", "sha256"))):
            head, payload = _bytes(head), _bytes(payload)
            stub = b"WARC-Type: revisit" in head[:40]
            headers, body = parse_record(head + (b"" if stub else payload) + b"\r\n\r\n")
            sha1 = sha1_base32(payload)
            if b"sha1:" + sha1.encode() != headers["WARC-Payload-Digest"] or hashlib.sha256(payload).digest() != _bytes(sha256):
                raise ValueError(f"payload of {headers['WARC-Record-ID']} fails its digest")
            if not stub and body != payload:
                raise ValueError(f"record {headers['WARC-Record-ID']} was not rebuilt")
            row = (
                _page_of(headers["WARC-Record-ID"]),
                len(payload),
                sha1,
                headers["WARC-Type"].decode(),
                _page_of(headers.get("WARC-Refers-To")),
                headers["WARC-Target-URI"].decode("utf-8", "replace"),
            )
            for values, x in zip(out, row):
                values.append(x)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, sha256, head, payload) of every record: heads joined with the payloads stored once."""
    heads = spark.read.schema("page_id long, sha256 binary, head binary").parquet(f"{path}/records")
    payloads = spark.read.schema("sha256 binary, payload binary").parquet(f"{path}/payloads")
    return heads.join(payloads, "sha256", "left").select("page_id", "sha256", "head", "payload")


def rebuilt_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record): the exact bytes of every WARC record, revisits without their payload."""
    stub = F.expr("locate('WARC-Type: revisit', cast(substring(head, 1, 40) AS string)) > 0")
    body = F.when(stub, F.lit(b"")).otherwise(F.col("payload"))
    return records(spark, path).select("page_id", F.concat("head", body, F.lit(b"\r\n\r\n")).alias("record"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri."""
    return records(spark, path).mapInArrow(
        _parse,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string",
    )
