"""WARC archives: records written by Spark's file sink, read back, and joined into captures.

A capture has a request, a response (or a revisit of an equal payload) and a
metadata record. Request and metadata name the response they belong to in
``WARC-Concurrent-To``; assembly joins on that name and emits one nested row
per capture.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import stage

LINE = "\r\n"
REVISIT_FROM = 100
DIGEST_CHARS = 24  # of a payload's digest in the names of its records
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, payload_sha256 string, payload binary, block binary"
)


def _record(kind: Column, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record, header and block, without the two line ends that close it (the sink adds them)."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in headers]  # NULL: no such line
    size = F.octet_length(block).cast("string")
    return F.concat(
        F.lit(f"WARC/1.1{LINE}WARC-Type: "), kind, F.lit(f"{LINE}WARC-Record-ID: <"), record_id, F.lit(f">{LINE}"),
        *[F.coalesce(x, F.lit("")) for x in lines], F.lit("Content-Length: "), size, F.lit(LINE + LINE), block)


def _plain(value: Column) -> Column:
    """A header value: no line ends."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\r\n]+", " ")


def origins(digests: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """digest and ``origin`` (the smallest page_id) of every payload that several rows have; digests: page_id, digest, bytes."""
    large = digests.filter(F.col("bytes") >= least)
    known = large.groupBy("digest").agg(F.min("page_id").alias("origin"), F.count(F.lit(1)).alias("times"))
    return known.filter("times > 1 AND origin IS NOT NULL").select("digest", "origin")


def write_warc(df: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
               date: str = "1970-01-01T00:00:00Z", least: int = REVISIT_FROM, records_per_file: int = 3000) -> None:
    """Write request, response or revisit, and metadata of every row to gzipped WARC files under ``path``.

    Record ids are names made of the id (nothing, if it is NULL) and of the
    payload's digest, so rows that repeat an id with another payload are captures
    of their own; rows that repeat both have records of one name. A NULL payload
    is empty, a NULL url an empty target. A row without an id revisits a row with
    one, never the other way round. The sink ends each record with the two line ends the format asks for; a file
    holds one gzip member and at most ``records_per_file`` records.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    pages = df.select(F.col(id_col).alias("page_id"), F.col(uri_col).alias("uri"), payload.alias("payload"),
                      F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    # written first: both sides of the join are then plain shuffles, which split a frequent payload
    known = stage(origins(pages.select("page_id", "digest", "bytes"), least), "payload_origins")
    pages = pages.join(known, "digest", "left")

    def name(kind: str, key: Column) -> Column:
        return F.concat(F.lit(f"urn:capture:{kind}:"), F.substring("digest", 1, DIGEST_CHARS), F.lit(":"), F.coalesce(key.cast("string"), F.lit("")))

    key = F.col("page_id")
    response = name("response", key)
    uri = ("WARC-Target-URI", _plain(F.col("uri")))
    when = ("WARC-Date", F.lit(date))
    to = ("WARC-Concurrent-To", F.concat(F.lit("<"), response, F.lit(">")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("bytes").cast("string"), F.lit(LINE + LINE))
    again = F.col("origin").isNotNull() & ~F.col("origin").eqNullSafe(key)
    records = F.array(
        _record(F.lit("request"), name("request", key), [uri, when, to, ("Content-Type", F.lit("application/http; msgtype=request"))],
                F.concat(F.lit("GET "), _plain(F.col("uri")), F.lit(f" HTTP/1.1{LINE}{LINE}"))),
        _record(F.when(again, "revisit").otherwise("response"), response,
                [uri, when, ("Content-Type", F.lit("application/http; msgtype=response")),
                 ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
                 ("WARC-Profile", F.when(again, F.lit(PROFILE))),
                 ("WARC-Refers-To", F.when(again, F.concat(F.lit("<"), name("response", F.col("origin")), F.lit(">"))))],
                F.when(again, http).otherwise(F.concat(http, F.col("payload")))),
        _record(F.lit("metadata"), name("metadata", key), [uri, when, to, ("Content-Type", F.lit("application/warc-fields"))],
                F.concat(F.lit("payloadBytes: "), F.col("bytes").cast("string"), F.lit(LINE))),
    )
    (pages.select(F.explode(records).alias("value")).write.option("lineSep", LINE + LINE).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def unpacked(content: bytes) -> BinaryIO:
    """A file's bytes as a stream, unpacked as they are read; gzip members follow each other."""
    plain = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=plain)) if content[:2] == b"\x1f\x8b" else plain


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, by Content-Length; a cut-off file raises.

    One record is held at a time.
    """
    try:
        while first := stream.readline():
            if first == b"\r\n":
                continue
            if not first.startswith(b"WARC/"):
                raise ValueError("no WARC record where one should begin")
            headers = {}
            while (line := stream.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers[name.strip().lower()] = value.strip()
            size = int(headers["content-length"])
            block = stream.read(size)
            if not line or len(block) < size:
                raise ValueError("the last record is cut off")
            yield headers, block
    except EOFError as e:
        raise ValueError("the last gzip member is cut off") from e


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers.get("warc-type")
    payload, length = (block, len(block))
    if kind in ("request", "response", "revisit") and "application/http" in headers.get("content-type", ""):
        head, _, payload = block.partition(b"\r\n\r\n")
        stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        length = int(stated[1]) if kind == "revisit" and stated else len(payload)
    bare = lambda name: (headers.get(name) or "").strip("<>") or None
    digest = (headers.get("warc-payload-digest") or "").rpartition(":")[2].lower() or None
    return (bare("warc-record-id"), kind, bare("warc-concurrent-to"), bare("warc-refers-to"), headers.get("warc-target-uri"),
            headers.get("warc-date"), digest, length, hashlib.sha256(payload).hexdigest(), payload, block)


def read_warc(spark: SparkSession, path: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per record of the files under ``path`` (plain or gzipped, one member or one per record), columns ``RECORD``.

    A task holds a packed file at a time, unpacks it record by record and hands
    on batches of about ``batch_bytes``; packed files therefore have to fit into a
    task, as those of ``write_warc`` do.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in RECORD.split(", ")])

    def records(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parse(unpacked(content.as_py())):
                    rows.append(_row(headers, block))
                    held += len(block)
                    if held >= batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.*").load(path).select("content").mapInArrow(records, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit: capture_id, uri, date, response, request, metadata (structs; NULL where missing).

    Requests and metadata meet their response by ``concurrent_to``. Where
    several of a kind name one response, the one with the smallest record id is
    taken. Records that name no response here are left out.
    """
    main = records.filter(F.col("record_type").isin("response", "revisit"))
    fields = F.struct("record_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload_sha256", "payload")
    main = main.select(F.col("record_id").alias("capture_id"), F.col("target_uri").alias("uri"), "date", fields.alias("response"))
    side = records.filter(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    one = F.struct("record_id", "target_uri", "block")
    pick = lambda kind: F.min(F.when(F.col("record_type") == kind, one)).alias(kind)
    side = side.groupBy(F.col("concurrent_to").alias("capture_id")).agg(pick("request"), pick("metadata"))
    return main.join(side, "capture_id", "left")
