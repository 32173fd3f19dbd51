"""Deduplicated WARC archives: revisit records for payloads that another record holds.

Slim headers are shuffled by payload digest to choose one response per digest; the payloads
move once, by page, and only to be written. Spark's own text writer makes the archives, so any
file system, its commit protocol and lost executors are taken care of: a "line" is a record,
compressed as a gzip member of its own, and the separator is an empty member.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.session import materialise, scratch_dir

#: Smaller payloads are always written in full: a revisit record would not be shorter.
LEAST_BYTES = 1000
#: Bytes of payloads that a file has on average at most; it is read whole by one task.
FILE_BYTES = 32 << 20

# fixed values of the format
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"
#: Between records: a gzip member without content, as characters of one byte.
_BETWEEN = gzip.compress(b"", mtime=0).decode("latin-1")

_READ = (
    "page_id long, url string, record_type string, record_id string, refers_id string, payload_digest string, "
    "declared_bytes long, payload binary"
)


def _payload(html: str = "html") -> Column:
    return F.coalesce(F.col(html), F.lit(""))


def headers(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload_digest, payload_bytes`` of every page; a null payload is empty."""
    return pages.select(
        "page_id", "url", F.sha1(_payload()).alias("payload_digest"), F.octet_length(_payload()).cast("long").alias("payload_bytes")
    )


def revisits(slim: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``(page_id, payload_digest, refers_to, refers_url)`` of ``headers`` rows (with a ``url``) whose payload a larger page_id holds."""
    slim = slim.filter(F.col("payload_bytes") >= least_bytes)
    last = (
        slim.groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", F.col("last.page_id").alias("refers_to"), F.col("last.url").alias("refers_url"))
    )
    return (
        slim.join(last, "payload_digest")
        .filter(F.col("page_id") < F.col("refers_to"))
        .select("page_id", "payload_digest", "refers_to", "refers_url")
        .distinct()
    )


def _record_id(page: Column | str) -> Column:
    """A name made of the page and its payload, so whoever knows both can refer to it; a page without an id has a drawn one."""
    page = F.col(page) if isinstance(page, str) else page
    named = F.sha1(F.concat(page.cast("string"), F.lit("|"), F.col("payload_digest")))
    parts = F.regexp_replace(named, "^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), F.coalesce(parts, F.uuid()), F.lit(">"))


def _uri(url: str) -> Column:
    return F.coalesce(F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20"), F.lit(""))


def _records(date: str) -> Column:
    """The WARC record of a row with ``refers_to``, ``refers_url`` and ``payload_digest``."""
    line = "\r\n"
    again = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "),
        F.octet_length(_payload()).cast("string"),
        F.lit(_END),
    )
    block = F.when(again, http).otherwise(F.concat(http, _payload()))
    return F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: "), _record_id("page_id"),
        F.lit(f"{line}WARC-Date: {date}{line}WARC-Target-URI: "), _uri("url"),
        F.lit(f"{line}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.coalesce(F.concat(F.lit(f"{line}X-Page-ID: "), F.col("page_id").cast("string")), F.lit("")),
        F.when(
            again,
            F.concat(
                F.lit(f"{line}WARC-Profile: {_PROFILE}{line}WARC-Refers-To: "), _record_id("refers_to"),
                F.lit(f"{line}WARC-Refers-To-Target-URI: "), _uri("refers_url"), F.lit(f"{line}WARC-Refers-To-Date: {date}"),
            ),
        ).otherwise(""),
        F.lit(f"{line}Content-Type: application/http;msgtype=response{line}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(_END), block, F.lit(_END),
    )


def _member(record: Column) -> Column:
    """A record as a gzip member."""

    @F.arrow_udf("binary")
    def member(records: pa.Array) -> pa.Array:
        return pa.array([gzip.compress(r, 6, mtime=0) for r in records.cast(pa.binary()).to_pylist()], pa.binary())

    return member(record)


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: datetime | None = None) -> None:
    """Write a record per row of ``pages(page_id, url, html, ...)`` into WARC files below ``path``, a gzip member each.

    Of equal payloads of ``least_bytes`` and more, the one with the largest page_id is the
    response, the others are revisits, which name its record, address and date. A null page_id is
    always a response, and so are all rows that repeat the largest page_id. A null html is an empty
    payload, a null url empty. Records are dated ``date``, or now; rows equal in page_id and payload are
    captures of one name. A file has about ``FILE_BYTES`` of payloads.
    """
    when = (date or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    slim = materialise(headers(pages), "headers")
    again = materialise(revisits(slim, least_bytes), "revisits")
    n, total = slim.agg(F.count("*"), F.sum("payload_bytes")).first()
    digested = pages.select("page_id", "url", "html", F.sha1(_payload()).alias("payload_digest"))
    marked = digested.join(again, ["page_id", "payload_digest"], "left")
    (
        marked.select(_member(_records(when)).cast("string").alias("value"))
        .write.option("lineSep", _BETWEEN)
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", max(1, FILE_BYTES * n // max(total or 0, 1)))
        .text(path)
    )


def _parse(content: bytes) -> Iterator[dict]:
    stream = gzip.GzipFile(fileobj=io.BytesIO(content))
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = _fields(stream)
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]) or stream.read(len(_END)) != _END.encode():
            raise ValueError(f"cut off in record {fields['warc-record-id']}")
        http = io.BytesIO(block)
        http.readline()
        declared = int(_fields(http)["content-length"])
        kind = fields["warc-type"]
        payload = http.read() if kind == "response" else None
        if kind == "response" and len(payload) != declared:
            raise ValueError(f"payload of {fields['warc-record-id']} has {len(payload)} bytes instead of {declared}")
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
        yield {
            "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
            "url": fields["warc-target-uri"],
            "record_type": kind,
            "record_id": fields["warc-record-id"],
            "refers_id": fields.get("warc-refers-to"),
            "payload_digest": digest,
            "declared_bytes": declared,
            "payload": payload,
        }


def _fields(stream: io.BufferedIOBase) -> dict[str, str]:
    out = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        out[name.lower()] = value.strip()
    return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``, payloads checked against length and digest."""

    def records(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in _READ.split(", ")]
        for part in parts:
            for content in part["content"]:
                rows: list[dict] = []
                size = 0
                for row in _parse(content):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size > 1 << 24:
                        yield _frame(rows, names)
                        rows, size = [], 0
                yield _frame(rows, names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(records, _READ)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for name in ("page_id", "declared_bytes"):
        out[name] = out[name].astype("Int64")
    return out


def resolve(records: DataFrame, payload: bool = True) -> DataFrame:
    """The records with the payload that revisits borrow from their response, or its length alone."""
    own = records.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    if not payload:
        own = materialise(own.drop("payload"), "records")  # the archives are parsed once
    borrowed = ["payload_bytes", "payload"] if payload else ["payload_bytes"]
    original = (
        own.filter("record_type = 'response'")
        .join(own.select(F.col("refers_id").alias("record_id")).filter("record_id IS NOT NULL").distinct(), "record_id", "left_semi")
        .select(F.col("record_id").alias("refers_id"), F.struct("page_id", *borrowed).alias("original"))
        .dropDuplicates(["refers_id"])
    )
    joined = own.join(original, "refers_id", "left")
    return joined.select(
        "page_id", "url", "payload_digest", "record_type", F.col("original.page_id").alias("refers_to"),
        *[F.coalesce(F.col(name), F.col(f"original.{name}")).alias(name) for name in borrowed],
    )


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found = resolve(read_archives(spark, path), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
