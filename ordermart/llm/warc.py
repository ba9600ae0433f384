"""WARC archives and revisit resolution (operator 4).

``write_pages`` writes a response record for every page; ``resolve`` reads such archives, shuffles the
records' headers by payload digest, takes the first record of each payload (least page id, then
least record id) as its response and writes new archives with fresh headers, in which every other record
is a revisit that names the response; ``read`` lists an archive folder's records.

Archives are files of gzip members, one for each record.  Spark's text writer writes them, its line
separator being an empty gzip member, so they go to any store, and Spark's text reader splits them
at it: a task holds some records at a time, whatever an archive's size.  (A record holds no such separator: its first
two bytes don't follow one another in UTF-8, and payloads are checked against their digests.)  Records are named by their
WARC-Record-ID, which is unique.  The payload itself is shuffled once, compressed, to meet its record's decision.

Null html is an empty payload; equal payloads shorter than ``least_bytes`` stay responses.  Null
page_id sorts last and is left out of the headers; of repeated rows one is the response.
A null url leaves its header out.  Only page_id, url and html are read; empty tables give no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.text import pieces
from ordermart.session import scratch_path

RECORDS = 20_000  # of an archive, at most
LEVEL = 3
#: Fixed value: gzip's encoding of no bytes.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300" + "00" * 8)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A compressed record; headers without a value are left out."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))] if v is not None)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def record(kind: str, page_id, url, digest: str, size: int, payload: bytes = b"", refers_to=None, refers_id=None, own_id=None) -> bytes:
    common = [
        ("WARC-Type", kind), ("WARC-Record-ID", own_id or record_id(kind, page_id, digest)), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", url and "".join(url.split())), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
        ("X-Page-ID", page_id), ("X-Payload-Length", size)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if kind == "revisit":
        common += [("WARC-Profile", REVISIT), ("WARC-Refers-To", refers_id), ("X-Refers-To-Page-ID", refers_to)]
    return member(common, http + payload)


def record_id(*names) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, names)))}>"


def members(content: bytes):
    """(offset, inflated bytes) of the non-empty gzip members of an archive."""
    view, at = memoryview(content), 0
    while at < len(view):
        begin, out, unpack = at, [], zlib.decompressobj(31)
        while not unpack.eof:
            if at >= len(view):
                raise ValueError(f"archive ends inside the record at {begin}")
            piece = view[at: at + 65536]
            out.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        if data := b"".join(out):
            yield begin, data


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (what follows the HTTP header in the block) of an inflated record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _responses(batches):
    task, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in pieces(batch, "html"):
            out = []
            for page_id, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = (html or "").encode()
                digest, n = digest_of(payload), n + 1
                # the task's own count tells repeated rows apart
                out.append(record("response", page_id, url, digest, len(payload), payload, own_id=record_id("response", page_id, digest, task, n)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def _write(records: DataFrame, path: str) -> None:
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1")) \
        .option("encoding", "ISO-8859-1").option("compression", "none").option("maxRecordsPerFile", RECORDS).text(path)


def write_pages(pages: DataFrame, path: str) -> None:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    _write(rows.mapInArrow(_responses, "record binary"), path)


LISTED = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to long"


def _list(with_payload: bool):
    names = [x.split()[0] for x in LISTED.split(", ")]

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for content in batch.column("content"):
                for _, data in members(content.as_py()):
                    h, payload = parse(data)
                    number = lambda k: int(h[k]) if k in h else None  # noqa: E731, B023
                    own = digest_of(payload) if h["WARC-Type"] == "response" else h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response" and f"sha1:{own}" != h["WARC-Payload-Digest"]:
                        raise ValueError(f"payload of the record {h['WARC-Record-ID']} doesn't have its digest")
                    row = (number("X-Page-ID"), h.get("WARC-Target-URI"), len(payload) if h["WARC-Type"] == "response" else number("X-Payload-Length"),
                           own, h["WARC-Type"], h["WARC-Record-ID"], number("X-Refers-To-Page-ID"))
                    rows.append((*row, zlib.compress(payload, 1)) if with_payload else row)
                    size += len(rows[-1][-1]) if with_payload else 100
                    if size > 4 << 20:
                        yield _batch(rows, names, with_payload)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, names, with_payload)
    return run


def _batch(rows, names, with_payload):
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    names = [*names, "payload"] if with_payload else names
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives in a folder (and their payloads, deflated)."""
    records = spark.read.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    return records.select(F.col("value").cast("binary").alias("content")).mapInArrow(_list(with_payload), LISTED + (", payload binary" if with_payload else ""))


def _resolved(batches):
    cols = ("page_id", "url", "payload_digest", "payload_bytes", "payload", "record_type", "record_id", "first_page", "first_id")
    for batch in batches:
        out = []
        for page_id, url, digest, size, payload, kind, own, first_page, first_id in zip(*(batch.column(c).to_pylist() for c in cols), strict=True):
            if kind == "response":
                out.append(record(kind, page_id, url, digest, size, zlib.decompress(payload), own_id=own))
            else:
                out.append(record(kind, page_id, url, digest, size, refers_to=first_page, refers_id=first_id, own_id=record_id(kind, own)))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def resolve(spark: SparkSession, path: str, to: str, least_bytes: int = 0) -> None:
    """Archives of responses in ``path`` become deduplicated archives in ``to``."""
    heads = read(spark, path).select("record_id", "page_id", "payload_bytes", "payload_digest")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_id")
    first = heads.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min(order).alias("first"))
    # every record that has an earlier one with its payload revisits it
    revisits = heads.filter(F.col("payload_bytes") >= least_bytes).join(first, "payload_digest").filter(
        "first.record_id <> record_id").select("record_id", F.col("first.page_id").alias("first_page"), F.col("first.record_id").alias("first_id"), F.lit(True).alias("again"))
    rows = read(spark, path, with_payload=True).drop("record_type", "refers_to").join(revisits, "record_id", "left")
    _write(rows.select("page_id", "url", "payload_digest", "payload_bytes",
                       F.when(F.col("again"), F.lit(None)).otherwise(F.col("payload")).alias("payload"),
                       F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"), "record_id", "first_page", "first_id")
           .mapInArrow(_resolved, "record binary"), to)


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written, resolved and read back: a row for each record of the deduplicated archives."""
    spark = pages.sparkSession
    raw, done = scratch_path(spark, "warc"), scratch_path(spark, "warc-deduplicated")
    write_pages(pages, raw)
    resolve(spark, raw, done, least_bytes)
    return read(spark, done)
