"""WARC archives without repeated payloads: writing, reading, and resolving revisit records.

Writing. Digests of payloads of at least ``LEAST_BYTES`` bytes are grouped (with a partial maximum
in each task, so a payload that a third of all pages share is a few rows), the largest page id of
each repeated payload is its original, and a join by digest, which adaptive execution may split,
tells every page whether it is a response or a revisit of it. Records are text, written by Spark's
text sink: what ends a record is the sink's line separator. Files hold ``records_per_file`` records
at most, since a file is read as one value.

Reading. Records are parsed by their Content-Length, so payloads may hold anything, record heads
included; files may be plain or gzip, in one member or one for each record. Revisits get their
payload's size from the response they refer to, in a join of headers.

Defined results: a null page is an empty payload; a null id is written as such, is never an
original where its payload has another, and where all are null all are responses; rows that repeat
an original's id are responses too; equal rows are records of their own; an empty table writes no
record and reads back as no row; further columns are not written. Blanks and control characters in
an address are percent-encoded.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RN = "\r\n"
_ROWS = 500
HEADERS = ("page_id string, record_type string, url string, date string, payload_digest string, "
           "refers_to string, payload_bytes long, payload_sha1 string")


def resolved(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
             least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(key, url, html, size, digest, refers_to): refers_to is null for responses."""
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"),
                             "digest": F.sha1(F.col("html").cast("binary"))})
    originals = rows.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.max("key").alias("original"), F.count("*").alias("copies")).filter("copies > 1")
    joined = rows.join(originals.select("digest", "original"), "digest", "left")
    return joined.select("key", "url", "html", "size", "digest", F.when(
        ~F.col("original").eqNullSafe(F.col("key")), F.col("original")).alias("refers_to"))


def _name(key: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _lines(*fields: tuple[str, Column | str]) -> Column:
    """Header lines; a null field has none."""
    return F.concat(*(F.coalesce(F.concat(F.lit(f"{k}: "), F.lit(v) if isinstance(v, str) else v,
                                          F.lit(_RN)), F.lit("")) for k, v in fields))


def _record(date: str) -> Column:
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK" + _RN), _lines(
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", F.col("size").cast("string"))), F.lit(_RN))
    address = F.col("url")
    for c in map(chr, (*range(0x21), 0x7F)):
        address = F.replace(address, F.lit(c), F.lit(f"%{ord(c):02X}"))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    head = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", _name(F.col("key"))),
        ("WARC-Date", date),
        ("WARC-Target-URI", address),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(revisit, _name(F.col("refers_to")))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1" + _RN), head, F.lit(_RN), block)


def write(pages: DataFrame, path: str, date: str, records_per_file: int = 1000,
          compression: str = "gzip", **columns) -> None:
    """One record for each row, in a new folder. ``columns`` as for ``resolved``."""
    (resolved(pages, **columns).select(_record(date).alias("value")).write
     .option("lineSep", _RN * 2).option("compression", compression)
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse(stream):
    """(fields, block) of each record of a binary stream; names of fields in lower case."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record head: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("an archive ends within a record")
        yield fields, block


def _page(name: str | None) -> str | None:
    found = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return found or None


def _headers(batches):
    names = [f.split()[0] for f in HEADERS.split(", ")]
    types = [pa.int64() if n == "payload_bytes" else pa.string() for n in names]

    def rows(batch):
        for content in batch.column("content"):
            raw = io.BytesIO(content.as_py())
            zipped = raw.getvalue()[:2] == b"\x1f\x8b"
            for f, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=raw)) if zipped else raw):
                kind = f.get("warc-type")
                http, _, payload = block.partition(b"\r\n\r\n")
                whole = kind == "response"
                yield (_page(f.get("warc-record-id")), kind, f.get("warc-target-uri"),
                       f.get("warc-date"),
                       f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                       _page(f.get("warc-refers-to")), len(payload) if whole else None,
                       hashlib.sha1(payload).hexdigest() if whole else None)

    def out(some):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)],
            names=names)

    for batch in batches:
        some = []
        for row in rows(batch):
            some.append(row)
            if len(some) == _ROWS:
                yield out(some)
                some = []
        if some:
            yield out(some)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record: its header fields; of responses also the size and SHA-1 of the payload
    as it was read. Payloads don't leave the task that reads them."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        _headers, HEADERS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """The records; revisits have size and SHA-1 of the response that they refer to."""
    responses = records.filter("record_type = 'response'")
    known = responses.filter("page_id is not null").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_sha1").alias("payload_sha1"))
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes", "payload_sha1")
    return responses.unionByName(revisits.join(known, ["refers_to", "payload_digest"], "left"))
