"""WARC archives: writing, reading, and revisit records for repeated payloads.

Archives are WARC/1.1 files of ``response`` and ``revisit`` records, each with an HTTP header and, for
responses, the payload. Spark's text writer makes them (the blank lines that end a record are its line
separator), with gzip around a file; a file holds a bounded number of records. Reading follows Content-Length, so
payloads may hold anything.

Resolution never moves payloads: headers (file, place in the file, digest, length, page) are shuffled by payload
digest, repeated digests get the largest page as their original, and every file gets back the places that
become revisits. A digest in a third of all records is counted before the shuffle, and its records are
joined in ``SALTS`` parts.

Defined results: a null payload is empty; a null or odd url leaves out its header or is percent-encoded; a null page
id counts as smaller than all (a group with no other has only responses); rows with equal page ids and
payloads are all originals if theirs is the largest; an empty table makes archives without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaftext.llm.common import as_bytes, materialise, table
from sheaftext.session import scratch_path

RECORDS_PER_FILE = 1000
SALTS = 32
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
_ODD = re.compile(r"[\x00-\x20\x7f]")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, digest: str, length: int, payload: bytes | None, refers_to: int | None = None, date: str = DATE) -> str:
    """One record without its end; ``payload`` None makes a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}{END}".encode()
    block = http + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}"]
    if url:
        lines.append("WARC-Target-URI: " + _ODD.sub(lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Block-Digest: sha1:{digest_of(block)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines) + END + block.decode()


def records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, block) of every record of a file."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}: {lines[0][:40]!r}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield at, headers, content[start:stop]
        at = stop + 4


def page_of(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


_FIELDS = {
    "file": pa.string(), "place": pa.int64(), "page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(), "date": pa.string(),
    "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary(),
}
_SCHEMA = "file string, place bigint, page_id bigint, record_type string, refers_to bigint, url string, date string, payload_digest string, payload_bytes bigint, payload binary"


def _parsed(file: str, content: bytes, payloads: bool) -> Iterator[tuple]:
    for place, h, block in records(content):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
        response = h["warc-type"] == "response"
        yield (
            file, place, page_of(h["warc-record-id"]), h["warc-type"], page_of(h.get("warc-refers-to")), h.get("warc-target-uri"), h["warc-date"],
            h["warc-payload-digest"].removeprefix("sha1:"), length, payload if payloads and response else None,
        )


def _batches(rows: Iterator[tuple], fields: dict, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in held], t) for k, t in enumerate(fields.values())], list(fields))
            held = []
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in held], t) for k, t in enumerate(fields.values())], list(fields))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in a folder; ``payloads=False`` leaves ``payload`` null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                yield from _batches(_parsed(file.as_py(), content.as_py(), payloads), _FIELDS)

    return _files(spark, path).mapInArrow(run, _SCHEMA)


def _write(texts: DataFrame, path: str) -> None:
    texts.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def write_warc(pages: DataFrame, path: str, date: str = DATE) -> None:
    """A response record per row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            yield from _batches(((record(page, url, digest_of(body), len(body), body, date=date),) for page, url, body in rows), {"value": pa.string()})

    _write(pages.select("page_id", "url", as_bytes("html").alias("html")).mapInArrow(run, "value string"), path)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(file, place, refers_to) of the records that become revisits: equal payloads of ``min_bytes`` or more."""
    repeated = headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("refers_to")).where("n > 1")
    copies = repeated.where("refers_to is not null").select("payload_digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = headers.withColumn("salt", F.pmod(F.xxhash64("file", "place"), F.lit(SALTS)).cast("int")).drop("refers_to")
    joined = salted.join(copies, ["payload_digest", "salt"])
    return joined.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("file", "place", "refers_to")


def deduplicate_warc(spark: SparkSession, source: str, target: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write the archives of ``source`` anew to ``target``, with revisit records for repeated payloads."""
    headers = materialise(read_warc(spark, source, payloads=False).where("record_type = 'response'").select("file", "place", "page_id", "payload_digest", "payload_bytes", "refers_to"), "warc-headers")
    places = resolve(headers, min_bytes).groupBy("file").agg(F.collect_list(F.struct("place", "refers_to")).alias("revisits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                gone = {r["place"]: r["refers_to"] for r in batch.column(2)[k].as_py() or ()}

                def fresh(rows, gone=gone):
                    for _, place, page, kind, refers, url, _, digest, length, payload in rows:
                        to = gone.get(place, refers)
                        yield (record(page, url, digest, length, None if place in gone or kind == "revisit" else payload, to, date),)

                yield from _batches(fresh(_parsed("", batch.column(1)[k].as_py(), True)), {"value": pa.string()})

    files = _files(spark, source).join(places.withColumnRenamed("file", "path"), "path", "left")
    _write(files.mapInArrow(run, "value string"), target)


def op6_warc(spark, sf_dir):
    raw, done = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc-deduplicated")
    write_warc(table(spark, sf_dir, "pages"), raw)
    deduplicate_warc(spark, raw, done)
    return read_warc(spark, done, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BITS = "0000000100100011010001010110011110001001101010111100110111101111"
SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM p
), b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda j: substr('{_BITS}', 4 * strpos('0123456789abcdef', substr(h, j, 1)) - 3, 4)), '') AS bits FROM g
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT)
    + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
    + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM b
"""
