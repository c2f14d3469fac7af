"""Deduplicated WARC archives: equal payloads are stored once, the rest are revisits.

Only headers (page, digest) meet by digest; a page's html moves once, by page
id, to the task that writes it. Archives come from Spark's text sink with the
record separator as its line separator, so that lost executors leave no half
file and any file system will do: `part-*.txt.gz` are gzipped WARC 1.1 files.

Nulls: null html is an empty payload, a null page_id comes before all others.
Rows that repeat are records each, responses or revisits alike. Empty tables
give no records. A page has to fit in one record of less than 1 GB.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leavewatch.llm.tables import NO_ID
from leavewatch.sources.shared_storage import cut_lineage

LEAST_BYTES = 100
RECORDS_PER_FILE = 20_000
FILE_BYTES = 1 << 30   # of records before compression in a file, at most, as long as one record fits
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEPARATOR = "\r\n\r\n"
RECORD = "page_id long, record_id string, record_type string, refers_to_id string, payload_bytes long, payload_digest string"


def record_id(page: Column, digest: Column) -> Column:
    """A UUID made of page and payload, so that a retried task writes the same one."""
    h = F.sha2(F.concat_ws("/", page.cast("string"), digest), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-5"), parts[2], F.lit("-a"), parts[3],
                    F.lit("-"), parts[4], F.lit(">"))


def resolved(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page, url, html, bytes, digest, first, first_url): `first` is the page whose response a revisit repeats, else null.

    Null html is an empty payload, a null page_id comes before all others.
    Rows with equal page_id and payload are responses or revisits alike.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    full = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page"), F.col("url").cast("string").alias("url"),
                        payload.alias("html"), F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload, 256).alias("digest"))
    heads = full.where(F.col("bytes") >= least_bytes).select("page", "digest", "url")
    first = (heads.groupBy("digest").agg(F.min(F.struct("page", "url")).alias("first"), F.max("page").alias("last"))
             .where("first.page < last").select("digest", "first"))
    revisits = (heads.select("page", "digest").join(first, "digest").where("page > first.page")
                .select("page", "digest", F.col("first.page").alias("first"), F.col("first.url").alias("first_url")).distinct())
    return full.join(revisits, ["page", "digest"], "left")


def warc_records(rows: DataFrame, date: str) -> DataFrame:
    """One text per row of `resolved`: a record less the separator that ends it."""
    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    def uri(url: Column) -> Column:  # what would end a header line is escaped
        plain = F.coalesce(url, F.lit(""))
        return F.replace(F.replace(F.replace(plain, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    page = F.when(F.col("page") != NO_ID, F.col("page").cast("string")).otherwise("")
    of = F.concat(header("WARC-Refers-To", record_id(F.col("first"), F.col("digest"))), header("WARC-Refers-To-Target-URI", uri(F.col("first_url"))),
                  header("WARC-Profile", F.lit(PROFILE)))
    return rows.select(F.concat(
        F.lit("WARC/1.1"), header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", record_id(F.col("page"), F.col("digest"))), header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", uri(F.col("url"))), header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header("X-Page-Id", page), F.when(revisit, of).otherwise(""),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n\r\n"), http, body).alias("value"))


def records_per_file(largest: int) -> int:
    """So many that a file of the largest payloads, and 4 kB of headers each, stays within FILE_BYTES."""
    return max(1, min(RECORDS_PER_FILE, FILE_BYTES // (largest + 4096)))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str | None = None) -> None:
    """Write a record per page. The date of all records is this call's, unless given.

    Files are read whole, so the largest page decides how many records one takes.
    """
    largest = pages.agg(F.max(F.octet_length(F.col("html").cast("string")))).head()[0] or 0
    each = records_per_file(largest)
    stamp = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    (warc_records(resolved(pages, least_bytes), stamp).write.option("lineSep", SEPARATOR).option("compression", "gzip")
     .option("maxRecordsPerFile", each).text(path))


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its length says")
        yield headers, block


def read_records(spark, path: str) -> DataFrame:
    """RECORD of every record in the archives; digests and sizes of responses are those of the bytes read."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_id", "record_type", "refers_to_id", "payload_bytes", "payload_digest"]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    response = headers["WARC-Type"] == "response"
                    if response and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} has another digest")
                    rows.append((int(headers["X-Page-Id"]) if headers.get("X-Page-Id") else None, headers["WARC-Record-ID"], headers["WARC-Type"],
                                 headers.get("WARC-Refers-To"), len(payload) if response else None, digest))
                for i in range(0, len(rows), 5000):
                    columns = zip(*rows[i:i + 5000])
                    types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return spark.read.format("binaryFile").load(path).where("length > 0").select("content").mapInArrow(read, RECORD)


def read_pages(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, revisits resolved to their responses."""
    rows = cut_lineage(read_records(spark, path))
    responses = rows.where("record_type = 'response'")
    originals = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.first(F.struct("page_id", "payload_bytes", "payload_digest")).alias("o"))
    revisits = rows.where("record_type = 'revisit'").join(originals, "refers_to_id")
    return (responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(revisits.select("page_id", "o.payload_bytes", "o.payload_digest", "record_type", F.col("o.page_id").alias("refers_to"))))
