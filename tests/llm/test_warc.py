"""Archives written and read back."""

import gzip
import hashlib
import io

from pyspark.sql import functions as F

from leavewatch.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first string, page string"
LONG = "<p>" + "x" * 120
ROWS = [(7, "http://a/", LONG), (3, "http://b/\r\nWARC-Type: fake", LONG), (9, None, LONG), (1, "http://c/", "short"), (2, "u", "short"), (4, "u", ""),
        (5, "u", None), (6, "u", LONG + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (8, "u", "é" * 50), (10, "u", "é" * 50), (11, "u", "é" * 49)]


def expected(rows):
    out = set()
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        first = min(same, key=lambda p: (p is not None, p or 0))
        again = len(raw) >= 100 and page is not None and page != first
        out.add((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return out


def stored(spark, rows, path):
    warc.write_archives(spark.createDataFrame([(*r, None, "a", "b") for r in rows], SCHEMA).repartition(3), path)
    return [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_pages(spark, path).collect()]


def test_round_trip(spark, tmp_path):
    found = stored(spark, ROWS, str(tmp_path / "w"))
    assert len(found) == len(ROWS)
    assert set(found) == expected(ROWS)


def test_missing_and_repeated_ids(spark, tmp_path):
    rows = [*ROWS, (None, "n", LONG), (7, "again", LONG), (3, "again", LONG)]
    found = stored(spark, rows, str(tmp_path / "w"))
    assert len(found) == len(rows)
    by_page = {}
    for page, *rest in found:
        by_page.setdefault(page, set()).add(tuple(rest))
    assert {p: len(v) for p, v in by_page.items() if len(v) > 1} == {}
    assert next(iter(by_page[None]))[2] == "response"  # comes before all other pages
    assert next(iter(by_page[3]))[2] == "revisit"


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_pages(spark, str(tmp_path / "w")).count() == 0


def test_files_are_archives(spark, tmp_path):
    stored(spark, ROWS, str(tmp_path / "w"))
    payloads, records = [], []
    for file in (tmp_path / "w").glob("part-*.gz"):
        for headers, block in warc.parse(io.BytesIO(gzip.decompress(file.read_bytes()))):
            records.append(headers)
            if headers["WARC-Type"] == "response":
                payloads.append(block.partition(b"\r\n\r\n")[2])
    assert payloads.count(LONG.encode()) == 1
    assert len({h["WARC-Record-ID"] for h in records}) == len(ROWS)
    ids = {h["WARC-Record-ID"] for h in records if h["WARC-Type"] == "response"}
    assert all(h["WARC-Refers-To"] in ids for h in records if h["WARC-Type"] == "revisit")


def test_hot_payload(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.lit(LONG)).otherwise(F.concat(F.lit(LONG), "id")).alias("html"))
    warc.write_archives(pages, str(tmp_path / "w"))
    found = warc.read_pages(spark, str(tmp_path / "w")).where("record_type = 'revisit'").collect()
    assert {r.refers_to for r in found} == {0} and len(found) == 133


def test_large_pages_make_smaller_files(spark, tmp_path, monkeypatch):
    assert warc.records_per_file(0) == warc.RECORDS_PER_FILE
    assert warc.records_per_file(100 << 20) * (100 << 20) <= warc.FILE_BYTES and warc.records_per_file(5 << 30) == 1
    monkeypatch.setattr(warc, "FILE_BYTES", 10_000)
    assert set(stored(spark, ROWS, str(tmp_path / "w"))) == expected(ROWS)
    assert len(list((tmp_path / "w").glob("part-*"))) >= 5
