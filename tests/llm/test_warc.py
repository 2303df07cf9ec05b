"""The archive against a plain version, record by record."""

import base64
import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from corpusgauge.durable import Steps
from corpusgauge.llm import warc


def expected(rows, least=0):
    ids = defaultdict(list)
    for page_id, _, html in rows:
        ids[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        known = [other for other in ids[html or ""] if other is not None]
        keep = max(known) if known else None
        response = page_id == keep or len(data) < least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "response" if response else "revisit", None if response else keep))
    return sorted(map(str, out))


def got(spark, rows, least=0):
    pages = spark.createDataFrame([(*row, "z") for row in rows], "page_id long, url string, html string, digest string")
    steps = Steps(spark)
    archive = warc.write_archive(pages, steps, least_bytes=least)
    found = warc.read_archive(archive, steps).collect()
    return archive, sorted(str(tuple(row)[:5]) for row in found)


def test_odd_rows(spark):
    rows = [(1, "http://a", None), (2, None, ""), (3, "http://b", "é\r\n\r\nWARC/1.1"), (4, "http://b", "é\r\n\r\nWARC/1.1"), (None, "http://c", "x"),
            (9, "u", "x"), (9, "u", "x"), (10, "u", "long " * 60000), (None, "u", "only null"), (7, "u", "x")]
    assert got(spark, rows)[1] == expected(rows)
    assert got(spark, rows, least=2)[1] == expected(rows, 2)
    assert got(spark, [])[1] == []


def test_given_pages_and_exact_records(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    copies = pages.filter("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 10_000)
    rows = [tuple(row) for row in pages.unionByName(copies).collect()]
    archive, found = got(spark, rows)
    assert found == expected(rows)
    payloads, _, _ = archive.tables()
    assert payloads.count() == len({row[2] for row in rows})
    html = {page_id: text.encode() for page_id, _, text in rows}
    for row in warc.response_records(archive).collect():
        head, _, rest = bytes(row.record).partition(b"\r\n\r\n")
        http, _, body = rest.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and body == html[row.id] + b"\r\n\r\n"
        assert f"Content-Length: {len(http) + 4 + len(html[row.id])}".encode() in head
        assert f"Content-Length: {len(html[row.id])}".encode() in http
    for row in warc.revisit_records(archive).collect():
        record = bytes(row.record)
        assert b"WARC-Type: revisit\r\n" in record and b"WARC-Refers-To: <urn:uuid:" in record and record.endswith(b"\r\n" * 4)
