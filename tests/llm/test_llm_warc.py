import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm.queries import QUERIES
from ledgerflow.llm.textops import scratch
from ledgerflow.llm.warc import parse, read_archives, resolve, round_trip, with_revisits, write_archives

PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "http://d/", ""), (5, "http://é/", "ü\r\n\r\nWARC/1.1\r\n"),
         (6, "http://f/", "z" * 300_000), (None, "http://n/", "<p>x</p>"), (7, "u", "<p>x</p>"), (7, "u", "<p>x</p>"), (8, "v", "only")]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"original": F.lit(1), "bytes": F.lit("b"), "sha1": F.lit("s")}).repartition(3)


def _want(rows, least=0):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        top = max(same, default=None)
        own = i == top or len(body) < least
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if own else "revisit", None if own else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = round_trip(_pages(spark), least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == _want(PAGES, least)


def test_empty_table(spark):
    assert round_trip(_pages(spark).limit(0)).count() == 0


def test_small_archives_are_rolled_and_all_read(spark):
    folder = scratch(spark, "t-warc")
    rows = [(i, f"http://{i}/", f"page {i % 50} " * 50) for i in range(200)]
    manifest = write_archives(resolve(_pages(spark, rows)), folder, archive_bytes=2000)
    assert manifest.count() > 10 and manifest.agg(F.sum("records")).first()[0] == 200
    # an archive that no manifest names (a task that failed) is not read
    with open(f"{folder.removeprefix('file://')}/part-stray.warc.gz", "wb") as f:
        f.write(b"broken")
    got = with_revisits(read_archives(manifest, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == _want(rows)


def test_broken_archives_are_noticed():
    def member(payload, digest):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        return gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha1:" + digest
                             + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    good = base64.b32encode(hashlib.sha1(b"x").digest())
    assert [r["payload_bytes"] for r in parse(io.BytesIO(member(b"x", good) * 2))] == [1, 1]
    with pytest.raises(ValueError):
        list(parse(io.BytesIO(member(b"y", good))))
    with pytest.raises(ValueError):
        list(parse(io.BytesIO(gzip.compress(b"HTTP/1.1\r\n"))))


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op6_warc_revisits"](spark, "/root/testdata/sf0.001").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == _want(pages)
