"""WARC archives: exact round trips of hostile payloads, reassembly, and archives that are broken."""

import hashlib
import random

import pytest

from millrace.llm.queries import LLM_QUERIES
from millrace.llm.texts import scratch
from millrace.llm.warc import VERSION, archive_and_read, chunked, dechunked, payloads, read_warc, reassembled, write_warc

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def wanted(rows):
    """By the contract, without archives."""
    largest = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            largest[data] = max(largest.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        target = largest.get(data)
        revisit = target is not None and target != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [tuple(r) for r in LLM_QUERIES["op9_warc_archive"](spark, SF).collect()]
    assert sorted(got, key=str) == wanted(rows)


def test_hostile_payloads(spark):
    line = VERSION
    texts = [line * 700, "x" * 999, "y" * 1000, "y" * 1000, "é" * 30_000, "é" * 30_000, "\r\n\r\n" * 900, "0\r\n\r\n" + line, "", None, "\0\x1c \r" * 500]
    texts += [(line + "0\r\n\r\n" + line[:-1]) * 2_000, "é" * 30_000]
    rows = [(i, f"http://x/{i}\r\n{line}", t) for i, t in enumerate(texts)] + [(None, None, "y" * 1000), (12, "again", "é" * 30_000)]
    rows += [(None, "u", "z" * 2000), (None, "u", "z" * 2000)]
    got = [tuple(r) for r in archive_and_read(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == wanted(rows)


def test_chunks_round_trip():
    rng = random.Random(1)
    for size in (1, 7, 4096):
        for _ in range(20):
            data = b"".join(rng.choice([VERSION.encode(), b"\r\n", b"0\r\n\r\n", b"abc", bytes([rng.randrange(256)])]) for _ in range(200))
            coded = chunked(data, size)
            assert dechunked(coded) == data and (size < 7 or VERSION.encode() not in coded)


def test_whole_payloads_come_back(spark):
    html = "".join(chr(200 + i % 700) for i in range(60_000))
    path = scratch(spark, "warc-test")
    write_warc(spark.createDataFrame([(1, "http://x/", html)], SCHEMA), path, segment_bytes=1000)
    records = read_warc(spark, path)
    assert records.filter("warc_type = 'continuation'").count() > 50
    assert bytes(payloads(reassembled(records)).first()["payload"]).decode() == html
    with pytest.raises(Exception, match="missing or repeated"):
        payloads(reassembled(records.filter("segment IS NULL OR segment <> 7"))).collect()
    with pytest.raises(Exception, match="announced were"):
        payloads(reassembled(records.withColumn("total", records["total"] + 1))).collect()


def test_empty_table(spark):
    assert archive_and_read(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_version_text_may_end_anything(spark):
    text = VERSION.strip()
    payloads_ = [text, "x" * 4088 + text, "x" * 4090 + text, "x" * 4088 + text + "y" * 5000, text * 3, "x" * 16_200 + text * 40, "WARC/1." * 9 + text, text[:5] + text]
    rows = [(i, url, t) for i, t in enumerate(payloads_) for url in (f"http://x/{text}", text)]
    rows = [(n, url, t) for n, (_, url, t) in enumerate(rows)]
    for segment_bytes in (61, 16_384):
        got = [tuple(r) for r in archive_and_read(spark.createDataFrame(rows, SCHEMA), segment_bytes).collect()]
        assert sorted(got, key=str) == wanted(rows)


def test_no_archive_holds_the_version_text_but_at_records():
    rng = random.Random(7)
    pieces = [b"WARC/1.1", b"WARC/1.", b"WARC", b"/1.1", b"1\r\n", b"\r\n", b"x" * 50]
    for size in (3, 8, 9, 64, 4096):
        for _ in range(50):
            data = b"".join(rng.choice(pieces) for _ in range(120))
            coded = chunked(data, size)
            assert dechunked(coded) == data and b"WARC/1.1" not in coded


def test_clashing_columns_and_awkward_rows(spark):
    rows = [(1, None, None, 3, "a"), (1, None, None, 3, "a"), (None, "u", "z" * 2000, 4, "b"), (2, "u", "z" * 2000, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, segment int, payload_digest string")
    got = [tuple(r) for r in archive_and_read(pages).collect()]
    assert sorted(got, key=str) == wanted([r[:3] for r in rows])
