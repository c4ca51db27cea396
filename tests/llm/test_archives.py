"""Archives: exact round trips, and the query against plain digests."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from review_topics.llm import archives, queries
from review_topics.session import scratch_path


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_whole_query(spark, sf):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    newest = {}
    for page in sorted(pages):
        newest[pages[page]] = page
    want = {p: (len(b), digest(b), "response" if newest[b] == p else "revisit", None if newest[b] == p else newest[b]) for p, b in pages.items()}
    out = queries.QUERIES["op9_warc"](spark, sf).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out} == want and len(out) == len(want)


AWKWARD = [b"", b"\r\n\r\n", b"\n", b"WARC/1.1\r\n\r\n", bytes(range(256)) * 5, b"HTTP/1.1 200 OK\r\n\r\nx", "é ".encode(), b"x" * 300_000, b"", b"\n\n\n"]


@pytest.mark.parametrize("versions", [(1,), (2,), (1, 2)])
def test_round_trip_of_awkward_payloads(spark, versions):
    rows = [(i, None if i == 3 else f"http://h/é {i}\r\n", bytearray(p)) for i, p in enumerate(AWKWARD)] + [(90, "http://h/", None), (None, "u", bytearray(b"x")), (None, "u", bytearray(b"x"))]
    pages = spark.createDataFrame(rows, "record long, url string, payload binary").withColumn("digest", F.lit(1)).repartition(3)
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(pages, arc, versions)
    assert sorted((-1 if r["record"] is None else r["record"], bytes(r["payload"])) for r in archives.read_arc(spark, arc).collect()) == sorted((-1 if i is None else i, bytes(p or b"")) for i, _, p in rows)
    archives.convert(spark, arc, warc)
    out = archives.read_warc(spark, warc).collect()
    by_record = {r["record"]: r for r in out if r["record"] is not None}
    assert len(out) == len(rows) and len(by_record) == len(rows) - 2
    for i, _, payload in rows:
        if i is not None:
            row, payload = by_record[i], bytes(payload or b"")
            assert (row["payload_digest"], row["payload_bytes"]) == (digest(payload), len(payload))
            twins = [j for j, _, p in rows if j is not None and bytes(p or b"") == payload]
            if i == max(twins):
                assert row["warc_type"] == "response" and bytes(row["payload"]) == payload
            else:
                assert row["warc_type"] == "revisit" and row["refers_to"] == by_record[max(twins)]["warc_id"]
    assert len({r["warc_id"] for r in out}) == len(rows)


def test_repeated_pages_have_identifiers_of_their_own(spark, tmp_path):
    rows = [(1, "u", "aa"), (2, "v", "aa"), (2, "v", "aa"), (None, "w", "aa"), (None, "w", "aa"), (0, "u", "aa")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(pages.toDF("record", "url", "payload"), arc)
    archives.convert(spark, arc, warc)
    out = archives.read_warc(spark, warc).collect()
    assert len({r["warc_id"] for r in out}) == len(rows)
    whole = {r["warc_id"] for r in out if r["record"] == 2 and r["warc_type"] == "response"}
    pointed = {r["refers_to"] for r in out if r["warc_type"] == "revisit"}
    assert len(whole) == 2 and len(pointed) == 1 and pointed <= whole
    found = queries.QUERIES["op9_warc"](spark, str(tmp_path)).select("page_id", "record_type", "refers_to").collect()
    want = [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None), (None, "response", None), (None, "response", None)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_files_are_counted_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(archives, "FILE_BYTES", 2000)
    rows = [(i, "u", f"{i} " * 100) for i in range(200)]
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(spark.createDataFrame(rows, "record long, url string, payload string"), arc)
    archives.convert(spark, arc, warc)
    files = spark.read.format("binaryFile").load(warc).count()
    assert files > 15 and {r["record"]: bytes(r["payload"]).decode() for r in archives.read_warc(spark, warc).collect()} == {i: p for i, _, p in rows}


def test_small_payloads_stay_whole(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "b"), (4, "v", "b")], "record long, url string, payload string")
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(pages, arc)
    archives.convert(spark, arc, warc, revisit_from=2)
    assert {r["record"]: r["warc_type"] for r in archives.read_warc(spark, warc).collect()} == {1: "revisit", 2: "response", 3: "response", 4: "response"}


def test_nothing(spark):
    pages = spark.createDataFrame([], "record long, url string, payload string")
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(pages, arc)
    archives.convert(spark, arc, warc)
    assert archives.read_warc(spark, warc).count() == 0


def test_header_lines_follow_their_version():
    one = b"filedesc://a 0.0.0.0 19961104142103 text/plain 76\n1 0 x\n" + b"URL IP-address Archive-date Content-type Archive-length\n".ljust(70, b" ")
    body = b"http://h/a b 10.0.0.1 1997 text/html 3\nabc\n\nhttp://h/c 10.0.0.2 19970203040506 image/gif 2\n\r\n\n"
    records = list(archives.parse_arc(one + body))
    assert [(r.url, r.ip, r.content) for r in records] == [("http://h/a b", "10.0.0.1", b"abc"), ("http://h/c", "10.0.0.2", b"\r\n")]
    assert [archives._timestamp(r.date) for r in records] == ["1997-01-01T00:00:00Z", "1997-02-03T04:05:06Z"]
    assert [r.url for r in archives.parse_arc(gzip.compress(one) + gzip.compress(body))] == [r.url for r in records]
    assert archives.split_http(b"plain") == (b"", b"plain")
    with pytest.raises(ValueError, match="shorter"):
        list(archives.parse_arc(one + b"http://h 1 2 t 9\nabc"))
    with pytest.raises(ValueError, match="version block"):
        list(archives.parse_arc(b"http://h 1 2 t 3\nabc\n"))


def test_source_reads_members_and_plain_bytes_alike():
    rng = random.Random(1)
    lines = [bytes(rng.choices(b"ab\r", k=rng.randrange(2000))) for _ in range(900)]
    whole = b"\n".join(lines) + b"\n"
    for data in (whole, gzip.compress(whole), b"".join(gzip.compress(line + b"\n") for line in lines)):
        source = archives.Source(data)
        assert [source.line() for _ in lines] == lines and source.line() is None
