"""ARC files, versions 1 and 2, to WARC files: header lines and declared lengths in, equivalent WARC records out.

Files go through Spark's text source, whose line separator is the end of a record of the format in hand, so they are
plain archives in any store that Spark writes to, compressed file by file. They are read back as whole files of bounded
size and cut by declared lengths, never by separators.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.session import hot_lookup, stage

ARC_END, WARC_END = "\n", "\r\n\r\n"
DATE = "20240101000000"
SAFE_URL = "!#$%&'()*+,-./:;=?@[]_~"
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH = 256
# Payload bytes of a converted file.
FILE_BYTES = 64 << 20


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _http(record: int | None, payload: bytes) -> bytes:
    number = "" if record is None else f"X-Record-Number: {record}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def _version_block(version: int) -> bytes:
    body = f"{version} 0 converter\n{V1_FIELDS if version == 1 else V2_FIELDS}\n".encode()
    fields = f"filedesc://pages.arc 0.0.0.0 {DATE} text/plain"
    rest = "" if version == 1 else " 200 - - 0 pages.arc"
    return f"{fields}{rest} {len(body)}\n".encode() + body


def arc_records(versions: tuple[int, ...]):
    """Rows ``(record, url, payload)`` as ARC records, a version block before the first of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = versions[TaskContext.get().partitionId() % len(versions)]
        lines = [_version_block(version)]
        for batch in batches:
            for record, url, payload in zip(*(batch.column(c).to_pylist() for c in ("record", "url", "payload"))):
                content = _http(record, payload or b"")
                address = quote(url or "unknown:", safe=SAFE_URL)
                if version == 1:
                    head = f"{address} 0.0.0.0 {DATE} text/html {len(content)}\n"
                else:
                    head = f"{address} 0.0.0.0 {DATE} text/html 200 {hashlib.md5(content).hexdigest()} - 0 pages.arc {len(content)}\n"
                lines.append(head.encode() + content)
                if len(lines) >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])
                    lines = []
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])

    return run


def _write(records: DataFrame, path: str, end: str) -> None:
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, path: str, versions: tuple[int, ...] = (1, 2)) -> None:
    """``pages(record, url, payload)`` as ARC files, one a partition, by turns in the given versions.

    Null payloads are empty, a null url is written as ``unknown:``, a null record number is left out.
    """
    if not versions or not {*versions} <= {1, 2}:
        raise ValueError("ARC versions are 1 and 2")
    rows = pages.select(F.col("record").cast("long").alias("record"), "url", F.col("payload").cast("binary").alias("payload"))
    _write(rows.mapInArrow(arc_records(versions), "value binary"), path, ARC_END)


class Source:
    """Bytes of a plain or gzip file, inflated as they are asked for."""

    def __init__(self, data: bytes):
        self.rest, self.ready, self.at = memoryview(data), bytearray(), 0
        self.inflate = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def more(self) -> bool:
        if self.at > 1 << 20:
            del self.ready[: self.at]
            self.at = 0
        if not self.rest:
            return False
        if self.inflate is None:
            self.ready += self.rest
            self.rest = self.rest[:0]
            return True
        self.ready += self.inflate.decompress(self.rest[: 1 << 18])
        unused = len(self.inflate.unused_data)
        self.rest = self.rest[min(1 << 18, len(self.rest)) - unused :]
        if self.inflate.eof:  # another member may follow
            self.inflate = zlib.decompressobj(31)
        return True

    def line(self) -> bytes | None:
        """Up to and without the next line feed; None at the end of the file."""
        start = self.at
        while (end := self.ready.find(b"\n", start)) < 0:
            seen = len(self.ready) - self.at
            if not self.more():
                return None
            start = self.at + seen
        out = bytes(self.ready[self.at : end])
        self.at = end + 1
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) - self.at < n and self.more():
            pass
        if len(self.ready) - self.at < n:
            raise ValueError("a record is shorter than it declares")
        out = bytes(self.ready[self.at : self.at + n])
        self.at += n
        return out


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    kind: str
    content: bytes


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, without its version block; the block's field line rules how header lines are read."""
    source, fields = Source(data), None
    while (line := source.line()) is not None:
        line = line.rstrip(b"\r")
        if not line:
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        if line.startswith(b"filedesc://"):
            block = source.take(int(parts[-1])).decode("utf-8", "replace").split("\n")
            version = block[0].split(" ")[0]
            fields = block[1].split(" ") if len(block) > 1 and block[1] else {"1": V1_FIELDS, "2": V2_FIELDS}[version].split(" ")
            continue
        if fields is None:
            raise ValueError("no version block")
        extra = len(parts) - len(fields)  # blanks in an old URL
        if extra < 0:
            raise ValueError(f"a header line has {len(parts)} of {len(fields)} fields")
        row = dict(zip(fields, [" ".join(parts[: extra + 1]), *parts[extra + 1 :]]))
        yield ArcRecord(row["URL"], row["IP-address"], row["Archive-date"], row["Content-type"], source.take(int(row["Archive-length"])))


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Head with its blank line, and payload; content that is no HTTP message is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, blank, payload = content.partition(b"\r\n\r\n")
    return head + blank, payload


def _record_number(head: bytes) -> int | None:
    found = re.search(rb"(?im)^X-Record-Number: (-?[0-9]+)\r?$", head)
    return int(found[1]) if found else None


def _timestamp(date: str) -> str:
    d = (re.sub("[^0-9]", "", date) + "00000101000000"[len(re.sub("[^0-9]", "", date)) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc_id(place: str) -> str:
    """Identifier of the record at a place, ``file#number`` of the archive that it is converted from; no two are alike."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"


def _read_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.int64()]
    names = ["record", "place", "url", "ip", "date", "kind", "head", "payload", "digest", "same", "size"]
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, file = [], path.rstrip("/").rsplit("/", 1)[-1]
            for k, r in enumerate(parse_arc(data.as_py())):
                head, payload = split_http(r.content)
                same = hashlib.sha256(payload).digest()
                rows.append((_record_number(head), f"{file}#{k}", r.url, r.ip, r.date, r.kind, head, payload, sha1_base32(payload), same, len(payload)))
                if len(rows) >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_arc(spark, path: str) -> DataFrame:
    """``(record, place, url, ip, date, kind, head, payload, digest, same, size)`` for each record of the ARC files in a folder."""
    schema = "record long, place string, url string, ip string, date string, kind string, head binary, payload binary, digest string, same binary, size long"
    return _files(spark, path).mapInArrow(_read_arc, schema)


def _payloads(packed: bool):
    """Payloads packed, or unpacked again: what a shuffle carries is text that packs well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = zstandard.ZstdCompressor(level=1).compress if packed else zstandard.ZstdDecompressor().decompress
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            payloads = [change(p.as_buffer()) for p in batch.column("payload")]
            yield batch.set_column(at, "payload", pa.array(payloads, pa.binary()))

    return run


def _warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ("place", "url", "ip", "date", "kind", "head", "payload", "digest", "first", "first_place", "first_url", "first_date")
    for batch in batches:
        lines = []
        for place, url, ip, date, kind, head, payload, digest, first, first_place, first_url, first_date in zip(*(batch.column(c).to_pylist() for c in columns)):
            fields = [
                f"WARC-Record-ID: {_warc_id(place)}",
                f"WARC-Date: {_timestamp(date)}",
                f"WARC-Target-URI: {url}",
                f"WARC-IP-Address: {ip}",
                f"WARC-Payload-Digest: sha1:{digest}",
            ]
            if first is None:
                kind_of, block = ("response" if head else "resource"), head + payload
            else:
                kind_of, block = "revisit", head
                fields += [
                    f"WARC-Profile: {REVISIT_PROFILE}",
                    f"WARC-Refers-To: {_warc_id(first_place)}",
                    f"WARC-Refers-To-Target-URI: {first_url}",
                    f"WARC-Refers-To-Date: {_timestamp(first_date)}",
                ]
            fields += [
                f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
                f"Content-Type: {'application/http; msgtype=response' if head else kind}",
                f"Content-Length: {len(block)}",
            ]
            lines.append(f"WARC/1.1\r\nWARC-Type: {kind_of}\r\n".encode() + "\r\n".join(fields).encode() + b"\r\n\r\n" + block)
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])


def convert(spark, arc_path: str, warc_path: str, revisit_from: int = 0) -> None:
    """WARC files with a record for each record of the ARC files.

    Of records with equal payloads of at least ``revisit_from`` bytes, that with the largest record number keeps its
    payload; the others become revisits of it. A repeated record is kept each time, and revisits point to one of these.
    Records without a number never become or receive a revisit. Files hold about FILE_BYTES of payloads each, however many
    there are, so that each can be read as one value.
    """
    records = read_arc(spark, arc_path)
    # Decisions need no payload: numbers and digests are read first, payloads once, when they are written.
    slim = stage(records.where("record is not null").select("record", "place", "url", "date", "same", "size"), "arc-records")
    newest = slim.where(F.col("size") >= revisit_from).groupBy("same").agg(F.max(F.struct("record", "place", "url", "date")).alias("kept"), F.count("*").alias("matches"))
    named = [F.col("kept.record").alias("first"), *(F.col(f"kept.{c}").alias(f"first_{c}") for c in ("place", "url", "date"))]
    shared = newest.where("matches > 1").select("same", "matches", *named)
    revisits = hot_lookup(slim.select("record", "same"), shared, ["same"], "matches").where("record <> first")
    marks = revisits.dropDuplicates(["record", "same"]).withColumnRenamed("record", "number")
    # Records without a number match nothing; the digest spreads them.
    number = F.coalesce(F.col("record"), F.xxhash64("same", "url", "date"))
    files = 1 + (slim.agg(F.sum("size")).first()[0] or 0) // FILE_BYTES
    moved = records.mapInArrow(_payloads(True), records.schema).withColumn("number", number).repartition(files, "number", "record", "same")
    decided = moved.join(marks.withColumn("record", F.col("number")), ["number", "record", "same"], "left")
    whole = decided.mapInArrow(_payloads(False), decided.schema)
    _write(whole.mapInArrow(_warc_records, "value binary"), warc_path, WARC_END)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, lower-case names, and block of each record of a WARC file."""
    source = Source(data)
    while (line := source.line()) is not None:
        line = line.rstrip(b"\r")
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        fields = {}
        while line := (source.line() or b"").rstrip(b"\r"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, source.take(int(fields["content-length"]))


def _read_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record", "warc_id", "warc_type", "uri", "date", "payload_digest", "refers_to", "payload_bytes", "payload"]
    kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
    for batch in batches:
        for data in batch.column("content"):
            rows = []
            for fields, block in parse_warc(data.as_py()):
                if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
                    raise ValueError(f"{fields['warc-record-id']} does not have the digest it declares")
                head, payload = split_http(block)
                whole = fields["warc-type"] != "revisit"
                declared = re.search(rb"(?im)^Content-Length: ([0-9]+)\r?$", head)
                size = len(payload) if whole else int(declared[1]) if declared else None
                rows.append((
                    _record_number(head), fields["warc-record-id"], fields["warc-type"], fields["warc-target-uri"], fields["warc-date"],
                    fields["warc-payload-digest"].removeprefix("sha1:"), fields.get("warc-refers-to"), size, payload if whole else None,
                ))
                if len(rows) >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_warc(spark, path: str) -> DataFrame:
    """``(record, warc_id, warc_type, uri, date, payload_digest, refers_to, payload_bytes, payload)`` of WARC files."""
    schema = "record long, warc_id string, warc_type string, uri string, date string, payload_digest string, refers_to string, payload_bytes long, payload binary"
    return _files(spark, path).mapInArrow(_read_warc, schema)
