"""WARC archives of pages: written with segmented records and chunked bodies, read back and reassembled.

Archives are written and read by Spark's text source, so they live wherever Spark can read, and
files are split among tasks at records. A reader finds records by their version line. Payloads may
hold anything, the version's text too: the writer ends a chunk inside each occurrence and encodes it in
addresses, so that it never stands in an archive other than at the start of a record, whatever
follows it there.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.texts import scratch, stored

VERSION_TEXT = "WARC/1.1"
VERSION = f"{VERSION_TEXT}\r\n"
# Blocks above this are split into segments, bodies into chunks of at most that.
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
# Equal payloads from this size on are stored once.
REVISIT_BYTES = 1_000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# What a header of the archive holds, by column of the records table. X- headers are our own.
FIELDS = {
    "warc_type": "warc-type", "record_id": "warc-record-id", "uri": "warc-target-uri", "digest": "warc-payload-digest",
    "origin_id": "warc-segment-origin-id", "segment": "warc-segment-number", "total": "warc-segment-total-length",
    "page_id": "x-page-id", "refers_to": "x-refers-to-page-id",
}
NUMBERS = ("segment", "total", "page_id", "refers_to")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer coding; no chunk holds the whole version text."""
    version, parts, at = VERSION_TEXT.encode(), [], 0
    while at < len(payload):
        stop = min(at + size, len(payload))
        found = payload.find(version, at, stop)
        if found >= 0:
            stop = found + 4
        parts += [b"%x\r\n" % (stop - at), payload[at:stop], b"\r\n"]
        at = stop
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if len(parts[-1]) != size or body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        at += 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the empty lines after it, which the text sink writes."""
    lines = [f"{name}: {value}\r\n" for name, value in headers if value is not None]
    return (VERSION + "".join(lines) + f"Content-Length: {len(block)}\r\n\r\n").encode() + block


def _uri(url: str | None) -> str | None:
    """The address without characters that would end a header line, and without the version's text."""
    if url is None:
        return None
    encoded = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
    return encoded.replace(VERSION_TEXT, VERSION_TEXT.replace("/", "%2F"))


def page_records(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, revisit: bool, date: str, segment_bytes: int) -> list[bytes]:
    """The records of a page: a response, with its continuations where it is long, or a revisit."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    record_id = f"<urn:uuid:{uuid.uuid4()}>"
    common = [("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", digest), ("X-Page-ID", page_id)]
    if revisit:
        return [_record([("WARC-Type", "revisit"), *common, ("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", refers_to)], b"")]
    block = HTTP_HEAD + chunked(payload)
    kind = ("Content-Type", "application/http;msgtype=response")
    if len(block) <= segment_bytes:
        return [_record([("WARC-Type", "response"), *common, kind], block)]
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    out = [_record([("WARC-Type", "response"), *common, kind, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], start=2):
        headers = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", record_id),
            ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None),
        ]
        out.append(_record(headers, part))
    return out


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and whether the row revisits another page and which.

    Of rows with equal payloads of REVISIT_BYTES or more, those with the largest page_id are stored
    and the others refer to it. Rows without page_id refer to it too; where no row has one, all are stored.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    sized = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha2(payload, 256).alias("payload_key"), F.octet_length(payload).alias("size"))
    long_ones = sized.filter(F.col("size") >= REVISIT_BYTES)
    copies = long_ones.groupBy(F.col("payload_key").alias("copied_key")).agg(F.max("page_id").alias("stored_id"), F.count("*").alias("n"))
    copies = stored(copies.filter((F.col("n") > 1) & F.col("stored_id").isNotNull()).select("copied_key", "stored_id"), "copied-payloads")
    joined = sized.join(copies, (F.col("payload_key") == F.col("copied_key")) & (F.col("size") >= REVISIT_BYTES), "left")
    revisit = F.col("stored_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stored_id"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("stored_id")).alias("refers_to"), revisit.alias("revisit"))


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Archive the pages under ``path``, one file per task. NULL html is an empty payload."""
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(page_records(*row, date, segment_bytes), pa.binary())], ["record"])

    # Spark strings are bytes: the cast checks nothing, and the sink writes them as they are.
    lines = with_revisits(pages).mapInArrow(records, "record binary").select(F.col("record").cast("string"))
    lines.write.option("lineSep", "\r\n\r\n").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path``: the headers in FIELDS, and ``block``.

    A record whose block has another length than its header says raises.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(0).to_pylist():
                head, _, rest = raw.partition(b"\r\n\r\n")
                lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))
                headers = {name.strip().lower(): value.strip() for name, _, value in lines}
                length = int(headers["content-length"])
                if rest[length:].strip(b"\r\n"):
                    raise ValueError(f"record {headers.get('warc-record-id')} is longer than its header says")
                if len(rest) < length:
                    raise ValueError(f"record {headers.get('warc-record-id')} is shorter than its header says")
                values = {c: headers.get(h) for c, h in FIELDS.items()}
                rows.append({**values, **{c: None if values[c] is None else int(values[c]) for c in NUMBERS}, "block": rest[:length]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = {c: "long" if c in NUMBERS else "string" for c in FIELDS} | {"block": "binary"}
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c, arrow[k]) for c, k in kinds.items()])
    raw = spark.read.option("lineSep", VERSION).text(path).filter(F.octet_length("value") > 0)
    return raw.select(F.col("value").cast("binary")).mapInArrow(parse, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def reassembled(records: DataFrame) -> DataFrame:
    """Responses with their whole block; segments are grouped by the record they continue.

    A missing segment, or a total that differs from the length announced, raises. A group holds the
    segments of one record.
    """
    kept = ("record_id", "uri", "digest", "page_id")
    whole = records.filter((F.col("warc_type") == "response") & F.col("segment").isNull()).select(*kept, F.array(F.struct(F.lit(1).cast("long").alias("segment"), F.octet_length("block").cast("long").alias("total"), "block")).alias("parts"))
    segments = records.filter(F.col("segment").isNotNull())
    origin = F.coalesce("origin_id", "record_id")
    grouped = segments.groupBy(origin.alias("origin")).agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in kept], F.array_sort(F.collect_list(F.struct("segment", "total", "block"))).alias("parts")
    )
    return whole.unionByName(grouped.drop("origin"))


def payloads(responses: DataFrame) -> DataFrame:
    """Responses with their decoded ``payload``, checked against the digest in the archive."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, uri, digest, record_id, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                    raise ValueError(f"segments of {record_id} are missing or repeated")
                block = b"".join(p["block"] for p in parts)
                if len(block) != parts[-1]["total"]:
                    raise ValueError(f"{record_id} has {len(block)} bytes, announced were {parts[-1]['total']}")
                head, _, body = block.partition(b"\r\n\r\n")
                payload = dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body
                sha1 = hashlib.sha1(payload).digest()
                if digest != "sha1:" + base64.b32encode(sha1).decode():
                    raise ValueError(f"the payload of {record_id} is not the one of its digest")
                out.append((page_id, uri, digest, payload, sha1.hex()))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page_id", "uri", "digest", "payload", "sha1"])

    types = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string())
    rows = responses.select("page_id", "uri", "digest", "record_id", "parts")
    return rows.mapInArrow(decode, "page_id long, uri string, digest string, payload binary, sha1 string")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page, from the archive alone: what it held and where its payload is stored.

    Equal rows are archived and returned each. An archive without records has no rows.

    A revisit takes size and digest from the response that it refers to.
    """
    records = read_warc(spark, path)
    decoded = payloads(reassembled(records)).select("page_id", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("sha1").alias("payload_digest"))
    responses = stored(decoded, "responses")
    revisits = records.filter(F.col("warc_type") == "revisit").select("page_id", F.col("refers_to"), F.col("digest").alias("own_digest"))
    # A page that was archived twice has two equal responses; either serves.
    targets = stored(responses.select(F.col("page_id").alias("target_id"), "digest", "payload_bytes", "payload_digest").distinct(), "revisited")
    found = revisits.join(targets, (F.col("refers_to") == F.col("target_id")) & (F.col("own_digest") == F.col("digest")))
    columns = ("page_id", "payload_bytes", "payload_digest")
    return responses.select(*columns, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        found.select(*columns, F.lit("revisit").alias("record_type"), "refers_to")
    )


def archive_and_read(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages to a new archive in the shared folder and read it back.

    NULL html is an empty payload, NULL addresses are left out, and a row without page_id keeps none.
    Any text can be payload or address. Of equal payloads the row with the largest page_id is stored;
    repeated rows with that id are stored each. No pages, no rows.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_warc(pages, path, segment_bytes)
    return archived_pages(spark, path)
