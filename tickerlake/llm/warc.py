"""WARC archives with segmented records, written and read back.

Writing.  Each page becomes a ``response`` record whose block is an HTTP
message in chunked transfer framing.  Pages with an equal payload of at least
``revisit_bytes`` bytes become ``revisit`` records of the page with the
smallest id among them.  A block longer than ``segment_bytes`` is cut: the
first segment keeps the record's type and number 1, the others are
``continuation`` records that name the origin record and their number, the
last also the total length.  Spark's text writer puts the records, ended by
two line breaks as the format asks, into gzip-compressed ``.warc`` text files.

Reading.  Each archive is parsed as a stream by Content-Length.  Whole records
are decoded on the spot; segments are grouped by their origin, ordered by
number, checked for gaps and total length, joined, and then decoded.  Only
segments are shuffled.  ``complete`` is false, and the payload null, where a
segment lacks, the total length differs, the framing is broken or the payload
does not have the digest that its record states.

The copies of one payload may be a third of all rows: they are found by an
aggregation that combines before the shuffle, and joined back on digest and a
salt.  A group of segments is one record, so it is as large as one page.

Defined results: a null html is an empty payload, a null url leaves the target
header out; a null page_id is never referred to; where the smallest page_id of
a group is repeated, each of its rows is a response; very long pages are cut
into as many segments as needed; empty tables give no archive and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import map_rows, stored, utf8

SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
REVISIT_BYTES = 100
RECORDS_PER_FILE = 20_000
SALTS = 16
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    out = io.BytesIO()
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out.write(b"%x\r\n" % len(part) + part + b"\r\n")
    out.write(b"0\r\n\r\n")
    return out.getvalue()


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken or cut short."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            n = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        at = line + 2
        if n == 0:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            return None
        out.append(body[at:at + n])
        at += n + 2


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without its closing line breaks."""
    lines = [b"WARC/1.1", b"WARC-Type: " + kind.encode()]
    lines += [f"{k}: {v}".encode("utf-8", "replace") for k, v in headers]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block])


def _clean(value: str) -> str:
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def page_records(row: tuple, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page: (row_key, page_id, url, html, refers_to, revisit)."""
    row_key, page_id, url, html, refers_to, revisit = row
    payload = utf8(html)
    rid = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(row_key))}>"
    named = [("WARC-Record-ID", rid), ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        named.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        named.append(("X-Page-Id", str(page_id)))
    named.append(("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        named += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
        yield record("revisit", named, head + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield record("response", named, block)
        return
    starts = range(0, len(block), segment_bytes)
    for number, at in enumerate(starts, 1):
        part = block[at:at + segment_bytes]
        if number == 1:
            yield record("response", [*named, ("WARC-Segment-Number", "1")], part)
            continue
        own = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{row_key}/{number}')}>"),
               ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", str(number))]
        if number == len(starts):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record("continuation", own, part)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   revisit_bytes: int = REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write every row of ``pages`` (page_id, url, html) to archives below ``path``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size"))
    copies = rows.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    salted = copies.select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keyed = rows.withColumn("row_key", F.monotonically_increasing_id())
    keyed = keyed.withColumn("salt", F.pmod(F.col("row_key"), F.lit(SALTS)).cast("int"))
    marked = keyed.join(salted, ["digest", "salt"], "left").select(
        "row_key", "page_id", "url", "html", "refers_to",
        (F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).alias("revisit"))

    def make():
        def run(batch):
            for row in batch:
                for r in page_records(row, segment_bytes, chunk_bytes):
                    yield (r,)
        return run

    records = map_rows(marked, make, "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(path)


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open archive."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        headers = {"version": line.strip().decode()}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("an archive ends within a record")
        yield headers, block


PAYLOAD = ("page_id string, url string, record_type string, refers_to string, payload binary, "
           "payload_bytes long, payload_digest string, complete boolean")


def _decoded(headers: dict[str, str], block: bytes) -> tuple:
    """A PAYLOAD row of a whole record."""
    head, _, body = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    stated = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    page = headers.get("x-page-id"), headers.get("warc-target-uri"), headers["warc-type"], headers.get("x-refers-to-page-id")
    if headers["warc-type"] == "revisit":
        return *page, None, int(http["content-length"]), stated, True
    payload = unchunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
    if payload is None or hashlib.sha256(payload).hexdigest() != stated:
        return *page, None, None, stated, False
    return *page, payload, len(payload), stated, True


def reassembled(segments: list[tuple[int, int | None, dict | None, bytes]]) -> tuple[dict | None, bytes | None]:
    """(headers of the origin, block) from (number, total length, headers, block) in any order; block None if incomplete."""
    ordered = sorted(segments, key=lambda s: s[0])
    headers = next((s[2] for s in ordered if s[2]), None)
    block = b"".join(s[3] for s in ordered)
    whole = [s[0] for s in ordered] == list(range(1, len(ordered) + 1)) and ordered[-1][1] == len(block)
    return headers, block if whole and headers else None


def _join_segments(rows: pd.DataFrame, with_payload: bool) -> pd.DataFrame:
    segments = [(int(n), None if pd.isna(t) else int(t), dict(h) if h is not None else None, bytes(b))
                for n, t, h, b in zip(rows["number"], rows["total"], rows["headers"], rows["block"], strict=True)]
    headers, block = reassembled(segments)
    if block is None:
        headers = headers or {}
        row = (headers.get("x-page-id"), headers.get("warc-target-uri"), headers.get("warc-type"), headers.get("x-refers-to-page-id"),
               None, None, headers.get("warc-payload-digest", "").removeprefix("sha256:"), False)
    else:
        row = _decoded(headers, block)
        row = row if with_payload else (*row[:4], None, *row[5:])
    return pd.DataFrame([row], columns=[c.split()[0] for c in PAYLOAD.split(", ")]).astype({"payload_bytes": "Int64"})


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per page record of the archives: the columns of PAYLOAD (payload null unless asked for)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    part = "origin string, number long, total long, headers map<string,string>, block binary"

    def make():
        def run(batch):
            for (content,) in batch:
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 18)):
                    number = headers.get("warc-segment-number")
                    if number is None:
                        row = _decoded(headers, block)
                        yield *(row if with_payload else (*row[:4], None, *row[5:])), None, None, None, None, None
                        continue
                    origin = headers.get("warc-segment-origin-id") or headers["warc-record-id"]
                    total = headers.get("warc-segment-total-length")
                    yield (*[None] * 8, origin, int(number), int(total) if total else None,
                           list(headers.items()) if number == "1" else None, block)
        return run

    parsed = stored(map_rows(files, make, f"{PAYLOAD}, {part}"), "warc-records")
    names = [c.split()[0] for c in PAYLOAD.split(", ")]
    whole = parsed.where("origin is null").select(*names)
    joined = parsed.where("origin is not null").groupBy("origin").applyInPandas(
        lambda rows: _join_segments(rows, with_payload), PAYLOAD)
    return whole.unionByName(joined)
