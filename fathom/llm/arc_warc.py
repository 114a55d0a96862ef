"""Legacy web archives (ARC) converted to WARC.

``write_arc`` stores pages as ARC files, ``read_arc`` parses them by the field
list of each file's version block and by the declared lengths, ``write_warc``
synthesises the WARC form of every record and ``read_warc`` reads that back:

* version 1 lines hold URL, IP address, date, type and length; version 2 lines
  also result code, checksum, location, offset and file name;
* the record id is a UUID made from the archive's own name and the record's
  offset, so a second reading or a retried task gives the same id;
* the 14-digit date becomes an ISO date, an HTTP block becomes a ``response``
  (anything else a ``resource``), digests are SHA-256 of block and payload;
* of records with equal payloads of ``MIN_REVISIT`` bytes or more the one with
  the smallest (page id, record id) stays a response and the others become
  ``revisit`` records, which hold the HTTP head only.

Archives are written in segments (``SEGMENT_BYTES``), a few to a file, by
Spark's text writer into the shared checkpoint folder, so a row never holds
more than a segment and one page.  The full payload is shuffled once, deflated,
to meet the decision on its digest; that join is salted.

Defined results: null html is an empty payload; null url is written as
``unknown:``; null page id is left out of the archive and read as null; equal
rows are separate records; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.registry import query, table
from fathom.llm.stored import scratch

SEGMENT_BYTES = 4 << 20
SEGMENTS_PER_FILE = 4
MIN_REVISIT = 100
SALTS = 16
GZIP_LEVEL = "BEST_SPEED"
CAPTURED = "20240101000000"   # pages carry no date of their own

# Field lists of the two versions (fixed values of the format).
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- ARC ---------------------------------------------------------------

def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} {'0' if version == 1 else '1'} pages\n{' '.join(FIELDS[version])}\n".encode()
    given = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
             "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name,
             "Archive-length": str(len(body))}
    return " ".join(given[f] for f in FIELDS[version]).encode() + b"\n" + body


def arc_record(page_id, url, html: bytes, name: str, version: int, date: str, offset: int) -> bytes:
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(html))
    head += "" if page_id is None else f"\r\nX-Page-Id: {page_id}"
    block = head.encode() + b"\r\n\r\n" + html
    given = {"URL": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "unknown:", "IP-address": "0.0.0.0",
             "Archive-date": date, "Content-type": "text/html", "Result-code": "200", "Checksum": "-",
             "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(block))}
    return " ".join(given[f] for f in FIELDS[version]).encode() + b"\n" + block


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC file: the fields of its lines plus block, archive and offset.

    The fields of a line are those that the last version block named.  A block
    shorter than its declared length (a cut file) is given as far as it goes.
    """
    fields, name, base, at = FIELDS[1], "", 0, 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if line[0].startswith("filedesc://"):
            name, base = line[0][len("filedesc://"):], at
            length = int(line[-1])
            block = data[end + 1:end + 1 + length]
            listed = block.split(b"\n")[1].decode().split() if block.count(b"\n") else []
            fields = tuple(listed) if listed and listed[-1] == "Archive-length" else FIELDS[1]
        else:
            length = int(line[-1])
            # a URL may hold spaces in old archives: the other fields are counted from the right
            n = len(fields) - 1
            values = [" ".join(line[:-n]), *line[-n:]]
            yield dict(zip(fields, values)) | {"block": data[end + 1:end + 1 + length], "archive": name,
                                               "offset": at - base}
        at = end + 1 + length


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """HTTP head (with its blank line) and body, or None if the block is no response."""
    if not block.startswith(b"HTTP/"):
        return None
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def header_value(head: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m else None


def _integer(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def converted(arc: dict) -> dict:
    """What the WARC form of an ARC record holds."""
    parts = http_parts(arc["block"])
    head, payload = parts if parts else (b"", arc["block"])
    d = arc.get("Archive-date", "")
    d = (d + "00000101000000"[len(d):])[:14] if d.isdigit() else CAPTURED
    seed = hashlib.sha256(f"{arc['archive']}\n{arc['offset']}".encode()).digest()
    return {"record_id": f"urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}", "url": arc["URL"],
            "ip": arc.get("IP-address"), "mime": arc.get("Content-type"),
            "date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
            "type": "response" if parts else "resource", "head": head, "payload": payload,
            "page_id": _integer(header_value(head, b"X-Page-Id")),
            "digest": hashlib.sha256(payload).hexdigest()}


# ---- WARC --------------------------------------------------------------

def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def warcinfo(name: str) -> bytes:
    seed = hashlib.sha256(name.encode()).digest()
    return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>"),
                        ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                       b"format: WARC File Format 1.1\r\n")


def warc_of(rec: dict, refers_to: str | None) -> bytes:
    kind = "revisit" if refers_to else rec["type"]
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{rec['record_id']}>"), ("WARC-Date", rec["date"]),
               ("WARC-Target-URI", rec["url"]), ("WARC-Payload-Digest", "sha256:" + rec["digest"])]
    if rec["ip"] not in (None, "", "-", "0.0.0.0"):
        headers.append(("WARC-IP-Address", rec["ip"]))
    if refers_to:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    headers.append(("Content-Type", "application/http; msgtype=response" if rec["type"] == "response" else rec["mime"]))
    return warc_record(headers, rec["head"] if refers_to else rec["head"] + rec["payload"])


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, blocks by their declared length."""
    at = 0
    while True:
        while at < len(data) and data[at] in b"\r\n":
            at += 1
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not at a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        length = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + length]
        at = end + 4 + length


# ---- Spark jobs --------------------------------------------------------

def _inflated(content: bytes) -> bytes:
    return zlib.decompress(content, 31) if content[:2] == b"\x1f\x8b" else content


def _segments(records: Iterator[bytes], opening, name: str, sep: bytes, limit: int) -> Iterator[pa.RecordBatch]:
    """Records joined to segments of about ``limit`` bytes, each opened by its own first record."""
    number, parts, size = 0, [], 0

    def done():
        return pa.RecordBatch.from_arrays([pa.array([sep.join(parts)], pa.large_binary())], names=["segment"])

    for make in records:
        if not parts:
            own = f"{name}-{number:05d}"
            number += 1
            parts = [opening(own)]
            size = len(parts[0])
        rec = make(own, size + len(sep))
        parts.append(rec)
        size += len(rec) + len(sep)
        if size >= limit:
            yield done()
            parts = []
    if parts:
        yield done()


def _save(segments: DataFrame, path: str, sep: str) -> str:
    (segments.select(F.col("segment").cast("string").alias("value")).write
     .option("lineSep", sep).option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL)
     .option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path))
    return path


def _rows(batches, names) -> Iterator[tuple]:
    for b in batches:
        cols = [b.column(b.schema.get_field_index(n)) for n in names]
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in cols)


def write_arc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, captured: str = CAPTURED) -> str:
    """ARC files of pages (page_id, url, html); segments alternate between the two versions."""
    def run(batches):
        part = TaskContext.get().partitionId()
        version = lambda own: 1 + int(own[-5:]) % 2
        opening = lambda own: arc_version_block(own, version(own), captured)
        makers = ((lambda own, at, p=p: arc_record(p[0], p[1], p[2] or b"", own, version(own), captured, at))
                  for p in _rows(batches, ["page_id", "url", "html"]))
        yield from _segments(makers, opening, f"pages-{part:06d}", b"\n", segment_bytes)

    made = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.encode(F.col("html"), "UTF-8").alias("html")).mapInArrow(run, "segment binary")
    return _save(made, path, "\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _arc_records(batches) -> Iterator[dict]:
    for (content,) in _rows(batches, ["content"]):
        for arc in parse_arc(_inflated(content)):
            yield converted(arc)


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 100 + sum(len(x) for x in r if isinstance(x, (bytes, str)))
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """What is known of each ARC record, without its payload."""
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("date", pa.string()), ("type", pa.string()), ("payload_bytes", pa.int64()),
                        ("digest", pa.string())])

    def run(batches):
        yield from _batched(((r["record_id"], r["page_id"], r["url"], r["date"], r["type"], len(r["payload"]),
                              r["digest"]) for r in _arc_records(batches)), schema)

    return _files(spark, path).mapInArrow(
        run, "record_id string, page_id long, url string, date string, type string, payload_bytes long, digest string")


def revisits(records: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """digest, first: the record that stays, for each payload that occurs more than once."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    return (records.filter((F.col("payload_bytes") >= min_bytes) & (F.col("type") == "response"))
            .groupBy("digest").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("digest", F.col("m.record_id").alias("first")))


def write_warc(spark: SparkSession, arc_path: str, path: str, min_bytes: int = MIN_REVISIT, salts: int = SALTS,
               segment_bytes: int = SEGMENT_BYTES) -> str:
    """WARC files of the records in ARC files."""
    full = pa.schema([("record_id", pa.string()), ("digest", pa.string()), ("salt", pa.int32()), ("z", pa.binary())])

    def unpack(batches):
        for r in _arc_records(batches):
            raw = "\n".join([r["url"], r["ip"] or "", r["mime"] or "", r["date"], r["type"], str(len(r["head"]))])
            yield (r["record_id"], r["digest"], zlib.crc32(r["record_id"].encode()) % salts,
                   zlib.compress(raw.encode() + b"\n" + r["head"] + r["payload"], 1))

    def pack(batches):
        def records():
            for record_id, digest, z, first in _rows(batches, ["record_id", "digest", "z", "first"]):
                url, ip, mime, date, kind, n, body = zlib.decompress(z).split(b"\n", 6)
                rec = {"record_id": record_id, "digest": digest, "url": url.decode(), "ip": ip.decode(),
                       "mime": mime.decode(), "date": date.decode(), "type": kind.decode(),
                       "head": body[:int(n)], "payload": body[int(n):]}
                made = warc_of(rec, first if first and first != record_id else None)
                yield lambda own, at, made=made: made

        yield from _segments(records(), warcinfo, f"pages-{TaskContext.get().partitionId():06d}", b"\r\n\r\n",
                             segment_bytes)

    chosen = revisits(read_arc(spark, arc_path), min_bytes).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    records = _files(spark, arc_path).mapInArrow(lambda b: _batched(unpack(b), full),
                                                 "record_id string, digest string, salt int, z binary")
    made = records.join(chosen, ["digest", "salt"], "left").select("record_id", "digest", "z", "first")
    return _save(made.mapInArrow(pack, "segment binary"), path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, page_id, type, payload_bytes, digest, refers_to_id of each record; digests of bodies are checked."""
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string())])

    def rows(batches):
        for (content,) in _rows(batches, ["content"]):
            for headers, block in parse_warc(_inflated(content)):
                kind = headers["WARC-Type"]
                if kind == "warcinfo":
                    continue
                head, payload = http_parts(block) or (b"", block)
                said = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "revisit":
                    n = _integer(header_value(head, b"Content-Length"))
                else:
                    n = len(payload)
                    if hashlib.sha256(payload).hexdigest() != said:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
                yield (headers["WARC-Record-ID"].strip("<>"), _integer(header_value(head, b"X-Page-Id")), kind, n, said,
                       headers["WARC-Refers-To"].strip("<>") if kind == "revisit" else None)

    return _files(spark, path).mapInArrow(
        lambda b: _batched(rows(b), schema),
        "record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to_id string")


def convert(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT, salts: int = SALTS) -> DataFrame:
    """Pages to ARC, ARC to WARC, and what the WARC files hold; refers_to is the response's page id."""
    arc = write_arc(pages, scratch(spark, "arc"))
    back = read_warc(spark, write_warc(spark, arc, scratch(spark, "warc"), min_bytes, salts))
    cited = back.filter("record_type = 'revisit'").groupBy(F.col("refers_to_id").alias("record_id")).count()
    named = (back.filter("record_type <> 'revisit'").join(cited, "record_id", "left_semi")
             .select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    out = back.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(salts)).cast("int"))
    return out.join(named, ["refers_to_id", "salt"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op6_arc_to_warc", SQL)
def op6_arc_to_warc(spark, sf_dir):
    return convert(spark, table(spark, sf_dir, "pages")).drop("record_id")
