import hashlib
import zlib

import pytest
from pyspark.sql import types as T

from fathom.llm import arc_warc as a
from fathom.llm.stored import scratch
from tests.llm.fixtures import prose, with_clashes

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType())])
TRICKY = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nfiledesc://x 0.0.0.0 1 text/plain 3\n</p>" + "é😀" * 40


def pages():
    long = prose(60, 1)
    return [(1, "http://a/é b?q=1#x", long), (2, "http://b/", long), (3, None, None), (4, "http://c/", ""),
            (5, "http://d/", "short"), (6, "http://e/", "short"), (7, "http://f/", TRICKY), (8, "http://g/", TRICKY),
            (8, "http://g/", TRICKY), (None, "http://h/", long), (9, "http://i/", "x" * 99), (10, "http://i/", "x" * 99),
            (11, "http://j/", "y" * 100), (12, "http://j/", "y" * 100), (13, "http://k/", prose(200_000, 2))]


def brute(rows):
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    out = []
    for body, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for j, i in enumerate(ids):
            revisit = j > 0 and len(body) >= 100
            out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                        ids[0] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("salts", [1, 16])
def test_conversion_equals_brute_force(spark, salts):
    df = with_clashes(spark.createDataFrame(pages(), PAGES).repartition(3), "digest", "salt", "segment")
    got = a.convert(spark, df, salts=salts).drop("record_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(pages())


def test_small_segments_and_both_versions(spark):
    path = a.write_arc(spark.createDataFrame(pages(), PAGES).coalesce(1), scratch(spark, "arc"), segment_bytes=500)
    recs = a.read_arc(spark, path).collect()
    assert sorted(r.payload_bytes for r in recs) == sorted(len((h or "").encode()) for _, _, h in pages())
    assert len({r.record_id for r in recs}) == len(recs) and {r.date for r in recs} == {"2024-01-01T00:00:00Z"}
    again = a.read_arc(spark, path).collect()
    assert sorted(r.record_id for r in again) == sorted(r.record_id for r in recs)


def test_parsers_of_handwritten_archives():
    v1 = (b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 Alexa\n"
          b"URL IP-address Archive-date Content-type Archive-length\n\n")
    v1 = v1.replace(b" 76\n", b" %d\n" % (len(v1) - v1.index(b"\n") - 1))
    body = b"HTTP/1.0 200 OK\r\nContent-type: text/html\r\n\r\n<html>\n\nhi</html>"
    v1 += b"\nhttp://x.org/a b 1.2.3.4 19970417175710 text/html %d\n" % len(body) + body
    v1 += b"\n\nhttp://x.org/c 1.2.3.4 1997 image/gif 3\nGIF\n"
    v2 = a.arc_version_block("new", 2, "20000101000000")
    v2 += b"\n" + a.arc_record(5, "http://y/", b"hey", "new", 2, "20000101000000", len(v2) + 1)
    recs = [a.converted(r) for r in a.parse_arc(v1 + b"\n" + v2)]
    assert [(r["url"], r["type"], r["payload"], r["date"], r["page_id"]) for r in recs] == [
        ("http://x.org/a b", "response", b"<html>\n\nhi</html>", "1997-04-17T17:57:10Z", None),
        ("http://x.org/c", "resource", b"GIF", "1997-01-01T00:00:00Z", None),
        ("http://y/", "response", b"hey", "2000-01-01T00:00:00Z", 5)]
    warc = b"\r\n\r\n".join([a.warcinfo("w"), *(a.warc_of(r, None) for r in recs), a.warc_of(recs[0], "urn:uuid:1")])
    heads = [h for h, _ in a.parse_warc(warc)]
    assert [h["WARC-Type"] for h in heads] == ["warcinfo", "response", "resource", "response", "revisit"]
    assert heads[1]["WARC-IP-Address"] == "1.2.3.4" and heads[4]["WARC-Refers-To"] == "<urn:uuid:1>"
    cut = list(a.parse_arc(v1[:-3]))
    assert cut[-1]["block"] == b"G" or cut[-1]["block"] == b"GI"
    assert a._inflated(zlib.compress(b"x", wbits=31)) == b"x" == a._inflated(b"x")


def test_empty_table(spark):
    assert a.convert(spark, spark.createDataFrame([], PAGES)).count() == 0
