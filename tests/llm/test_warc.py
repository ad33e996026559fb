"""ARC parsing by version, conversion, and the round trip through archives."""

import base64
import hashlib
import zlib
from collections import defaultdict

from martlet.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string, offset long"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows):
    top = defaultdict(lambda: None)
    for k, _, h in rows:
        if k is not None:
            top[h or ""] = max(k, top[h or ""] if top[h or ""] is not None else k)
    out = []
    for k, _, h in rows:
        first = top[h or ""]
        revisit = first is not None and first != k
        out.append((k, len((h or "").encode()), digest(h), "revisit" if revisit else "response", first if revisit else None))
    return out


def corpus():
    rows = [(i, f"http://x.example/{i}?q=a b", f"<p>{i % 7} é\r\n\r\nWARC/1.1\r\n filedesc://{i % 7}</p>") for i in range(40)]
    return rows + [(100, None, None), (101, "", ""), (None, "http://n /\n", "<p>0"), (None, "u", None), (39, "http://again", rows[39][2]),
                   (102, "http://long/", "z" * 3_000_000), (103, "http://x 5 9", "http://a 0.0.0.0 20200101000000 text/html 5\nhello\n")]


def test_round_trip(spark):
    rows = corpus()
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    got = warc.archive_pages(pages).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r["digests_match"] for r in got) and len({r["record_id"] for r in got}) == len(rows)
    assert {r["warc_date"] for r in got} == {"2020-01-01T00:00:00Z"}


def test_empty_table_and_minimum_size(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.archive_pages(pages).collect() == []
    same = spark.createDataFrame([(1, "a", "xy", "r", 1), (2, "b", "xy", "r", 1)], SCHEMA)
    assert {r["record_type"] for r in warc.archive_pages(same, min_bytes=3).collect()} == {"response"}


def test_versions_and_damage():
    block = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    v1 = (b"filedesc://a.arc 0.0.0.0 19990101000000 text/plain %d\n%s\n" % (len(block), block)
          + b"http://a b/ 1.2.3.4 19991231235959 text/html 5\nhello\n" + b"no header here\n" + b"dns:x 1.2.3.4 19991231235959 text/dns 3\nabc\n")
    got = [(v, f, c, t) for _, v, f, c, t in warc.parse_arc(v1) if not f[0].startswith("filedesc")]
    assert got == [(1, ["http://a b/", "1.2.3.4", "19991231235959", "text/html", "5"], b"hello", False),
                   (1, ["dns:x", "1.2.3.4", "19991231235959", "text/dns", "3"], b"abc", False)]
    head = warc.arc_record(2, b"filedesc://b", b"20000101000000", b"text/plain", warc.VERSION_LINES[2], b"b", 0)
    body = head + b"\n" + warc.arc_record(2, b"http://c/", b"20000101", b"text/html", b"12345678", b"b", 9)
    records = list(warc.parse_arc(zlib.compress(body[:-3], wbits=31)))
    assert [(r[1], len(r[2]), r[3], r[4]) for r in records[1:]] == [(2, 10, b"12345", True)]
    assert warc._instant("20000101") == "2000-01-01T00:00:00Z"
