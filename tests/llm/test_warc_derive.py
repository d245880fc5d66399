from __future__ import annotations

import base64
import glob
import gzip
import hashlib

from pulso.llm import registry, warc_derive as wd


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _read(data: bytes):
    """Records of a WARC file, read by their lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        assert first == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines)
        n = int(head["Content-Length"])
        block = data[end + 4:end + 4 + n]
        assert data[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
        at = end + 8 + n
        yield head, block


PAGES = [(1, "http://a.example/x", "<title>T &amp; t</title><nav><a href='/n?a=1&amp;b=2'>nav</a></nav><p>Été  one<br>two<script>no()</script><p>three"),
         (2, None, None), (3, "http://b.example/", ""), (3, "http://b.example/", ""), (4, "http://c.example/\r\nX: y", "plain\r\n\r\ntext"),
         (5, "http://d.example/", "<p>" + "long " * 100000)]


def _pages(spark):
    return spark.createDataFrame([(*p, None, None) for p in PAGES], "page_id long, url string, html string, record string, block int")


def test_round_trip_through_files(spark, tmp_path):
    source = wd.responses(_pages(spark))
    wd.write_warc(wd.derive(source), str(tmp_path / "w"))
    records = [r for f in glob.glob(str(tmp_path / "w" / "*.gz")) for r in _read(gzip.open(f).read())]
    assert len(records) == 2 * len(PAGES)
    responses = {}
    for r in source.collect():
        http = (r["http_headers"] + "\r\n\r\n" + r["payload"]).encode()
        responses[r["record_id"]] = (r["target_uri"], http, r["payload"].encode(), r["http_headers"])
    assert len(responses) == len(PAGES) - 1      # the repeated row has the same id
    ids = {h["WARC-Record-ID"]: h for h, _ in records}
    for head, block in records:
        uri, http, payload, http_head = responses[head["WARC-Refers-To"]]
        assert head["WARC-Block-Digest"] == _sha1(block)
        assert head["WARC-Refers-To-Payload-Digest"] == _sha1(payload)
        assert head.get("WARC-Target-URI") == (None if uri is None else uri.replace("\r\n", " "))
        assert head["WARC-Date"] == wd.CAPTURE_DATE
        other = ids[head["WARC-Concurrent-To"]]
        assert other["WARC-Refers-To"] == head["WARC-Refers-To"] and other["WARC-Type"] != head["WARC-Type"]
        if head["WARC-Type"] == "metadata":
            lines = block.decode().split("\r\n")
            for x in http_head.split("\r\n"):
                assert "sourceHeader: " + x in lines
            assert f"sourceBlockDigest: {_sha1(http)}" in lines and f"sourcePayloadDigest: {_sha1(payload)}" in lines


def test_contents(spark):
    rows = {(r["page_id"], r["record_type"]): r for r in wd.derive(wd.responses(_pages(spark)), keep=("page_id",)).collect()}
    meta = rows[1, "metadata"]["block"]
    assert "title: T & t\r\n" in meta and "outlink: /n?a=1&b=2\r\n" in meta
    assert rows[1, "conversion"]["block"] == "nav\nÉté one two\nthree"
    assert rows[2, "conversion"]["block"] == "" and rows[3, "conversion"]["content_length"] == 0
    assert rows[4, "conversion"]["block"] == "plain text"
    assert rows[5, "conversion"]["content_length"] == 5 * 100000 - 1


def test_query_and_empty_table(spark):
    n = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    rows = registry.op5_warc_derive(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 2 * n == len({r["record_id"] for r in rows})
    assert wd.derive(wd.responses(_pages(spark).limit(0))).collect() == []
