"""Derived WARC records: metadata and plain-text conversion for every response.

A response row has its record id, target URI, date, HTTP header lines and
payload. Two records come out of it. The metadata record (application/warc-fields)
carries the source's headers and digests, the title and the link targets; the
conversion record (text/plain) carries the visible text of the page. Both name the
response in WARC-Refers-To and each other in WARC-Concurrent-To, repeat
its target URI and date, and have a block digest of their own; the response's payload digest
is preserved in both as WARC-Refers-To-Payload-Digest, an extension field. Record ids are derived from the response's id, so a
rerun after a lost task gives the same records.

Digests are SHA-1 in base32, as archives write them; lengths are UTF-8 bytes.

Defined results: a NULL payload is an empty one, with an empty conversion block; a NULL target URI leaves its header
out; repeated rows give repeated records with equal ids; an empty table gives an empty result. Only the named columns
are read, so further columns cannot clash; ``keep`` names columns to carry along.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .htmltree import page_text, parse

VERSION = "WARC/1.1"
CAPTURE_DATE = "2024-01-01T00:00:00Z"
HIDDEN = frozenset("head title script style noscript template iframe object svg canvas noembed noframes".split())
CRLF = "\r\n"


def sha1_base32(data: Column) -> Column:
    """sha1: and the digest's 32 base32 characters; 5 hex digits are 4 of them."""
    digest = F.sha1(data.cast("binary"))
    fives = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.concat(F.lit("sha1:"), F.translate(F.upper(F.concat(*fives)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(*parts: Column) -> Column:
    """A urn:uuid derived from the parts (NULL differs from the empty text)."""
    h = F.sha1(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def responses(pages: DataFrame, date: str = CAPTURE_DATE) -> DataFrame:
    """Response rows for a table of raw pages (page_id, url, html)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(payload).cast("string"))
    return pages.select("page_id", record_id(F.col("page_id"), F.col("url"), payload).alias("record_id"), F.col("url").alias("target_uri"),
                        F.lit(date).alias("date"), http.alias("http_headers"), payload.alias("payload"))


def _page(html: str) -> Column:
    """struct(title, links, text) of a page column."""

    @F.arrow_udf("struct<title:string, links:array<string>, text:string>")
    def read(col: pa.Array) -> pa.Array:
        out = []
        for h in col.to_pylist():
            links: list[str] = []
            nodes = parse(h or "", links)
            title = next((n for n in nodes if n.tag == "title"), None)
            out.append({"title": " ".join(title.parts[0][0].split()) if title else "", "links": links,
                        "text": page_text(nodes[0], lambda n: n.tag in HIDDEN)})
        return pa.array(out, pa.struct([("title", pa.string()), ("links", pa.list_(pa.string())), ("text", pa.string())]))

    return read(F.col(html))


def _one_line(value: Column) -> Column:
    return F.regexp_replace(value, r"[\r\n]+", " ")


def derive(source: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows, metadata and conversion, for every response; ``record`` is the whole WARC record
    without the two line ends that close it."""
    payload = F.coalesce(F.col("payload").cast("string"), F.lit(""))
    rows = source.select(*keep, F.col("record_id").alias("refers_to"), "target_uri", "date",
                         F.coalesce(F.col("http_headers"), F.lit("")).alias("http"), payload.alias("payload"))
    rows = rows.withColumns({
        "page": _page("payload"), "payload_digest": sha1_base32(F.col("payload")),
        "source_digest": sha1_base32(F.concat("http", F.lit(CRLF * 2), "payload")),
        "metadata_id": record_id(F.col("refers_to"), F.lit("metadata")), "conversion_id": record_id(F.col("refers_to"), F.lit("conversion"))}).drop("payload")
    fields = F.array_join(F.concat(
        F.transform(F.filter(F.split("http", r"\r?\n"), lambda x: x != ""), lambda x: F.concat(F.lit("sourceHeader: "), x)),
        F.array(F.concat(F.lit("sourceBlockDigest: "), "source_digest"), F.concat(F.lit("sourcePayloadDigest: "), "payload_digest"),
                F.concat(F.lit("title: "), _one_line(F.col("page.title")))),
        F.transform(F.col("page.links"), lambda x: F.concat(F.lit("outlink: "), _one_line(x)))), CRLF)
    derived = rows.withColumn("made", F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.col("metadata_id").alias("record_id"), F.col("conversion_id").alias("concurrent_to"),
                 F.lit("application/warc-fields").alias("content_type"), F.concat(fields, F.lit(CRLF)).alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.col("conversion_id").alias("record_id"), F.col("metadata_id").alias("concurrent_to"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("page.text").alias("block"))))).select(
        *keep, "made.*", "refers_to", "target_uri", "date", "payload_digest")
    derived = derived.withColumns({"block_digest": sha1_base32(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    header = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    head = F.concat_ws(CRLF, F.lit(VERSION), header("WARC-Type", F.col("record_type")), header("WARC-Record-ID", F.col("record_id")),
                       header("WARC-Date", F.col("date")), header("WARC-Target-URI", _one_line(F.col("target_uri"))),
                       header("WARC-Refers-To", F.col("refers_to")), header("WARC-Concurrent-To", F.col("concurrent_to")),
                       header("WARC-Block-Digest", F.col("block_digest")), header("WARC-Refers-To-Payload-Digest", F.col("payload_digest")),
                       header("Content-Type", F.col("content_type")), header("Content-Length", F.col("content_length").cast("string")))
    return derived.withColumn("record", F.concat(head, F.lit(CRLF * 2), "block"))


def write_warc(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write records as WARC files, one for each partition; a record ends with two line ends."""
    records.select("record").write.mode(mode).option("lineSep", CRLF * 2).option("compression", "gzip").text(path)
