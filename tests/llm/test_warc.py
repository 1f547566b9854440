"""Derived records: links back, digests, texts, and the bytes as a reader of the format sees them."""

import base64
import gzip
import hashlib
import time
import zlib
from html.parser import HTMLParser

import pytest
from conftest import DATA

from tablewright.llm import warc


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGE = (
    "<!DOCTYPE html><html><head><title>x</title></head><body><!-- no --><script>var a='<p>';</script>"
    "<p>A &amp; <b>bold</b>&nbsp;word &lt;3<br>new</p><a href='/up?a=1&amp;b=2'>up</a></body></html>"
)


def test_records(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.example/x/", PAGE, 5), (2, None, None, 6), (3, "http://b.example", "", 7),
         (4, "http://[bad", "<a href='http://[x'>ü</a>", 8), (1, "http://a.example/x/", PAGE, 9)],
        "page_id long, url string, html string, record_id int",
    )
    source = warc.responses(pages, "2024-01-01T00:00:00Z")
    by_id = {r.record_id: r for r in source.collect()}
    rows = warc.derivatives(source, ("page_id",)).collect()
    assert len(rows) == 10 and len({r.record_id for r in rows}) == 8
    for r in rows:
        origin = by_id[r.refers_to]
        assert (r.target_uri, r.date) == (origin.target_uri, origin.date)
        assert r.source_block_digest == sha(bytes(origin.block))
        assert r.source_payload_digest == sha(bytes(origin.block).partition(b"\r\n\r\n")[2])
        assert r.block_digest == sha(bytes(r.block)) and r.content_length == len(r.block)
        assert r.source_headers["Content-Type"] == "text/html; charset=utf-8"
    texts = {r.page_id: bytes(r.block).decode() for r in rows if r.type == "conversion"}
    assert texts == {1: "A & bold word <3\nnew\nup", 2: "", 3: "", 4: "ü"}
    meta = next(bytes(r.block).decode() for r in rows if r.type == "metadata" and r.page_id == 1)
    assert "outlink: http://a.example/up?a=1&b=2\r\n" in meta
    assert "http-header: Content-Length: " in meta and "http-status: HTTP/1.1 200 OK\r\n" in meta


def test_other_responses():
    block = b"HTTP/1.0 404 Gone\r\nX: a\r\n b\r\nX: c\r\nContent-Type: image/png\r\n\r\n\x00\x01"
    (only,) = warc.derive_one("<urn:uuid:1>", "u", "d", block, "sha1:OTHER")
    assert only[2] == "metadata" and dict(only[10]) == {"X": "a b, c", "Content-Type": "image/png"}
    assert b"payload-digest-check: invalid" in only[11] and only[9] == "sha1:OTHER"
    text = b"HTTP/1.0 200 OK\r\ncontent-type: Text/Plain; charset=latin-1\r\n\r\n\xfcber <b>"
    _, conversion = warc.derive_one("<urn:uuid:1>", "u", "d", text, None)
    assert conversion[11].decode() == "über <b>"
    (bare,) = warc.derive_one("r", "u", "d", b"no head", None)
    assert b"payload-length: 7" in bare[11]


@pytest.mark.parametrize(
    "part", ["<a href ", "<script ", "<!-- ", "<head <", '<a href="', "<a <a href='x", "<p <div ", "</script", "<meta "]
)
def test_hostile_pages_take_time_by_their_length(part):
    page = (part * (1_000_000 // len(part) + 1))[:1_000_000].encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page
    begin = time.perf_counter()
    assert len(warc.derive_one("<urn:uuid:1>", "http://a.example/", "d", block, None)) == 2
    assert time.perf_counter() - begin < 2


def test_links_inside_values_and_open_tags():
    for page, links in (
        ("<a href=<a href=x>", ["<a"]), ("<a <a href='/x>y' href=z>", ["/x>y"]), ('<A title="<a" HREF = "q"', ["q"]),
        ("<a href=>", []), ("<a href='x><a href=y>", ["'x", "y"]), ("<abbr href=x>", []),
    ):
        assert list(warc._links(page)) == links
    assert warc.plain_text("a<script>b</SCRIPT >c<!-- d --><!-- e <b>f</b> < g") == "a c f < g"


def test_encoded_payloads():
    page = "<html><head></head><p>grüße</p></html>".encode()
    bare = zlib.compressobj(wbits=-15)
    chunked = b"5;x=y\r\n" + page[:5] + b"\r\n" + b"%X\r\n" % len(page[5:]) + page[5:] + b"\r\n0\r\n\r\n"
    zipped = gzip.compress(page)
    both = b"%x\r\n" % len(zipped) + zipped + b"\r\n0\r\n\r\n"
    for head, payload in (
        (b"Transfer-Encoding: chunked", chunked), (b"Content-Encoding: gzip", zipped),
        (b"content-encoding: X-GZIP", zipped), (b"Content-Encoding: deflate", zlib.compress(page)),
        (b"Content-Encoding: deflate", bare.compress(page) + bare.flush()),
        (b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip", both), (b"Content-Encoding: identity", page),
        (b"Content-Encoding: gzip", page), (b"Transfer-Encoding: chunked", page),
    ):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n" + head + b"\r\n\r\n" + payload
        _, text = warc.derive_one("r", "http://a.example", "d", block, None)
        assert text[11].decode() == "grüße" and text[9] == sha(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: br\r\n\r\n\x01\x02"
    assert [r[2] for r in warc.derive_one("r", "u", "d", block, None)] == ["metadata"]


def test_charset_is_found_anywhere_in_the_page():
    page = b"<html>" + b"<i>x</i>" * 1000 + b"<META http-equiv=x content='text/html; charset=latin-1'><p>\xfcber</p>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page
    _, text = warc.derive_one("r", "u", "d", block, None)
    assert text[11].decode().endswith("über")


def test_serialized_records_can_be_read(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", PAGE)], "page_id long, url string, html string")
    out = warc.serialized(warc.derivatives(warc.responses(pages, "2024-01-01T00:00:00Z"))).collect()
    for r in out:
        head, _, rest = bytes(r.warc).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        assert version == "WARC/1.1" and fields["WARC-Refers-To"] == r.refers_to
        assert fields["WARC-Source-Block-Digest"] == r.source_block_digest
        assert fields["WARC-Source-Payload-Digest"] == r.source_payload_digest
        told = [x.split(": ", 2)[1:] for x in lines if x.startswith("WARC-Source-Header: ")]
        assert told and sorted(map(tuple, told)) == sorted(r.source_headers.items())
        assert rest == bytes(r.block) + b"\r\n\r\n" and int(fields["Content-Length"]) == len(r.block)


class Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "head")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "head")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_texts_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    out = warc.derivatives(warc.responses(pages, "d"), ("page_id",)).filter("type = 'conversion'")
    for r in out.collect():
        parser = Words()
        parser.feed(source[r.page_id])
        plain = "".join("".join(parser.words).split())
        assert "".join(bytes(r.block).decode().split()) == plain


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses(none, "d"), ("page_id",)).collect() == []
