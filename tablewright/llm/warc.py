"""WARC derivatives: metadata and plain-text conversion records made from response records.

A response record is a row: ``record_id`` (``<urn:uuid:...>``), ``target_uri``, ``date``, ``block`` (the
HTTP message: head, blank line, payload) and, if known, ``payload_digest``. Every response gives a
metadata record, with what the HTTP head says, the outcome of the digest check and the links of
the page, and every textual one a conversion record with the text of its payload. Both point back
with ``WARC-Refers-To``, keep the response's URI and date, and carry its headers and digests. Ids of
derived records follow from the response's id, so a repeated run gives the same records, and so do
equal responses.

Pages are read from front to back: the end of a tag, of a comment or of a script is looked for once,
and remembered where there is none, so time grows with a page's length whatever it holds.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import column

_HIDDEN = re.compile(r"<!--|<(script|style|template|noscript|head)\b", re.I)
_ENDS = {
    name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "template", "noscript", "head")
} | {"": re.compile("-->")}
_BREAK = re.compile(r"</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|footer|header|blockquote|pre|hr|dd|dt|dl|body|html)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_BLANK = re.compile(r"[ \t\r\f\v]+")
_LINES = re.compile(r" ?\n[ \n]*")
_ANCHOR = re.compile(r"<a\b", re.I)
_META = re.compile(rb"<meta\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
_CHARSET_BYTES = re.compile(rb"charset\s*=\s*[\"']?([\w.:-]+)", re.I)

RECORDS = (
    "record_id string, refers_to string, type string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, "
    "source_block_digest string, source_payload_digest string, "
    "source_headers map<string,string>, block binary"
)


def responses(
    pages: DataFrame, date: str, key: str = "page_id", url: str = "url", content: str = "html"
) -> DataFrame:
    """Response records of stored pages, one a row, with ``key``. A NULL page has an empty payload, a
    NULL address an empty URI. The id follows from key, address and content, so equal rows have equal
    ids."""
    body = F.coalesce(column(content), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    ).cast("binary")
    digest = F.md5(
        F.concat_ws("\n", column(key).cast("string"), column(url), F.sha1(body)).cast("binary")
    )
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        column(key).alias("page_id"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.coalesce(column(url), F.lit("")).alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, body).alias("block"),
        F.lit(None).cast("string").alias("payload_digest"),
    )


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message. Continued lines are joined; without a
    blank line the whole block is payload."""
    head, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *lines = head.decode("latin-1").split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return first, headers, payload


def _sections(page, opening: re.Pattern) -> Iterator[tuple[int, int]]:
    """Where each tag's inside begins and ends: at the next ``>``, tag of the kind, or end of the page."""
    close = b">" if isinstance(page, bytes) else ">"
    found, end = opening.search(page), -1
    while found:
        begin = found.end()
        if end < begin:
            end = page.find(close, begin)
            end = len(page) if end < 0 else end
        found = opening.search(page, begin)
        yield begin, min(end, found.start()) if found else end


def _links(page: str) -> Iterator[str]:
    """The values of ``href`` in the page's anchors."""
    past = 0
    for begin, end in _sections(page, _ANCHOR):  # an anchor inside a value is none
        named = _HREF.search(page, begin, end) if begin - 2 >= past else None
        value = _VALUE.match(page, named.end()) if named else None
        if value:
            past = value.end()
            yield value[1] or value[2] or value[3] or ""


def _shown(page: str) -> str:
    """The page with a blank for each comment, script and the like; one without an end is a tag."""
    out, at, from_, endless = [], 0, 0, set()
    while found := _HIDDEN.search(page, from_):
        name = (found[1] or "").lower()
        end = None if name in endless else _ENDS[name].search(page, found.end())
        if end is None:
            endless.add(name)
            from_ = found.end()
            continue
        out += [page[at : found.start()], " "]
        at = from_ = end.end()
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """The visible text of a page, a line for each block of it."""
    page = _shown(page).replace("\n", " ")
    last = page.rfind(">") + 1  # behind it no tag ends
    tags = _TAG.sub("", _BREAK.sub("\n", page[:last]))
    text = html.unescape(tags + page[last:]).replace("\xa0", " ")
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def _unchunked(payload: bytes) -> bytes:
    """The payload of a chunked message; what does not look like a chunk stays as it is."""
    out, at = [], 0
    while True:
        line = payload.find(b"\r\n", at)
        size = payload[at:line].partition(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,16}", size):
            return b"".join([*out, payload[at:]])
        n = int(size, 16)
        if not n:
            return b"".join(out)
        out.append(payload[line + 2 : line + 2 + n])
        at = line + 2 + n
        at += 2 * (payload[at : at + 2] == b"\r\n")


def _content(payload: bytes, transfer: str, encodings: str) -> bytes | None:
    """The payload as its sender made it, or None where it is compressed in a way not known here."""
    if "chunked" in transfer.lower():
        payload = _unchunked(payload)
    for name in reversed([e.strip().lower() for e in encodings.split(",") if e.strip()]):
        if name in ("gzip", "x-gzip", "deflate"):
            for bits in (47, -15):  # gzip or zlib by its head, else bare
                try:
                    payload = zlib.decompressobj(bits).decompress(payload)
                    break
                except zlib.error:
                    continue
        elif name != "identity":
            return None
    return payload


def _decoded(payload: bytes, content_type: str) -> str:
    """The payload's text by the charset of the header, or of a ``meta`` tag anywhere in the page."""
    named = _CHARSET.search(content_type)
    name = named[1] if named else None
    if name is None:
        inside = (_CHARSET_BYTES.search(payload, a, b) for a, b in _sections(payload, _META))
        name = next((m[1].decode("latin-1") for m in inside if m), "utf-8")
    try:
        return payload.decode(name, "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive_one(record_id: str, uri: str, date: str, block: bytes, known: str | None) -> list[tuple]:
    """The derived records of one response, as rows of ``RECORDS``. Chunked and gzip or deflate payloads
    are undone for links and text; one compressed otherwise gives no conversion record. Digests are of
    the payload as stored."""
    status, headers, payload = split_message(block)
    fields: dict[str, str] = {}
    for name, value in headers:
        same = next((n for n in fields if n.lower() == name.lower()), None)
        if same is None:
            fields[name] = value
        else:
            fields[same] += ", " + value
    field = {n.lower(): v for n, v in fields.items()}
    content_type = field.get("content-type", "")
    kind = content_type.partition(";")[0].strip().lower()
    own = digest(payload)
    checked = "none" if known is None else "valid" if known == own else "invalid"
    text = None
    links: list[str] = []
    content = None
    if kind.startswith("text/") or kind == "application/xhtml+xml":
        encodings = (field.get(h, "") for h in ("transfer-encoding", "content-encoding"))
        content = _content(payload, *encodings)
    if content is not None:
        text = _decoded(content, content_type)
        if "html" in kind:
            for link in _links(text):
                try:
                    links.append(urljoin(uri, html.unescape(link).strip()))
                except ValueError:
                    continue
            text = plain_text(text)
    lines = [
        f"http-status: {status}",
        f"payload-length: {len(payload)}",
        f"payload-digest-check: {checked}",
        *(f"http-header: {n}: {v}" for n, v in headers),
        *(f"outlink: {' '.join(link.split())}" for link in links),
    ]
    made = [("metadata", "application/warc-fields", "".join(f"{x}\r\n" for x in lines))]
    if text is not None:
        made.append(("conversion", "text/plain; charset=utf-8", text))
    rows = []
    for name, mime, content in made:
        data = content.encode()
        new = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {name}')}>"
        rows.append(
            (new, record_id, name, uri, date, mime, len(data), digest(data), digest(block),
             known or own, list(fields.items()), data)
        )
    return rows


def derivatives(responses: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The derived records of all responses, with the columns ``carry`` of the response first. A
    response without an id has no place to refer to and is left out; a NULL block is empty."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    taken = responses.filter("record_id IS NOT NULL").select(
        F.struct(F.lit(0).alias("_"), *[column(c) for c in carry]).alias("carried"),
        "record_id", "target_uri", "date", "block", "payload_digest",
    )
    types = [pa.string()] * 6 + [pa.int64()] + [pa.string()] * 3
    types += [pa.map_(pa.string(), pa.string()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, len(batch), 500)):
                rows, source = [], []
                columns = [c.to_pylist() for c in part.columns[1:]]
                for i, (record, uri, date, block, known) in enumerate(zip(*columns)):
                    found = derive_one(record, uri or "", date or "", block or b"", known)
                    rows += found
                    source += [i] * len(found)
                values = zip(*rows) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64()))]
                    + [pa.array(v, t) for v, t in zip(map(list, values), types)],
                    names=["carried", *names],
                )

    carried = taken.schema["carried"].dataType.simpleString()
    out = taken.mapInArrow(run, f"carried {carried}, {RECORDS}")
    return out.select(*[F.col("carried").getField(c).alias(c) for c in carry], *names)


def serialized(records: DataFrame) -> DataFrame:
    """``records`` with ``warc``: each as the bytes of a WARC 1.1 record, header names and lines as the
    format has them, ready to be laid end to end in a file. The source's digests and headers are in
    extension fields, a ``WARC-Source-Header`` for each header."""
    optional = [
        ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "date"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Block-Digest", "block_digest"),
        ("WARC-Source-Block-Digest", "source_block_digest"),
        ("WARC-Source-Payload-Digest", "source_payload_digest"),
        ("Content-Type", "content_type"),
    ]
    entries = F.transform(
        F.map_entries("source_headers"),
        lambda h: F.concat(
            F.lit("\r\nWARC-Source-Header: "), h["key"], F.lit(": "),
            F.regexp_replace(F.coalesce(h["value"], F.lit("")), "[\r\n]+", " "),
        ),
    )
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.col("type"),
        F.lit("\r\nWARC-Record-ID: "),
        F.col("record_id"),
        *[
            F.when(F.col(c) != "", F.concat(F.lit(f"\r\n{name}: "), F.col(c))).otherwise("")
            for name, c in optional
        ],
        F.coalesce(F.array_join(entries, ""), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.col("content_length").cast("string"),
        F.lit("\r\n\r\n"),
    )
    return records.withColumn(
        "warc", F.concat(head.cast("binary"), F.col("block"), F.lit("\r\n\r\n").cast("binary"))
    )
