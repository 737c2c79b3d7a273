"""WARC derivatives: conversion records with plain text, and metadata records, of response records."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"


def _record_id(kind: str, *parts: F.Column) -> F.Column:
    """A name-based identifier: the same record gets the same one in each run."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    dashed = F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _digest(block: F.Column) -> F.Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


#: Entities that plain text resolves; the ampersand comes last, so that what it uncovers stays as it is.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


#: What has no text: comments, scripts and styles, to the end of the page where they are not closed; and tags that end a
#: line. Each pattern takes what it has read, or stops at the next opening mark, so that work is linear in the page.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script[^>]*(?:>.*?(?:</script>|\z)|\z)|<style[^>]*(?:>.*?(?:</style>|\z)|\z)"
_BLOCK = r"(?i)<(/?(p|div|h[1-6]|li|ul|ol|tr|table|article|section|nav|footer|header|title|blockquote|pre)|br)([ \t\r\n][^<>]*)?/?>"
_TAG, _SPACES, _LINES = r"<[^<>]*>", r"[ \t\r]{2,}|[\t\r]", r" ?\n[ \n]*"
_TITLE, _LANG, _LINK = r"(?i)<title[^<>]*>([^<]*)</title>", r"(?i)<html[^<>]*? lang=[\"']?([A-Za-z-]+)", r"(?i)<a[ \t\r\n][^<>]*href"


def plain_text(html: F.Column) -> F.Column:
    """Text of a page: without comments, scripts, styles and tags; blocks end lines; entities are resolved."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), _HIDDEN, " ")
    t = F.regexp_replace(F.regexp_replace(t, _BLOCK, "\n"), _TAG, "")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.regexp_replace(F.regexp_replace(t, _SPACES, " "), _LINES, "\n")
    return F.btrim(t, F.lit(" \n"))


def page_responses(pages: DataFrame) -> DataFrame:
    """Response records of pages (page_id, url, html): record_id, target_uri, header, payload, and page_id."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        "page_id",
        _record_id("response", F.col("page_id"), F.col("url"), F.col("html")).alias("record_id"),
        F.coalesce("url", F.lit("")).alias("target_uri"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(payload).cast("string"), F.lit(CRLF * 2)).alias("http_header"),
        payload.alias("payload"),
    )


def derive(responses: DataFrame) -> DataFrame:
    """Two records for each response (record_id, target_uri, http_header, payload): its text and its metadata.

    Columns: record_id, warc_type (conversion, metadata), refers_to (the response's record_id), target_uri,
    content_type, http_header (the response's, kept), source_digest (of the response's payload), block, block_digest,
    content_length; other columns of responses are kept in front, but for any of these names, which are replaced.

    The metadata block has a line for each field: the response's digest, its payload's length, the conversion's
    identifier and digest, title, language and number of links, where the page states them. Where responses have the
    payload's bytes (body), digest and length are of these. Null columns count as empty; an empty payload has an empty
    conversion. Repeated responses give repeated records, with equal identifiers. No shuffle: each response is read
    once and gives its two records in the same task.
    """
    payload, text = F.coalesce("payload", F.lit("")), plain_text(F.col("payload"))
    stored = F.coalesce("body", F.lit(b"")) if "body" in responses.columns else payload
    made = {"warc_type", "record_id", "refers_to", "target_uri", "content_type", "http_header", "source_digest", "block", "block_digest", "content_length", "payload", "body"}
    other = [F.col(f"`{c}`") for c in responses.columns if c.lower() not in made]
    own = "_w"  # what columns made on the way begin with, and no other does
    while any(c.lower().startswith(own) for c in responses.columns):
        own += "_"
    size, txt, conversion, title, lang, links, record = (f"{own}{k}" for k in range(7))
    found = responses.select(
        *other,
        F.coalesce("record_id", F.lit("")).alias("refers_to"),
        F.coalesce("target_uri", F.lit("")).alias("target_uri"),
        F.coalesce("http_header", F.lit("")).alias("http_header"),
        _digest(stored).alias("source_digest"),
        F.octet_length(stored).alias(size),
        text.alias(txt),
        _record_id("conversion", F.col("record_id")).alias(conversion),
        F.regexp_extract(payload, _TITLE, 1).alias(title),
        F.regexp_extract(payload, _LANG, 1).alias(lang),
        F.regexp_count(payload, F.lit(_LINK)).alias(links),
    )

    def field(name: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))

    metadata = F.concat(
        field("sourcePayloadDigest", F.col("source_digest")),
        field("sourcePayloadLength", F.col(size)),
        field("conversion", F.col(conversion)),
        field("conversionDigest", _digest(F.col(txt))),
        F.when(F.col(title) != "", field("title", F.regexp_replace(title, r"[ \t\r\n]+", " "))).otherwise(""),
        F.when(F.col(lang) != "", field("language", F.col(lang))).otherwise(""),
        field("links", F.col(links)),
    )
    records = F.array(
        F.struct(F.lit("conversion").alias("warc_type"), F.col(conversion).alias("record_id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col(txt).alias("block")),
        F.struct(F.lit("metadata").alias("warc_type"), _record_id("metadata", F.col("refers_to")).alias("record_id"), F.lit("application/warc-fields").alias("content_type"), metadata.alias("block")),
    )
    return found.withColumn(record, F.explode(records)).select(
        *other,
        f"{record}.record_id",
        f"{record}.warc_type",
        "refers_to",
        "target_uri",
        f"{record}.content_type",
        "http_header",
        "source_digest",
        f"{record}.block",
        _digest(F.col(f"{record}.block")).alias("block_digest"),
        F.octet_length(f"{record}.block").cast("long").alias("content_length"),
    )


def serialised(records: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column, value: each record as WARC/1.1 text, without the two line ends that part records."""
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("warc_type"),
        F.lit(f"{CRLF}WARC-Record-ID: "), F.col("record_id"),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), F.col("target_uri"),
        F.lit(f"{CRLF}WARC-Refers-To: "), F.col("refers_to"),
        F.lit(f"{CRLF}WARC-Block-Digest: "), F.col("block_digest"),
        F.lit(f"{CRLF}Content-Type: "), F.col("content_type"),
        F.lit(f"{CRLF}Content-Length: "), F.col("content_length").cast("string"), F.lit(CRLF * 2), F.col("block"),
    )
    return records.select(head.alias("value"))


def write_warc(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write records as gzip-compressed WARC files, one for each task, through Spark's own writer."""
    serialised(records, date).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


#: Bytes of blocks that the reader gathers before it hands them on.
BATCH_BYTES = 8 << 20


def _pieces(data: memoryview, size: int = 1 << 20) -> Iterator[bytes]:
    """The content of a file in pieces: of each of its gzip members, or as it is."""
    at = 0
    while at < len(data):
        if bytes(data[at : at + 2]) != b"\x1f\x8b":
            yield from (bytes(data[i : i + size]) for i in range(at, len(data), size))
            return
        member = zlib.decompressobj(wbits=31)
        while not member.eof and at < len(data):
            piece = bytes(data[at : at + size])
            yield member.decompress(piece)
            at += len(piece) - len(member.unused_data)


def parse_records(data: bytes | memoryview, path: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by names in lower case, and block of each record of a file, by Content-Length."""
    pieces, held = _pieces(memoryview(data)), bytearray()
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0 and (piece := next(pieces, None)) is not None:
            held += piece
        if not held.strip():
            return
        if not held.startswith(b"WARC/") or end < 0:
            raise ValueError(f"{path}: no record where one must begin: {bytes(held[:40])!r}")
        fields = [x.partition(":") for x in held[:end].decode("utf-8", "replace").split(CRLF)[1:]]
        fields = {k.strip().lower(): v.strip() for k, _, v in fields}
        size = int(fields.get("content-length", "0"))
        while len(held) < end + 8 + size and (piece := next(pieces, None)) is not None:
            held += piece
        yield fields, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 8 + size]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: warc_type, record_id, target_uri, refers_to, content_type, http_header, payload, body.

    Records are cut by their Content-Length, so that a block may hold anything. A response's block is its HTTP header
    and payload; other records' blocks are payloads alone. body has the payload's bytes, payload its text, with U+FFFD
    for what is not UTF-8. A file, gzip or plain, is one task's, which reads it in pieces; it raises an error where no
    record begins. A block cut off at the end of a file is kept as far as it goes; fields that are absent are null.
    """
    names = ["warc_type", "record_id", "target_uri", "refers_to", "content_type", "http_header", "payload", "body"]
    keys = ["warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "content-type"]
    types = [pa.string()] * 7 + [pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for files in batches:
            for name, content in zip(files.column("path"), files.column("content"), strict=True):
                for fields, block in parse_records(memoryview(content.as_buffer()), name.as_py()):
                    header, body = None, block
                    if fields.get("warc-type") == "response" and block.startswith(b"HTTP/"):
                        at = block.find(b"\r\n\r\n") + 4
                        header, body = (block[:at].decode("utf-8", "replace"), block[at:]) if at > 3 else (block.decode("utf-8", "replace"), b"")
                    rows.append((*(fields.get(k) for k in keys), header, body.decode("utf-8", "replace"), body))
                    size += len(block)
                    if size >= BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "warc_type string, record_id string, target_uri string, refers_to string, content_type string, http_header string, payload string, body binary")


def responses_of(records: DataFrame) -> DataFrame:
    """Response records of read_warc, as derive takes them."""
    return records.filter("warc_type = 'response'").select("record_id", "target_uri", "http_header", "payload", "body")


def parse_record(text: str) -> tuple[dict[str, str], str]:
    """Header fields and block of one serialised record."""
    head, _, block = text.partition(CRLF * 2)
    version, *lines = head.split(CRLF)
    return {"version": version} | dict(x.split(": ", 1) for x in lines), block


def derive_pages(pages: DataFrame) -> DataFrame:
    """Derivatives of pages (page_id, url, html), with page_id in front."""
    return derive(page_responses(pages))


def _sql() -> str:
    def uuid(kind: str, *parts: str) -> str:
        h = f"md5(concat_ws(chr(10), '{kind}', {', '.join(parts)}))"
        cut = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return f"('<urn:uuid:' || concat_ws('-', {cut}) || '>')"

    text = "html"
    for pattern, to in ((_HIDDEN, "' '"), (_BLOCK, "chr(10)"), (_TAG, "''")):
        text = f"regexp_replace({text}, '{pattern}', {to}, 'g')"
    for entity, char in ENTITIES:
        text = f"replace({text}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    for pattern, to in ((_SPACES, "' '"), (_LINES, "chr(10)")):
        text = f"regexp_replace({text}, '{pattern}', {to}, 'g')"
    text = f"trim({text}, ' ' || chr(10))"
    crlf = "chr(13) || chr(10)"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (
    SELECT page_id, {uuid("response", "page_id", "url", "html")} AS refers_to, url AS target_uri,
           'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: ' || strlen(html) || {crlf} || {crlf} AS http_header,
           'sha256:' || sha256(html) AS source_digest, strlen(html) AS size, {text} AS txt,
           regexp_extract(html, '{_TITLE}', 1) AS title,
           regexp_extract(html, '{_LANG.replace(chr(39), chr(39) * 2)}', 1) AS lang,
           len(regexp_extract_all(html, '{_LINK}')) AS links
    FROM p
),
d AS (
    SELECT *, {uuid("conversion", "refers_to")} AS conversion, {uuid("metadata", "refers_to")} AS meta FROM r
),
u AS (
    SELECT page_id, conversion AS record_id, 'conversion' AS warc_type, refers_to, target_uri,
           'text/plain; charset=utf-8' AS content_type, http_header, source_digest, txt AS block FROM d
    UNION ALL
    SELECT page_id, meta, 'metadata', refers_to, target_uri, 'application/warc-fields', http_header, source_digest,
           'sourcePayloadDigest: ' || source_digest || {crlf} || 'sourcePayloadLength: ' || size || {crlf}
           || 'conversion: ' || conversion || {crlf} || 'conversionDigest: sha256:' || sha256(txt) || {crlf}
           || CASE WHEN title <> '' THEN 'title: ' || regexp_replace(title, '[ \\t\\r\\n]+', ' ', 'g') || {crlf} ELSE '' END
           || CASE WHEN lang <> '' THEN 'language: ' || lang || {crlf} ELSE '' END
           || 'links: ' || links || {crlf}
    FROM d
)
SELECT *, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM u
"""


SQL = _sql()
