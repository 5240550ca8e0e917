"""WARC derivatives: each response gives a linked metadata record and a plain-text conversion record."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate

CRLF = "\r\n"
CAPTURE_DATE = "2024-01-01T00:00:00Z"

_OPENED = re.compile(r"<!(--)|<(script|style|head)\b", re.I | re.A)
_CLOSED = {k: re.compile(f"</{k}", re.I | re.A) for k in ("script", "style", "head", "title")}
_BREAK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|aside|main|nav|header|footer|blockquote|pre|title|body|html)\b[^>]*>", re.I | re.A
)
_TAG = re.compile(r"<[^>]*>")
_BLANK = re.compile("[ \t\r\f\v ]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title", re.I | re.A)
_LINK = re.compile(r"<a\s", re.I | re.A)

FIELDS = [T.StructField("plain", T.StringType()), T.StructField("title", T.StringType()), T.StructField("n_links", T.LongType())]


def _without_hidden(page: str) -> str:
    """The page without comments and without head, script and style elements. A kind that is not closed any more is
    not looked for again, so pages with many unclosed marks take time in proportion to their length."""
    out, at, unclosed = [], 0, set()
    for opened in _OPENED.finditer(page):
        kind = opened[1] or opened[2].lower()
        if opened.start() < at or kind in unclosed:
            continue
        if kind == "--":
            end = page.find("-->", opened.end()) + 3
            found = end > 2
        else:
            closed = _CLOSED[kind].search(page, opened.end())
            end = page.find(">", closed.end()) + 1 if closed else 0
            found = end > 0
        if found:
            out.append(page[at : opened.start()])
            at = end
        else:
            unclosed.add(kind)
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """The visible text: block elements end lines, other tags vanish, character references are decoded."""
    shown = _without_hidden(page)
    end = shown.rfind(">") + 1  # beyond it no tag is closed
    text = _TAG.sub("", _BREAK.sub("\n", shown[:end])) + shown[end:]
    return _LINES.sub("\n", _BLANK.sub(" ", html.unescape(text))).strip(" \n")


def title_of(page: str) -> str:
    opened = _TITLE.search(page)
    begin = page.find(">", opened.end()) + 1 if opened else 0
    closed = _CLOSED["title"].search(page, begin) if begin else None
    return _BLANK.sub(" ", html.unescape(page[begin : closed.start()])).strip() if closed else ""


def count_links(page: str) -> int:
    """Link tags with a target; a tag reaches to the next closing mark."""
    found = 0
    for part in page.split(">"):
        opened = _LINK.search(part)
        found += bool(opened) and "href" in part[opened.end() :].lower()
    return found


def _facts(pages: list[bytes | None]) -> list[list]:
    texts = [page.decode() if page else "" for page in pages]
    return [[f(text) for text in texts] for f in (plain_text, title_of, count_links)]


def base32_sha1(value: Column) -> Column:
    """A SHA-1 digest as WARC tools write it: sha1: and 32 characters of base 32."""
    digest = F.sha1(value)
    quads = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(name: Column) -> Column:
    """A record's identifier, made from its name, the same in every run."""
    digest = F.md5(name.cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">"))


def responses(pages: DataFrame, date: str = CAPTURE_DATE) -> DataFrame:
    """Response records of pages (page_id, url, html): page_id, record_id, target_uri, date, http, payload."""
    payload = F.coalesce("html", F.lit(""))
    size = F.octet_length(payload).cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF + CRLF))
    name = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    return pages.select("page_id", record_id(name).alias("record_id"), F.coalesce("url", F.lit("")).alias("target_uri"), F.lit(date).alias("date"), http.alias("http"), payload.alias("payload"))


def _headers(*pairs: tuple[str, Column]) -> Column:
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in pairs]  # none where there is no value
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.0"), *lines), F.lit(CRLF + CRLF))


def derivatives(found: DataFrame) -> DataFrame:
    """Two records for each response (page_id, record_id, target_uri, date, http, payload).

    page_id, record_type (metadata, conversion), record_id, refers_to, concurrent_to (of metadata the response, with which it
    belongs to one capture; a conversion has none, as the format allows none there),
    target_uri, date, content_type, content_length (bytes), block_digest, source_digest (the payload's), headers
    (the record's WARC headers), block. refers_to is the response's identifier; the metadata block holds the
    response's own HTTP headers, payload length and digest besides title and counts. Map side only.

    A null page has an empty payload and an empty conversion; a null url an empty target; repeated pages give
    repeated records; pages of any length are converted whole; an empty table gives no records; further columns
    are ignored.
    """
    names = ["page_id", "record_id", "target_uri", "date", "http", "payload"]
    facts = annotate(found.select(*names), "payload", lambda: _facts, FIELDS)
    made = {k: record_id(F.concat(F.lit(f"{k}|"), F.col("record_id"))) for k in ("metadata", "conversion")}
    base = facts.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "http", "plain", "title", "n_links",
        F.octet_length("payload").cast("long").alias("payload_length"),
        base32_sha1(F.col("payload").cast("binary")).alias("source_digest"),
        *[v.alias(f"{k}_id") for k, v in made.items()],
    )
    facts_json = F.to_json(
        F.struct(
            F.col("refers_to").alias("refers_to"),
            F.col("target_uri").alias("target_uri"),
            F.col("date").alias("date"),
            F.trim("http").alias("http_headers"),
            F.col("payload_length"),
            F.col("source_digest").alias("payload_digest"),
            F.col("title"),
            F.col("n_links"),
            F.length("plain").cast("long").alias("text_length"),
        )
    )

    def record(kind: str, beside: Column, content_type: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("record_type"), F.col(f"{kind}_id").alias("record_id"), beside.alias("concurrent_to"), F.lit(content_type).alias("content_type"), block.alias("block"))

    both = F.array(record("metadata", F.col("refers_to"), "application/json", facts_json), record("conversion", F.lit(None).cast("string"), "text/plain", F.col("plain")))
    rows = base.select("page_id", "refers_to", "target_uri", "date", "source_digest", F.inline(both))
    rows = rows.withColumn("content_length", F.octet_length("block").cast("long")).withColumn("block_digest", base32_sha1(F.col("block").cast("binary")))
    headers = _headers(
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Concurrent-To", F.col("concurrent_to")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("date")),
        ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")),
    )
    return rows.select(
        "page_id", "record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type", "content_length", "block_digest", "source_digest", headers.alias("headers"), "block"
    )


def derive(pages: DataFrame) -> DataFrame:
    return derivatives(responses(pages))


def _b32(value: str) -> str:
    quads = " || ".join(f"to_base(CAST('0x' || substr(sha1({value}), {1 + 5 * i}, 5) AS BIGINT), 32, 4)" for i in range(8))
    return f"'sha1:' || translate({quads}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"


def _uuid(name: str) -> str:
    cuts = " || '-' || ".join(f"substr(md5({name}), {a}, {n})" for a, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])
    return f"'<urn:uuid:' || {cuts} || '>'"


def _unescape(text: str) -> str:
    for a, b in (("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{a}', '{b}')"
    return text


_SQL_TEXT = (
    "trim(regexp_replace(regexp_replace("
    + _unescape(
        "regexp_replace(regexp_replace(regexp_replace(payload, "
        "'<!--.*?-->|<script\\b.*?</script[^>]*>|<style\\b.*?</style[^>]*>|<head\\b.*?</head[^>]*>', '', 'gis'), "
        "'</?(p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|aside|main|nav|header|footer|blockquote|pre|title|body|html)\\b[^>]*>', chr(10), 'gi'), "
        "'<[^>]*>', '', 'g')"
    )
    + ", '[ \\t\\r\\f\\v\\x{00a0}]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"
)

ORACLE_SQL = f"""
WITH r AS (SELECT page_id, {_uuid("'response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '')")} AS refers_to,
  coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
b AS (SELECT *, strlen(payload) AS payload_length, {_b32("payload")} AS source_digest, {_SQL_TEXT} AS plain,
  {_uuid("'metadata|' || refers_to")} AS metadata_id, {_uuid("'conversion|' || refers_to")} AS conversion_id,
  trim({_unescape("regexp_extract(payload, '<title[^>]*>(.*?)</title', 1, 'is')")}) AS title,
  len(regexp_extract_all(payload, '<a\\s[^>]*href', 0, 'i')) AS n_links FROM r),
j AS (SELECT *, CAST(json_object('refers_to', refers_to, 'target_uri', target_uri, 'date', '{CAPTURE_DATE}', 'http_headers',
  'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || payload_length || chr(13) || chr(10) || chr(13) || chr(10),
  'payload_length', payload_length, 'payload_digest', source_digest, 'title', title, 'n_links', n_links, 'text_length', length(plain)) AS VARCHAR) AS facts FROM b),
u AS (SELECT page_id, 'metadata' AS record_type, metadata_id AS record_id, refers_to AS concurrent_to, 'application/json' AS content_type, facts AS block, refers_to, target_uri, source_digest FROM j
  UNION ALL SELECT page_id, 'conversion', conversion_id, NULL, 'text/plain', plain, refers_to, target_uri, source_digest FROM j),
d AS (SELECT *, CAST(strlen(block) AS BIGINT) AS content_length, {_b32("block")} AS block_digest, chr(13) || chr(10) AS nl FROM u)
SELECT page_id, record_type, record_id, refers_to, concurrent_to, target_uri, '{CAPTURE_DATE}' AS date, content_type, content_length, block_digest, source_digest,
  'WARC/1.0' || nl || 'WARC-Type: ' || record_type || nl || 'WARC-Record-ID: ' || record_id || nl || 'WARC-Refers-To: ' || refers_to || coalesce(nl || 'WARC-Concurrent-To: ' || concurrent_to, '')
  || nl || 'WARC-Target-URI: ' || target_uri || nl || 'WARC-Date: {CAPTURE_DATE}' || nl || 'WARC-Block-Digest: ' || block_digest || nl || 'Content-Type: ' || content_type
  || nl || 'Content-Length: ' || content_length || nl || nl AS headers, block FROM d
"""
