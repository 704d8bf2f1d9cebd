"""Derived web-archive records: from each response a metadata record and a plain-text conversion record.

Both name the response in WARC-Refers-To and repeat its target, date, content type and digests, so that a
derived record can be traced and checked without the response. Identifiers are computed from the content:
building the records again after a lost executor, or on another cluster, gives the same ones.

Everything is one pass over the responses: built-in expressions, and a vectorised function for character references.
Nothing is shuffled.

A null payload counts as empty and a null target as an empty target; repeated rows give repeated records
with equal identifiers (they describe the same bytes). An empty table gives no records.
"""

from __future__ import annotations

import re
from functools import reduce
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

WARC_VERSION = "WARC/1.1"
CRLF = "\r\n"

# Elements whose content is no text, then what to put for comments, block elements and other tags.
DROPPED = (r"(?s)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>")
BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
TAG = r"<[!/?a-zA-Z][^>]*>"
# Decimal and hexadecimal numbers, and names.
REFERENCE = re.compile(r"&(?:#([0-9]+);?|#[xX]([0-9a-fA-F]+);?|([A-Za-z][A-Za-z0-9]{1,31};))")
# The references that the SQL counterpart of the query knows.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def resolved(text: str) -> str:
    """All character references of HTML5 resolved in one pass, so that ``&amp;lt;`` becomes ``&lt;``.

    Names need their semicolon: the SQL counterpart leaves a cut-off ``&amp`` as it is, where HTML5 would resolve it.
    Unknown names stay; numbers beyond Unicode, surrogates and zero give U+FFFD. A no-break space gives a blank.
    """
    def one(found: re.Match) -> str:
        decimal, hexadecimal, name = found.groups()
        if name:
            return html5.get(name, found[0]).replace("\xa0", " ")
        digits = (decimal or hexadecimal).lstrip("0")
        if len(digits) > 7:
            return "\ufffd"
        code = int(digits or "0", 10 if decimal else 16)
        # The library drops control characters and noncharacters; HTML5 keeps them.
        return " " if code == 0xA0 else unescape(f"&#{code};") or chr(code)

    return REFERENCE.sub(one, text) if "&" in text else text


@F.arrow_udf(T.StringType())
def _resolved(texts: pa.Array) -> pa.Array:
    return pa.array([None if text is None else resolved(text) for text in texts.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    """Text of a page: no scripts, styles or comments, one line per block element, character references resolved."""
    text = reduce(lambda c, pattern: F.regexp_replace(c, pattern, " "), DROPPED, html)
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    text = F.regexp_replace(_resolved(text), r"[ \t\r]+", " ")
    return F.btrim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_uri(*parts: Column | str) -> Column:
    """A record identifier of UUID form made of the SHA-256 of the parts."""
    name = F.sha2(F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts]).cast("binary"), 256)
    pieces = [F.substring(name, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a page table, which has no capture date of its own."""
    body, target = F.coalesce(F.col(payload), F.lit("")), F.coalesce(F.col(url), F.lit(""))
    return pages.select(F.col(key).alias("key"), target.alias("target_uri"), body.alias("payload")).select(
        "key", "target_uri", "payload",
        F.lit(date).alias("warc_date"),
        F.lit("text/html; charset=utf-8").alias("source_content_type"),
        digest(F.col("payload")).alias("source_payload_digest"),
    ).withColumn("record_id", record_uri("response", F.col("target_uri"), F.col("source_payload_digest")))


def derive(source: DataFrame) -> DataFrame:
    """Two records per response: ``metadata`` (application/warc-fields) and ``conversion`` (text/plain).

    ``source`` has the columns of ``responses``. The metadata record names the conversion made beside it in
    WARC-Concurrent-To. Columns: key, warc_type, record_id, refers_to, concurrent_to, target_uri, warc_date,
    content_type, block, block_digest, content_length, source_content_type, source_payload_digest.
    """
    rows = source.withColumn("text", plain_text(F.col("payload")))
    rows = rows.withColumns({
        "text_digest": digest(F.col("text")),
        "title": F.btrim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title", 1), r"\s+", " "), F.lit(" ")),
        "language": F.regexp_extract("payload", r"(?i)<html[^>]*\blang=[\"']?([a-zA-Z-]+)", 1),
        "links": F.regexp_count("payload", F.lit(r"(?i)<a\s[^>]*\bhref=")),
    })
    fields = [
        ("title", F.col("title")), ("language", F.col("language")), ("outlinks", F.col("links").cast("string")),
        ("source-content-type", F.col("source_content_type")),
        ("source-content-length", F.octet_length("payload").cast("string")),
        ("source-payload-digest", F.col("source_payload_digest")),
        ("text-digest", F.col("text_digest")),
    ]
    rows = rows.withColumn("metadata", F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]))
    rows = rows.withColumn("conversion_id", record_uri("conversion", F.col("record_id"), F.col("text_digest")))

    def record(kind: str, own: Column, beside: Column, content_type: str, block: str, block_digest: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"), own.alias("record_id"), beside.alias("concurrent_to"),
            F.lit(content_type).alias("content_type"), F.col(block).alias("block"), block_digest.alias("block_digest"),
        )

    metadata_digest = digest(F.col("metadata"))
    records = F.array(
        record("metadata", record_uri("metadata", F.col("record_id"), metadata_digest), F.col("conversion_id"),
               "application/warc-fields", "metadata", metadata_digest),
        record("conversion", F.col("conversion_id"), F.lit(None).cast("string"), "text/plain; charset=utf-8", "text", F.col("text_digest")),
    )
    return rows.select(
        "key", F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "source_content_type", "source_payload_digest",
        F.inline(records),
    ).withColumn("content_length", F.octet_length("block").cast("long"))


def serialized(records: DataFrame) -> DataFrame:
    """Each record as the text of a WARC record without its closing blank lines."""
    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise("")

    head = [
        header("WARC-Type", F.col("warc_type")), header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Refers-To", F.col("refers_to")), header("WARC-Concurrent-To", F.col("concurrent_to")),
        header("WARC-Target-URI", F.regexp_replace("target_uri", r"[\r\n]", " ")), header("WARC-Date", F.col("warc_date")),
        header("WARC-Block-Digest", F.col("block_digest")), header("WARC-Refers-To-Payload-Digest", F.col("source_payload_digest")),
        header("WARC-Refers-To-Content-Type", F.col("source_content_type")),
        header("Content-Type", F.col("content_type")), header("Content-Length", F.col("content_length").cast("string")),
    ]
    return records.select(F.concat(F.lit(WARC_VERSION + CRLF), *head, F.lit(CRLF), F.col("block")).alias("value"))


def write(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """WARC files below ``folder``, one per task, through Spark's own committer."""
    serialized(records).write.option("lineSep", CRLF * 2).option("compression", compression).text(folder)
