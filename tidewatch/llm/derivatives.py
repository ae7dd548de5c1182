"""WARC derivatives: a metadata and a plain-text conversion record for each response record.

Both refer to the response by its record id, target and date, and carry its payload digest; the metadata block keeps
the source's status line and headers. Ids are made from the response's id and the record type, so a rerun makes the
same records. All steps are expressions on a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DROPPED = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<noscript\b.*?(?:</noscript\s*>|\z)"
_BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main"
    r"|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
)
_TAGS = r"<[a-zA-Z/!?][^>]*>"
#: Decoded in this order, the ampersand last so that no text is decoded twice.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
_BLANKS = "[ \\t\\r\\x0B\\f\u00a0]{2,}|[\\t\\r\\x0B\\f\u00a0]"
_LANG = r"(?i)\blang\s*+=\s*+[\"']?([a-zA-Z-]+)"
VERSION = "WARC/1.1"


def _numeric(text: Column) -> Column:
    """Decimal and hexadecimal character references decoded; what is none, or no character, stays."""
    pieces = F.split(text, "&#", -1)

    def piece(x, i):
        hexadecimal = F.regexp_extract(x, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        decimal = F.regexp_extract(x, r"^([0-9]{1,7});", 1)
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).cast("long")
        good = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.regexp_replace(x, r"^[xX]?[0-9a-fA-F]+;", "")
        return F.when(i == 0, x).when(good, F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), x))

    return F.when(F.contains(text, F.lit("&#")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def closed(text: Column) -> Column:
    """A text up to its last ">": behind it no tag ends, and tags that never end would each be sought to the text's end."""
    return F.left(text, F.char_length(text) - F.char_length(F.substring_index(text, ">", -1)))


def without_tags(html: Column) -> Column:
    """A page without scripts, styles, comments and tags, a line per block; empty for null."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _DROPPED, "")
    untagged = lambda t: F.concat(F.regexp_replace(F.regexp_replace(closed(t), _BREAKS, "\n"), _TAGS, ""), F.substring_index(t, ">", -1))
    # bound once: each use of the text would drop the scripts anew
    return F.get(F.transform(F.array(text), untagged), F.lit(0))


def decoded(bare: Column) -> Column:
    """Text without tags, its entities decoded and its blanks collapsed."""
    text = _numeric(bare)
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    # a single blank needs no replacement
    text = F.regexp_replace(F.regexp_replace(text, _BLANKS, " "), r" ?\n[ \n]*", "\n")
    return F.btrim(text, F.lit(" \n"))


def urn(*parts: Column) -> Column:
    """A record id that depends on the parts alone."""
    digits = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a (page_id, url, html) table, which has no headers or dates of its own."""
    body = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n")
    )
    return pages.select(
        "page_id", urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit("1970-01-01T00:00:00Z").alias("date"), head.alias("http_headers"), body.alias("payload"),
        digest(body).alias("payload_digest"),
    )


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line ends within a value become blanks."""
    return F.concat(F.lit(name + ": "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit("\r\n"))


def _lines(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response (record_id, target_uri, date, http_headers, payload, payload_digest; other columns are
    kept): record_type, record_id, refers_to, target_uri, date, source_headers, payload_digest, content_type, block,
    block_digest, content_length and warc_header; a column of one of these names is replaced.

    A null payload is empty, null headers are none, a null URI or date has no header line. Where a digest is null, that of
    the payload is made. Repeated responses give repeated records of the same ids; an empty table gives no row.
    """
    made = ("record_type", "record_id", "refers_to", "target_uri", "date", "http_headers", "payload", "payload_digest")
    kept = [F.col(f"`{c}`") for c in records.columns if c not in made]
    payload = F.coalesce("payload", F.lit(""))
    html = records.withColumns({
        "__payload": payload, "__bare": without_tags(payload), "__digest": F.coalesce("payload_digest", digest(payload)),
        "__head": F.coalesce("http_headers", F.lit("")),
    })
    html = html.withColumn("__text", decoded(F.col("__bare")))
    # each tag is read once: patterns that seek on from every start take the square of a page without ends
    after = F.coalesce(F.get(F.split(closed(F.col("__payload")), r"(?i)<title\b[^>]*+>", 2), F.lit(1)), F.lit(""))
    title = F.regexp_replace(decoded(without_tags(F.regexp_extract(after, r"(?is)\A(.*?)</title\s*+>", 1))), r"\n", " ")
    tags = lambda name: F.regexp_extract_all("__payload", F.lit(rf"(?i)<{name}\b[^>]*+"), F.lit(0))
    own = F.filter(tags("html"), lambda t: t.rlike(_LANG))
    lang = F.coalesce(F.regexp_extract(F.get(own, F.lit(0)), r"(?s)\A.*" + _LANG, 1), F.lit(""))
    links = F.size(F.filter(tags("a"), lambda t: t.rlike(r"(?i)\bhref\s*+=")))
    source = F.regexp_replace(F.regexp_replace("__head", r"\r?\n\z", ""), r"\r?\n", "\r\nsource-header: ")
    about = _lines(
        _field("title", title), _field("language", lang), _field("outlinks", links.cast("string")), _field("payload-digest", F.col("__digest")),
        F.when(F.col("__head") != "", F.concat(F.lit("source-header: "), source, F.lit("\r\n"))).otherwise(""),
    )
    kind = lambda t, media, block: F.struct(F.lit(t).alias("record_type"), F.lit(media).alias("content_type"), block.alias("block"))
    pair = F.explode(F.array(kind("metadata", "application/warc-fields", about), kind("conversion", "text/plain", F.col("__text"))))
    out = html.select(
        *kept, F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("__head").alias("source_headers"),
        F.col("__digest").alias("payload_digest"), pair.alias("__made"),
    ).select("*", "__made.*").drop("__made")
    out = out.withColumns({
        "record_id": urn("record_type", F.coalesce("refers_to", F.lit(""))), "block_digest": digest(F.col("block")),
        "content_length": F.octet_length("block").cast("long"),
    })
    angle = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    header = _lines(
        F.lit(VERSION + "\r\n"), _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", angle("record_id")),
        _field("WARC-Refers-To", angle("refers_to")), _field("WARC-Refers-To-Target-URI", F.col("target_uri")),
        _field("WARC-Refers-To-Date", F.col("date")), _field("WARC-Target-URI", F.col("target_uri")), _field("WARC-Date", F.col("date")),
        _field("WARC-Block-Digest", F.col("block_digest")), _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.col("content_length").cast("string")),
    )
    return out.withColumn("warc_header", header)


def write_warc(records: DataFrame, path: str) -> None:
    """The records one after the other, as the format has them: header, empty line, block, two empty lines."""
    record = F.concat("warc_header", F.lit("\r\n"), "block", F.lit("\r\n")).alias("value")
    records.select(record).write.option("lineSep", "\r\n").text(path)
