"""WARC derivatives: from response records, linked metadata and plain-text conversion records.

Both derived records name the response they come from (``WARC-Refers-To``) and keep its target and
date. The conversion is the visible text. The metadata record carries the response's own
headers and digests and points at the conversion (``WARC-Concurrent-To``). All of it works
on single rows, pages in Arrow batches and the rest as DataFrame functions; nothing is shuffled,
and a lost task is simply run again.

Defined results: a NULL payload is empty and gives an empty conversion; NULL targets, dates and headers leave their lines
out; record ids are made from the source's id, so the same response always gets the same derivatives and repeated rows
give repeated records, and nothing is ordered, so ties do not matter; very long pages, of unclosed tags too, are read whole in time linear in their length; broken markup stays as text where no tag can be read; every name of HTML5 is decoded once, in text and titles, a number of no character is U+FFFD, and
&nbsp; is a space; extra columns are left behind whatever their names; an empty table gives no records.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratiform.llm.base import filled

CRLF = "\r\n"

# Elements that begin a new line, and the named characters that the SQL knows.
BLOCK_ELEMENTS = "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul"
NAMED = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•",
    "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€",
}

HIDDEN = r"(?is)<!--.*?-->|<head\b.*?</head\s*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>"
BLOCK = rf"(?is)</?(?:{'|'.join(BLOCK_ELEMENTS.split())})\b[^>]*>"
TAG = r"(?s)<[a-zA-Z/!?][^>]*>"


def record_id(kind: str, *parts: Column) -> Column:
    """A record id made from what it stands for."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *(filled(p.cast("string")) for p in parts)))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


# Not "&" and any name: what may follow a name without a semicolon is up to html.unescape.
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{0,31};?)")


@lru_cache(maxsize=100_000)
def character(reference: str) -> str:
    """What a character reference stands for."""
    if reference[1] != "#":
        return " " if reference == "&nbsp;" else markup.unescape(reference)
    hexed = reference[2] in "xX"
    digits = reference[2 + hexed :].rstrip(";").lstrip("0")
    code = int(digits or "0", 16 if hexed else 10) if len(digits) <= 7 else 0
    if 0x80 <= code <= 0x9F:  # as HTML5 has it
        return bytes([code]).decode("cp1252", "ignore") or chr(code)
    return chr(code) if 1 <= code <= 0xD7FF or 0xE000 <= code <= 0x10FFFF else "\ufffd"


def unescaped(text: str | None) -> str | None:
    """The text with all character references decoded once."""
    return _REFERENCE.sub(lambda m: character(m[0]), text) if text and "&" in text else text


_OPEN = re.compile(r"<(!--|(?:head|script|style|noscript|template)\b)", re.I | re.A)
_CLOSE = {"!--": re.compile("-->")} | {n: re.compile(rf"</{n}\s*>", re.I | re.A) for n in ("head", "script", "style", "noscript", "template")}
_BLOCK, _TAG, _SPACE = re.compile(BLOCK, re.A), re.compile(TAG, re.A), re.compile(r"[\x20\x09-\x0D]+")
_LINES, _SPACES = re.compile(r" *\n[ \n]*"), re.compile(" +")
_TITLE, _TITLE_END = re.compile(r"<title\b[^>]*>", re.I | re.A), re.compile(r"</title\s*>", re.I | re.A)
_HTML, _LANG = re.compile(r"<html\b[^>]*", re.I | re.A), re.compile(r".*\blang=\"?([A-Za-z-]+)", re.I | re.A | re.S)
_LINK, _TARGET = re.compile(r"<a\b[^>]*", re.I | re.A), re.compile(r"\bhref=", re.I | re.A)


def shown(html: str) -> str:
    """A page without comments and elements that are not shown, each a space.

    A kind whose end is missing from some place on has none behind it either, so each is looked for in vain once at most.
    """
    parts, at, lost = [], 0, set()
    found = _OPEN.search(html)
    while found:
        kind = found[1].lower()
        end = None if kind in lost else _CLOSE[kind].search(html, found.end())
        if end:
            parts += (html[at : found.start()], " ")
            at = end.end()
            found = _OPEN.search(html, at)
        else:
            lost.add(kind)
            found = _OPEN.search(html, found.end())
    return "".join((*parts, html[at:]))


def plain_text(html: str) -> str:
    """The text of a page: a line for each block, runs of white space as one space, no empty lines."""
    text = shown(html)
    # no tag ends behind the last ">", where each start would be followed to the end of the page
    last = text.rfind(">") + 1
    head, tail = _SPACE.sub(" ", text[:last]), _SPACE.sub(" ", text[last:])
    text = unescaped(_TAG.sub("", _BLOCK.sub("\n", head)) + tail)
    return _LINES.sub("\n", _SPACES.sub(" ", text)).strip(" \n")


def title(html: str) -> str | None:
    """The first title, its white space and character references as in the text; None if it is empty."""
    last = html.rfind(">") + 1
    begin = _TITLE.search(html, 0, last)
    end = begin and _TITLE_END.search(html, begin.end())
    return unescaped(_SPACE.sub(" ", html[begin.end() : end.start()])).strip(" ") or None if end else None


def language(html: str) -> str | None:
    for tag in _HTML.finditer(html):
        if found := _LANG.match(html, tag.start() + 5, tag.end()):
            return found[1]
    return None


def outlinks(html: str) -> int:
    return sum(1 for tag in _LINK.finditer(html) if _TARGET.search(html, tag.start(), tag.end()))


PAGE = StructType([StructField("plain", StringType()), StructField("title", StringType()), StructField("language", StringType()), StructField("outlinks", LongType())])


@F.arrow_udf(PAGE)
def read_page(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Text, title, language and number of links of pages, each read in time linear in its length."""
    for batch in batches:
        pages = batch.to_pylist()
        read = [[f(p) for p in pages] for f in (plain_text, title, language, outlinks)]
        yield pa.StructArray.from_arrays([pa.array(v, pa.int64() if f.name == "outlinks" else pa.string()) for v, f in zip(read, PAGE)], [f.name for f in PAGE])


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of fetched pages, as a crawl would have stored them, without a date."""
    body = filled(html)
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(body).cast("string"))
    return pages.select(
        F.col(key).alias("source_key"), record_id("response", F.col(key), F.col(url), body).alias("record_id"), F.col(url).alias("target_uri"),
        F.lit(None).cast("string").alias("date"), headers.alias("http_headers"), body.alias("payload"), sha256(body).alias("payload_digest"),
    )


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; those without a value are left out."""
    return F.concat_ws(CRLF, *(F.when(v.isNotNull(), F.concat(F.lit(f"{name}: "), v)) for name, v in fields))


def derivatives(records: DataFrame) -> DataFrame:
    """Two records for each response (see ``responses`` for the columns): ``kind``, ``record_id``, ``refers_to``, ``headers``, ``block``, ``block_digest``.

    ``source_key``, ``target_uri`` and ``source_digest`` come along; ``headers`` are the lines of the WARC header.
    """
    payload, own = filled("payload"), F.col("record_id")
    known = [F.col(c) for c in ("source_key", "record_id", "target_uri", "date", "http_headers", "payload", "payload_digest")]
    conversion = records.select(*known, read_page(payload).alias("page"), record_id("conversion", own).alias("conversion_id"), record_id("metadata", own).alias("metadata_id"))
    source_lines = F.regexp_replace(F.col("http_headers"), r"(?m)^", "source-header: ")
    fields = _lines(
        ("source-payload-digest", F.col("payload_digest")),
        ("source-payload-length", F.octet_length(payload).cast("string")),
        ("conversion-record-id", F.col("conversion_id")),
        ("title", F.col("page.title")),
        ("language", F.col("page.language")),
        ("outlinks", F.col("page.outlinks").cast("string")),
    )
    metadata = F.concat(F.concat_ws(CRLF, source_lines, fields), F.lit(CRLF))
    kinds = F.array(
        F.struct(F.lit("conversion").alias("kind"), F.col("conversion_id").alias("id"), F.col("page.plain").alias("block"), F.lit("text/plain; charset=utf-8").alias("type"), F.lit(None).cast("string").alias("beside")),
        F.struct(F.lit("metadata").alias("kind"), F.col("metadata_id").alias("id"), metadata.alias("block"), F.lit("application/warc-fields").alias("type"), F.col("conversion_id").alias("beside")),
    )
    each = conversion.select("source_key", "target_uri", "date", F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("source_digest"), F.explode(kinds).alias("r"))
    digest = sha256(F.col("r.block"))
    headers = _lines(
        ("WARC-Type", F.col("r.kind")), ("WARC-Record-ID", F.col("r.id")), ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To", F.col("refers_to")), ("WARC-Concurrent-To", F.col("r.beside")), ("Content-Type", F.col("r.type")),
        ("WARC-Block-Digest", digest), ("Content-Length", F.octet_length("r.block").cast("string")),
    )
    return each.select("source_key", "target_uri", "r.kind", F.col("r.id").alias("record_id"), "refers_to", "source_digest", headers.alias("headers"), "r.block", digest.alias("block_digest"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC 1.1 files, compressed, one for each partition.

    A record is its header, an empty line and its block; the two line ends that close it are
    the writer's separator.
    """
    record = F.concat(F.lit(f"WARC/1.1{CRLF}"), F.col("headers"), F.lit(CRLF * 2), F.col("block"))
    records.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)
