"""The few Arrow UDFs: nested braces, character references, HTML tokens, address resolution, decompression (STR-17, 18, 25, HTML-01)."""

from __future__ import annotations

import gzip
import html
import re
import zlib
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

TEXT_LIMIT = 5000


def drop_nested(s: str, opening: str, closing: str) -> str:
    """Without what stands between nested marks: an unclosed one drops the rest, a stray closing one stays."""
    out, depth, at = [], 0, 0
    for m in re.finditer(f"{re.escape(opening)}|{re.escape(closing)}", s):
        if depth == 0:
            out.append(s[at : m.start()])
        if m[0] == opening:
            depth += 1
        elif depth:
            depth -= 1
        else:
            out.append(m[0])
        at = m.end()
    if depth == 0:
        out.append(s[at:])
    return "".join(out)


def strip_nested(c: Column, opening: str = "{{", closing: str = "}}") -> Column:
    """STR-17."""

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: drop_nested(x, opening, closing), na_action="ignore")

    return run(c)


def template(s: str, openings: list[str]) -> str | None:
    """From the first place of the first opening that is there, but for case, to the end of its nested braces."""
    at = next((m.start() for o in openings if (m := re.search(re.escape(o), s, re.I))), None)
    if at is None:
        return None
    depth = 0
    for m in re.compile(r"\{\{|\}\}").finditer(s, at):
        depth += 1 if m[0] == "{{" else -1
        if not depth:
            return s[at : m.end()]
    return None


def first_template(c: Column, openings: list[str]) -> Column:
    """STR-22, the template itself."""

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else template(x, openings) for x in s], dtype=object)

    return run(c)


def _unpacked(data: bytes | None) -> str | None:
    if data is None:
        return None
    if data[:2] == b"\x1f\x8b":
        try:
            data = gzip.decompress(data)
        except (OSError, EOFError, zlib.error):
            return None
    return data.decode(errors="replace")


@F.pandas_udf(StringType())
def body_text(data: pd.Series) -> pd.Series:
    """SRC-16: fetched bytes as text, decompressed if they are gzipped; null if that breaks off."""
    return pd.Series([_unpacked(x) for x in data], dtype=object)


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """STR-18: character references of the whole HTML5 table."""
    return s.map(html.unescape, na_action="ignore")


def resolve(base: str, href: str) -> str | None:
    href = href.strip()
    if not href or href.startswith("#") or href.lower().startswith(("javascript:", "mailto:")):
        return None
    try:
        out = urldefrag(urljoin(base, href)).url
    except ValueError:
        return None
    return out if out.startswith(("http://", "https://")) else None


@F.pandas_udf(StringType())
def resolve_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """STR-25: an absolute http(s) address without fragment, else null."""
    return pd.Series([resolve(b or "", h) if h is not None else None for b, h in zip(base, href, strict=True)], dtype=object)


class _Page(HTMLParser):
    SILENT = {"script", "style", "noscript"}

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.title, self.words, self.size = base, [], [], 0
        self.links: dict[str, None] = {}
        self.description = self.robots = self.canonical = ""
        self.silent, self.in_title = 0, False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in self.SILENT:
            self.silent += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "a" and (url := resolve(self.base, a.get("href", ""))):
            self.links.setdefault(url)
        elif tag == "meta":
            name = a.get("name", "").lower()
            if name == "description":
                self.description = a.get("content", "")
            elif name == "robots":
                self.robots = a.get("content", "")
        elif tag == "link" and a.get("rel") == "canonical":
            self.canonical = a.get("href", "")

    def handle_endtag(self, tag):
        if tag in self.SILENT and self.silent:
            self.silent -= 1
        elif tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data.strip())
        word = data.strip()
        if word and not self.silent and self.size <= TEXT_LIMIT + 200:
            self.words.append(word)
            self.size += len(word) + 1


_FIELDS = ["title", "text", "links", "meta_description", "meta_robots", "canonical_url"]
PAGE = StructType([StructField(f, ArrayType(StringType()) if f == "links" else StringType()) for f in _FIELDS])


@F.pandas_udf(PAGE)
def _parsed(base: pd.Series, body: pd.Series) -> pd.DataFrame:
    rows = []
    for b, h in zip(base, body, strict=True):
        page = _Page(b or "")
        page.feed(h or "")
        page.close()
        rows.append(("".join(page.title), " ".join(page.words)[:TEXT_LIMIT], list(page.links), page.description, page.robots, page.canonical))
    return pd.DataFrame(rows, columns=_FIELDS)


def parse_pages(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """HTML-01: pages with title, text, links, meta_description, meta_robots, canonical_url and content_hash.

    One pass of a tokenizer; text outside scripts and styles, the title's included, at most 5000 characters; links
    resolved, distinct, in order; the last meta element wins; the canonical address stays as written.
    """
    got = pages.withColumn("parsed", _parsed(F.col(url), F.col(body)))
    return got.select(*pages.columns, "parsed.*", F.sha2(F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8"), 256).alias("content_hash"))
