"""HTML functions (H1-H6)."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Subtrees without content, and places that hold the content, most specific first.
NOISE_TAGS = frozenset("script style noscript nav header footer aside iframe form svg template".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
CONTENT_MARKS = [("tag", "main"), ("tag", "article"), ("id", "content"), ("class", "content"), ("id", "main"), ("class", "entry-content")]
LEAST_CONTENT_BYTES = 100
MOST_SHELL_CHARS, MOST_SHELL_LINKS, LEAST_SHELL_SCRIPTS = 200, 3, 1


def html_title(html: Column) -> Column:
    """H1: '' where there is no title."""
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def html_lang(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1), F.lit(""))


def script_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit(r"(?i)<script\b"))


def raw_link_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*\bhref\s*="))


def html_links(html: Column) -> Column:
    """H3: href values of anchors, sorted, once each, not yet joined."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*\bhref\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))))


class _Reader(HTMLParser):
    """Text of the body without noise subtrees, and of each content place."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[int]]] = []
        self.noise = 0
        self.body: list[str] = []
        self.places: list[list[str]] = [[] for _ in CONTENT_MARKS]
        self.open = [0] * len(CONTENT_MARKS)

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        a = dict(attrs)
        marks = []
        for i, (kind, want) in enumerate(CONTENT_MARKS):
            value = tag if kind == "tag" else (a.get(kind) or "")
            if (value == want if kind != "class" else want in value.split()) and not (self.places[i] and not self.open[i]):
                marks.append(i)
                self.open[i] += 1
        self.noise += tag in NOISE_TAGS or tag == "head"
        self.stack.append((tag, marks))

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        while self.stack:
            t, marks = self.stack.pop()
            self.noise -= t in NOISE_TAGS or t == "head"
            for i in marks:
                self.open[i] -= 1
            if t == tag:
                break

    def handle_data(self, data):
        if self.noise:
            return
        self.body.append(data)
        for i, n in enumerate(self.open):
            if n:
                self.places[i].append(data)


def read_html(html: str | None) -> str | None:
    """H2: the first content place with 100 bytes or more, else the body; white space narrowed."""
    if html is None:
        return None
    reader = _Reader()
    reader.feed(html)
    reader.close()
    for parts in [*reader.places, reader.body]:
        text = re.sub(r"\s+", " ", " ".join(parts)).strip()
        if len(text.encode()) >= LEAST_CONTENT_BYTES or parts is reader.body:
            return text
    return ""


# Elements that a block of text doesn't go beyond.
BLOCK_TAGS = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split())


class _Blocks(HTMLParser):
    """Leaf blocks in document order, each with the tags above it. Scripts and styles hold none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.out: list[tuple[str, str]] = []
        self.words: list[str] = []
        self.path = ""

    def flush(self):
        text = re.sub(r"\s+", " ", " ".join(self.words)).strip()
        if text:
            self.out.append((self.path, text))
        self.words = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.flush()
        if tag not in VOID_TAGS:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        if not data.strip() or any(t in ("script", "style", "noscript", "template") for t in self.stack):
            return
        if not self.words:
            self.path = "/".join(self.stack)
        self.words.append(data)


def read_blocks(html: str | None) -> list[tuple[str, str]] | None:
    """Leaf blocks of a page as (path of ancestor tags, text), in order; null for a null page, none for a blank one."""
    if html is None:
        return None
    reader = _Blocks()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.out


@F.pandas_udf(ArrayType(StructType([StructField("path", StringType()), StructField("text", StringType())])))
def html_blocks(html: pd.Series) -> pd.Series:
    """Leaf blocks with their ancestor tags: the input of block classifiers."""
    return html.map(lambda x: None if x is None else [{"path": p, "text": t} for p, t in read_blocks(x)])


@F.pandas_udf(StringType())
def readable_text(html: pd.Series) -> pd.Series:
    return html.map(read_html)


def is_shell(text: Column, links: Column, scripts: Column) -> Column:
    """H4: under 200 characters, under 3 links and at least 1 script, all three."""
    return (F.length(F.coalesce(text, F.lit(""))) < MOST_SHELL_CHARS) & (links < MOST_SHELL_LINKS) & (scripts >= LEAST_SHELL_SCRIPTS)


def extraction_status(doc_type: Column, text: Column) -> Column:
    """H5: ok, empty (under 20 characters), pdf_no_text (a PDF under 50) or unsupported."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.when(~doc_type.isin("html", "pdf", "txt", "docx"), "unsupported").when((doc_type == "pdf") & (n < 50), "pdf_no_text").when(n < 20, "empty").otherwise("ok")


def longer_text(primary: Column, other: Column, least: int = 50) -> Column:
    """H6: the other extraction where the first is under ``least`` characters and the other is longer."""
    a, b = F.length(F.coalesce(primary, F.lit(""))), F.length(F.coalesce(other, F.lit("")))
    return F.when((a < least) & (b > a), other).otherwise(primary)


def content_kind(content_type: Column, url: Column) -> Column:
    """By content type, else by extension."""
    ct, path = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.regexp_replace(url, r"[?#].*$", ""))
    kind = F.when(ct.contains("html"), "html").when(ct.contains("pdf"), "pdf").when(ct.contains("wordprocessingml"), "docx").when(ct.contains("spreadsheetml"), "xlsx").when(ct.contains("presentationml"), "pptx").when(ct.startswith("text/plain"), "txt")
    ext = F.regexp_extract(path, r"\.(pdf|docx|xlsx|pptx|txt|html?|php)$", 1)
    return F.coalesce(kind, F.when(ext.isin("html", "htm", "php"), "html").when(ext != "", ext).otherwise("other"))


def is_pdf(content: Column) -> Column:
    """The first five bytes are %PDF-."""
    return F.substring(content, 1, 5) == F.unhex(F.lit("255044462D"))


def report_fields(text: Column) -> Column:
    """S10: 'Key: value' lines as a map; the first of equal keys stays."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^[^:]+:"))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    first = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(first)
