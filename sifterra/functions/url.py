"""URL functions (U1-U16) as Catalyst expressions. All take absolute URLs; relative links are joined first by ``join_link``."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Crawl policy tables.
DOCUMENT_EXTENSIONS = [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".txt", ".csv"]
BLOCKED_EXTENSIONS = """.jpg .jpeg .png .gif .bmp .webp .svg .ico .mp3 .mp4 .avi .mov .mkv .webm .wav .ogg .woff .woff2 .ttf .otf .eot .zip .rar .tar .gz .7z .css .js .mjs .map""".split()
TRACKING_PARAMETERS = ["fbclid", "gclid", "msclkid", "dclid", "ref", "referrer", "source", "_ga", "_gl", "mc_cid", "mc_eid"]
TRAP_SEGMENTS = "admin wp-admin wp-login.php wp-json admin.php login login.php logout signin signout print amp feed feed.xml rss rss.xml atom.xml cgi-bin".split()
CONTENT_SEGMENTS = "content post posts download downloads notice notices circular circulars act acts rule rules bulletin bulletins announcement announcements".split()
LISTING_SEGMENTS = ["category", "categories", "archive", "archives"]
LOW_VALUE_SEGMENTS = "gallery carousel team staff contact contacts map tag tags".split()
PAGE_KEYS = ["page", "p", "pg", "pageno"]
YEAR_KEYS = ["year", "yr", "y"]
MONTH_DAY_KEYS = ["month", "mon", "m", "day", "d", "date"]
LONGEST_PATH, MOST_SEGMENTS, MOST_REPEATS, LAST_PAGE, LAST_LISTING_PAGE = 500, 15, 2, 20, 5
CLASS_BOOST = {"document": 30, "content_page": 20, "listing": 10, "navigation": 0, "low_value": -5}

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def url_parts(url: Column) -> dict[str, Column]:
    part = lambda i: F.regexp_extract(url, _URL, i)
    return {"scheme": F.lower(part(1)), "host": F.lower(part(2)), "path": part(3), "query": part(4)}


def normalize_path(path: Column) -> Column:
    """One trailing index file and one trailing slash dropped, double slashes collapsed, the root kept."""
    p = F.regexp_replace(path, r"/index\.(html|htm|php)$", "")
    p = F.regexp_replace(p, "/{2,}", "/")
    p = F.when(F.length(p) > 1, F.regexp_replace(p, "/$", "")).otherwise(p)
    return F.when(p == "", "/").otherwise(p)


def query_pairs(query: Column) -> Column:
    return F.filter(F.split(query, "&"), lambda x: x != "")


def pair_key(x: Column) -> Column:
    return F.substring_index(x, "=", 1)


def pair_value(x: Column) -> Column:
    return F.when(F.instr(x, "=") > 0, F.regexp_replace(x, r"^[^=]*=", "")).otherwise("")


def clean_query(query: Column) -> Column:
    """Tracking parameters out (exact keys and the prefix utm_), the rest in order."""
    kept = F.filter(query_pairs(query), lambda x: ~(pair_key(x).startswith("utm_") | pair_key(x).isin(TRACKING_PARAMETERS)))
    return F.array_join(F.array_sort(F.transform(kept, lambda x: F.concat(pair_key(x), F.lit("="), pair_value(x)))), "&")


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def has_segment(path: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(F.transform(segments(path), F.lower), _strings(wanted))


def page_number(query: Column) -> Column:
    """The first paging parameter that is a number."""
    numbered = F.filter(query_pairs(query), lambda x: pair_key(x).isin(PAGE_KEYS) & pair_value(x).rlike("^[0-9]{1,9}$"))
    return F.try_element_at(F.transform(numbered, lambda x: pair_value(x).cast("int")), F.lit(1))


def _any_key(query: Column, keys: list[str]) -> Column:
    return F.exists(query_pairs(query), lambda x: pair_key(x).isin(keys))


def extension_of(path: Column) -> Column:
    """1 to 6 ASCII letters or digits after the last dot of the last segment; none for dotfiles. '' if there is none."""
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"^.+(\.[A-Za-z0-9]{1,6})$", 1))


def canonical_url(url: Column) -> Column:
    """The canonical URL; lower-case scheme and host, no fragment."""
    p = url_parts(url)
    query = clean_query(p["query"])
    return F.concat(p["scheme"], F.lit("://"), F.regexp_replace(p["host"], r"^(.*?):(80|443)$", "$1"), normalize_path(p["path"]), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def url_rejection(url: Column) -> Column:
    """The first reason to reject a URL, or null. Checks run in a fixed order; the first wins."""
    p = url_parts(url)
    path, query = normalize_path(p["path"]), clean_query(p["query"])
    segs = segments(path)
    most = F.array_max(F.transform(F.array_distinct(segs), lambda s: F.size(F.filter(segs, lambda t: t == s))))
    return (
        F.when((p["scheme"] == "") | (p["host"] == ""), "bad_url")
        .when(~p["scheme"].isin("http", "https"), "non_http")
        .when(F.octet_length(path) > LONGEST_PATH, "path_too_long")
        .when(F.size(segs) > MOST_SEGMENTS, "too_many_segments")
        .when(F.coalesce(most, F.lit(0)) > MOST_REPEATS, "repeated_segment")
        .when(has_segment(path, TRAP_SEGMENTS), "trap_pattern")
        .when(F.coalesce(page_number(query), F.lit(0)) > LAST_PAGE, "pagination_too_deep")
        .when(_any_key(query, YEAR_KEYS) & _any_key(query, MONTH_DAY_KEYS), "calendar_combinatorics")
        .when(extension_of(path).isin(BLOCKED_EXTENSIONS), "blocked_extension")
    )


def url_class(url: Column) -> Column:
    """Document, listing, content_page, (paged) listing, low_value or navigation; the first that holds."""
    p = url_parts(url)
    return (
        F.when(extension_of(p["path"]).isin(DOCUMENT_EXTENSIONS), "document")
        .when(has_segment(p["path"], LISTING_SEGMENTS), "listing")
        .when(has_segment(p["path"], CONTENT_SEGMENTS), "content_page")
        .when(page_number(p["query"]) <= LAST_LISTING_PAGE, "listing")
        .when(has_segment(p["path"], LOW_VALUE_SEGMENTS), "low_value")
        .otherwise("navigation")
    )


def url_score(klass: Column, depth: Column) -> Column:
    """100 plus the class's boost, less 2 a hop."""
    boost = F.create_map(*[F.lit(x) for pair in CLASS_BOOST.items() for x in pair])
    return F.lit(100) + boost[klass] - F.lit(2) * depth


def fetch_url(url: Column) -> Column:
    """U8: decoded, without www., fragment and trailing slash."""
    u = F.regexp_replace(F.coalesce(F.try_url_decode(F.trim(url)), F.trim(url)), r"#.*$", "")
    return F.regexp_replace(F.regexp_replace(u, r"^(https?://)www\.", "$1"), r"/+$", "")


def scored_url(url: Column) -> Column:
    """Decoded, without trailing slashes."""
    return F.regexp_replace(F.coalesce(F.try_url_decode(F.trim(url)), F.trim(url)), r"/+$", "")


def audit_url(url: Column) -> Column:
    """Lower-case host without www., path without trailing slash, query kept."""
    p = url_parts(url)
    path = F.regexp_replace(p["path"], r"/+$", "")
    return F.concat(F.regexp_replace(p["host"], r"^www\.", ""), path, F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""))


def host_path(url: Column) -> Column:
    """Host and path, for mapping citations."""
    p = url_parts(url)
    return F.concat(F.regexp_replace(p["host"], r"^www\.", ""), F.regexp_replace(p["path"], r"/+$", ""))


def last_labels(host: Column, n: int = 3) -> Column:
    """The last n labels of a host."""
    return F.array_join(F.slice(F.split(F.concat(F.lit("." * n), host), r"\."), -n, n), ".")


def host_suffixes(host: Column) -> Column:
    """Every suffix of a host at a dot, the whole host first: turns suffix lookups (J14, J15) into equi-joins."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def slug(text: Column) -> Column:
    """U16: lower case, runs of other characters as one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


@F.pandas_udf(StringType())
def join_link(base: pd.Series, href: pd.Series) -> pd.Series:
    """A relative link against its page; null where either is null or they can't be joined."""

    def one(b, h):
        try:
            return None if b is None or h is None else urljoin(b, h.strip())
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)])


def document_links(html: Column, extension: str = ".pdf") -> Column:
    """Href values with an extension, in order, once each."""
    return F.array_distinct(F.filter(F.regexp_extract_all(html, F.lit(r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1)), lambda h: F.lower(F.regexp_replace(h, r"[?#].*$", "")).endswith(extension)))


def file_name_of(url: Column) -> Column:
    """Host prefix of 40 characters and decoded last segment of 100, other characters as underscores."""
    p = url_parts(url)
    last = F.element_at(F.split(p["path"], "/"), -1)
    name = F.coalesce(F.try_url_decode(last), last)
    safe = lambda c: F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_")
    return F.concat(F.left(safe(p["host"]), F.lit(40)), F.lit("__"), F.left(safe(F.when(name == "", "index").otherwise(name)), F.lit(100)))


def path_allowed(path: Column, allow: list[str] | None, deny: list[str]) -> Column:
    """no denied segment and, where there is an allow list, an allowed one."""
    ok = ~has_segment(path, deny) if deny else F.lit(True)
    return ok & has_segment(path, allow) if allow else ok
