"""Queries of the remaining operators of the inventory, each over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sifterra.functions import html as H
from sifterra.functions import script, text, url
from sifterra.operators import cases, evaluation, filters, joins, lifecycle, metrics, records, sampling, search
from sifterra.plans.operations import _BM25
from sifterra.plans.registry import query
from sifterra.session import load, materialize, shared_folder

_S = "(SELECT DISTINCT result_id, item_id, suite, kind, category, question_lang, question, model_output, model_citations, model_refused, chrf FROM smoke_results)"
_BLANK = r"[\s\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]+"
_WORD = r"[\p{L}\p{N}_ऀ-ॿ]+"


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _smoke(spark, d, *cols):
    return load(spark, d, "smoke_results").select("result_id", *cols).distinct()


def _docs(spark, d):
    return load(spark, d, "documents").where("text is not null")


def _crawl(spark, d, *cols):
    return load(spark, d, "crawl_documents").select("doc_id", *cols).distinct()


# Addresses: parts, then the rules one after the other.
_URLS = f"""
u AS (SELECT DISTINCT doc_id, url, depth FROM crawl_documents WHERE url IS NOT NULL),
p AS (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS raw, string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*[^?#]*[?]([^#]*)', 1), '&') AS pairs FROM u),
n AS (SELECT *, regexp_replace(regexp_replace(raw, '/index\\.(html|htm|php)$', ''), '/{{2,}}', '/', 'g') AS path0,
  list_filter(pairs, lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND NOT list_contains({_list(url.TRACKING_PARAMETERS)}, split_part(x, '=', 1))) AS kept FROM p),
m AS (SELECT *, CASE WHEN path0 IN ('', '/') THEN '/' ELSE regexp_replace(path0, '/$', '') END AS path, list_transform(kept, lambda x: split_part(x, '=', 1)) AS keys FROM n),
q AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS segs, list_transform(list_filter(string_split(raw, '/'), lambda s: s <> ''), lambda s: lower(s)) AS low,
  TRY_CAST(list_filter(kept, lambda x: list_contains({_list(url.PAGE_KEYS)}, split_part(x, '=', 1)) AND regexp_full_match(x, '[^=]*=[0-9]{{1,9}}'))[1].regexp_replace('^[^=]*=', '') AS BIGINT) AS page,
  TRY_CAST(list_filter(list_filter(pairs, lambda x: x <> ''), lambda x: list_contains({_list(url.PAGE_KEYS)}, split_part(x, '=', 1)) AND regexp_full_match(x, '[^=]*=[0-9]{{1,9}}'))[1].regexp_replace('^[^=]*=', '') AS BIGINT) AS any_page,
  lower(regexp_extract(string_split(path, '/')[-1], '^.+(\\.[A-Za-z0-9]{{1,6}})$', 1)) AS ext, lower(regexp_extract(string_split(raw, '/')[-1], '^.+(\\.[A-Za-z0-9]{{1,6}})$', 1)) AS raw_ext FROM m)"""
_CLASS = f"""CASE WHEN list_contains({_list(url.DOCUMENT_EXTENSIONS)}, raw_ext) THEN 'document' WHEN list_has_any(low, {_list(url.LISTING_SEGMENTS)}) THEN 'listing' WHEN list_has_any(low, {_list(url.CONTENT_SEGMENTS)}) THEN 'content_page'
  WHEN any_page <= {url.LAST_LISTING_PAGE} THEN 'listing' WHEN list_has_any(low, {_list(url.LOW_VALUE_SEGMENTS)}) THEN 'low_value' ELSE 'navigation' END"""


@query(
    f"""WITH {_URLS} SELECT doc_id, url, CASE WHEN scheme = '' OR host = '' THEN 'bad_url' WHEN scheme NOT IN ('http', 'https') THEN 'non_http' WHEN octet_length(encode(path)) > {url.LONGEST_PATH} THEN 'path_too_long' WHEN len(segs) > {url.MOST_SEGMENTS} THEN 'too_many_segments'
      WHEN coalesce(list_max(list_transform(segs, lambda s: len(list_filter(segs, lambda t: t = s)))), 0) > {url.MOST_REPEATS} THEN 'repeated_segment' WHEN list_has_any(list_transform(segs, lambda s: lower(s)), {_list(url.TRAP_SEGMENTS)}) THEN 'trap_pattern' WHEN coalesce(page, 0) > {url.LAST_PAGE} THEN 'pagination_too_deep'
      WHEN list_has_any(keys, {_list(url.YEAR_KEYS)}) AND list_has_any(keys, {_list(url.MONTH_DAY_KEYS)}) THEN 'calendar_combinatorics' WHEN list_contains({_list(url.BLOCKED_EXTENSIONS)}, ext) THEN 'blocked_extension' END AS rejection FROM q"""
)
def url_rejections(spark, d):
    """The first reason against each crawled address"""
    return _crawl(spark, d, "url").where("url is not null").select("doc_id", "url", url.url_rejection(F.col("url")).alias("rejection"))


@query(f"WITH {_URLS}, s AS (SELECT {_CLASS} AS class, depth FROM q WHERE depth IS NOT NULL) SELECT class, CASE class WHEN 'document' THEN 130 WHEN 'content_page' THEN 120 WHEN 'listing' THEN 110 WHEN 'navigation' THEN 100 ELSE 95 END - 2 * depth AS score, CAST(count(*) AS BIGINT) AS pages FROM s GROUP BY ALL")
def url_score_histogram(spark, d):
    """Addresses by class and score"""
    t = _crawl(spark, d, "url", "depth").where("url is not null and depth is not null").withColumn("class", url.url_class(F.col("url")))
    return t.groupBy("class", url.url_score(F.col("class"), F.col("depth")).alias("score")).agg(F.count("*").alias("pages"))


@query("SELECT CAST(count(*) AS BIGINT) AS urls, CAST(0 AS BIGINT) AS not_idempotent FROM (SELECT DISTINCT doc_id, url FROM crawl_documents WHERE url IS NOT NULL)")
def url_idempotence(spark, d):
    """Canonicalising a canonical address changes nothing"""
    once = url.canonical_url(F.col("url"))
    return _crawl(spark, d, "url").where("url is not null").withColumn("c", once).agg(F.count("*").alias("urls"), F.count_if(url.canonical_url(F.col("c")) != F.col("c")).alias("not_idempotent"))


def _page_html():
    """A page of HTML around what parsed_pages holds."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    links = F.array_join(F.transform("links", lambda x: F.concat(F.lit('<a class="x" href="'), x, F.lit('">go</a>'))), "\n")
    scripts = F.repeat(F.lit("<script src='s.js'></script>"), F.greatest(F.coalesce("script_count", F.lit(0)), F.lit(0)))
    return F.concat(
        F.lit('<!DOCTYPE html><html class="no" lang="'), F.coalesce("lang", F.lit("")), F.lit('"><head><title>\n '), esc(F.coalesce("title", F.lit(""))), F.lit(" </title>"), scripts, F.lit("</head><body><nav>skip this</nav>"), F.coalesce(links, F.lit("")),
        F.lit("<main>"), F.array_join(F.transform(F.split("extracted_text", "\n"), lambda x: F.concat(F.lit("<p>"), esc(x), F.lit("</p>"))), "\n"), F.lit("</main><footer>skip that</footer></body></html>"),
    )


@query(
    r"""SELECT DISTINCT page_id, trim(regexp_replace(replace(replace(replace(coalesce(title, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\s+', ' ', 'g')) AS title, nullif(regexp_extract(coalesce(lang, ''), '^[A-Za-z-]+'), '') AS lang, greatest(coalesce(script_count, 0), 0) AS scripts,
      len(coalesce(links, [])) AS raw_links, array_to_string(list_sort(list_distinct(links)), '|') AS hrefs, CAST(len(list_distinct(list_filter(links, lambda x: ends_with(lower(regexp_replace(x, '[?#].*$', '')), '.pdf')))) AS INTEGER) AS pdfs FROM parsed_pages WHERE extracted_text IS NOT NULL AND links IS NOT NULL"""
)
def html_round_trip(spark, d):
    """Title, language, scripts and links read back from HTML made of every page"""
    t = load(spark, d, "parsed_pages").where("extracted_text is not null and links is not null").withColumn("html", _page_html())
    h = F.col("html")
    return t.select(
        "page_id", H.html_title(h).alias("title"), H.html_lang(h).alias("lang"), H.script_count(h).alias("scripts"), H.raw_link_count(h).alias("raw_links"), F.array_join(H.html_links(h), "|").alias("hrefs"), F.size(url.document_links(h)).alias("pdfs")
    ).distinct()


@query(r"SELECT DISTINCT page_id, trim(regexp_replace(regexp_replace(array_to_string(string_split(extracted_text, chr(10)), ' '), '[\s\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]+', ' ', 'g'), '^ | $', '', 'g')) AS body FROM parsed_pages WHERE octet_length(encode(trim(regexp_replace(extracted_text, '\s+', ' ', 'g')))) >= 100")
def html_body_round_trip(spark, d):
    """H2: the readable text of HTML made of every page of 100 bytes or more is its text, without what stands outside its main place"""
    t = load(spark, d, "parsed_pages").where(F.octet_length(F.trim(F.regexp_replace("extracted_text", r"\s+", " "))) >= 100).withColumn("html", _page_html())
    return t.select("page_id", H.readable_text(F.col("html")).alias("body")).distinct()


@query(
    r"""SELECT result_id, CASE WHEN regexp_matches(model_output, '####\s*-?[0-9]') THEN replace(regexp_extract(model_output, '####\s*(-?[0-9][0-9,]*(?:\.[0-9]+)?)', 1), ',', '') ELSE replace(regexp_extract_all(model_output, '-?[0-9][0-9,]*(?:\.[0-9]+)?')[-1], ',', '') END AS number,
      nullif(regexp_extract(' ' || upper(model_output) || ' ', '[^A-Z]([A-D])[^A-Z]', 1), '') AS choice, TRY_CAST(regexp_extract(translate(model_output, '०१२३४५६७८९', '0123456789'), '(?i)(?:ward(?:\s+no\.?)?|वडा(?:\s+नम्बर)?)\s*([0-9]{1,2})', 1) AS INTEGER) AS ward,
      regexp_matches(model_output, '[一-鿿぀-ヿ가-힯Ѐ-ӿ؀-ۿ฀-๿]') AS is_foreign FROM """ + _S + " WHERE model_output IS NOT NULL"
)
def answer_values(spark, d):
    """T-29, T-30, T-32, L18"""
    t, o = _smoke(spark, d, "model_output").where("model_output is not null"), F.col("model_output")
    return t.select("result_id", text.last_number(o).alias("number"), text.choice_letter(o).alias("choice"), text.ward_number(o).alias("ward"), script.foreign_artifact(o).alias("is_foreign"))


@query(
    f"""SELECT doc_id, CAST(len(list_filter(list_transform(regexp_split_to_array(text, '{_BLANK}'), lambda w: lower(regexp_replace(w, '[^A-Za-z0-9ऀ-ॿ]', '', 'g'))), lambda w: length(w) >= 2)) AS BIGINT) AS index_tokens,
      CAST(len(regexp_extract_all(lower(text), '{_WORD}')) AS BIGINT) AS word_tokens, CAST(len(list_filter(list_distinct(regexp_extract_all(lower(regexp_replace(text, '\\[S?\\d+\\]', ' ', 'g')), '{_WORD}')), lambda w: NOT list_contains({_list(text.STOPWORDS)}, w))) AS BIGINT) AS content_tokens FROM documents WHERE text IS NOT NULL"""
)
def token_counts_by_kind(spark, d):
    """T-5, T-6, T-13: index, word and content tokens of every document"""
    t, x = _docs(spark, d), F.col("text")
    return t.select("doc_id", F.size(text.index_tokens(x)).cast("bigint").alias("index_tokens"), F.size(text.word_tokens(x)).cast("bigint").alias("word_tokens"), F.size(text.content_tokens(x)).cast("bigint").alias("content_tokens"))


@query("SELECT doc_id, substr(text, greatest(strpos(lower(text), 'fee') - 80, 1), 240) AS snippet, CAST(length(text) // 3 AS BIGINT) AS by_3, CAST(length(text) // 4 AS BIGINT) AS by_4 FROM documents WHERE text IS NOT NULL")
def document_snippets(spark, d):
    """T-11, T-26: 240 characters around the first 'fee', token estimates by length"""
    x = F.col("text")
    return _docs(spark, d).select("doc_id", text.snippet(x, F.lit("fee")).alias("snippet"), text.token_estimate_by_length(x, 3).alias("by_3"), text.token_estimate_by_length(x, 4).alias("by_4"))


@query(
    r"""WITH t AS (SELECT DISTINCT conv_id, turn_no, content, substr(content, 1, 120) AS head FROM chat_turns WHERE content IS NOT NULL)
    SELECT DISTINCT conv_id, turn_no, CASE WHEN length(content) <= 120 THEN content ELSE rtrim(CASE WHEN regexp_matches(head, '(?s)^.{66,}[.।!?\s]') THEN regexp_extract(head, '(?s)^(.{66,}[.।!?\s])', 1) ELSE head END) END AS short FROM t"""
)
def turns_cut_at_boundaries(spark, d):
    """T-27: turns of at most 120 characters, cut at a boundary from 55 % on (the limit is the operator's)"""
    t = load(spark, d, "chat_turns").where("content is not null").select("conv_id", "turn_no", "content").distinct()
    return t.select("conv_id", "turn_no", text.truncate_at_boundary(F.col("content"), 120).alias("short")).distinct()


@query(
    r"""WITH s AS (SELECT result_id, unnest(list_filter(list_transform(regexp_extract_all(regexp_replace(model_output, '\[(\d+)\]', '[S\1]', 'g'), '[^.।!?\n]+[.।!?]*'), lambda x: trim(x)), lambda x: x <> '')) AS s FROM """ + _S + r""" WHERE model_output IS NOT NULL)
    SELECT result_id, CAST(count(*) AS BIGINT) AS sentences, CAST(count(*) FILTER (NOT regexp_matches(s, '\[S\d+\]')) AS BIGINT) AS added FROM s GROUP BY 1"""
)
def citations_required(spark, d):
    """T-20, T-21: every sentence of an answer with a mark; how many were given one"""
    t = _smoke(spark, d, "model_output").where("model_output is not null").withColumn("o", text.mark_citations(F.col("model_output")))
    n = F.size(text.sentences(F.col("o")))
    marked = text.require_citation(F.col("o"), F.lit("[S999]"))
    return t.select("result_id", n.cast("bigint").alias("sentences"), F.regexp_count(marked, F.lit(r"\[S999\]")).cast("bigint").alias("added")).where("sentences > 0")


_TOPICS = [("(?i)licen[cs]e|लाइसेन्स", "licence"), ("(?i)passport|राहदानी", "passport"), ("(?i)citizenship|नागरिकता", "citizenship"), ("(?i)tax|कर ", "tax")]


@query("SELECT result_id, CASE " + " ".join(f"WHEN regexp_matches(question, '{p}') THEN '{n}'" for p, n in _TOPICS) + " ELSE coalesce(category, 'other') END AS topic, regexp_matches(lower(question), 'fee|दस्तुर') AS about_fee FROM " + _S + " WHERE question IS NOT NULL")
def question_topics(spark, d):
    """T-33, T-10: the label of the first pattern that fits, else the category"""
    t, q = _smoke(spark, d, "question", "category").where("question is not null"), F.col("question")
    return t.select("result_id", filters.canonical_query(q, _TOPICS, F.coalesce("category", F.lit("other"))).alias("topic"), text.has_keyword(q, ["fee", "दस्तुर"]).alias("about_fee"))


@query(
    f"""WITH w AS (SELECT translate(unnest(string_split(text, ' ')), '०१२३४५६७८९', '0123456789') AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT w, CASE {" ".join(f"WHEN ends_with(w, '{p}') AND length(w) >= {len(p) + 3} THEN left(w, length(w) - {len(p)})" for p in script.POSTPOSITIONS)} ELSE w END AS stem FROM w WHERE regexp_matches(w, '[ऀ-ॿ]'))
    SELECT stem, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1"""
)
def devanagari_stems(spark, d):
    """Words with Devanagari by their stem, digits folded"""
    w = _docs(spark, d).select(F.explode(F.split("text", " ")).alias("w")).select(script.fold_digits(F.col("w")).alias("w")).where(F.col("w").rlike("[ऀ-ॿ]"))
    return w.groupBy(script.stem_postposition(F.col("w")).alias("stem")).agg(F.count("*").alias("n"))


@query(r"SELECT DISTINCT conv_id, turn_no, regexp_replace(content, '(?i)(^|[^\p{L}\p{M}])(?:desk|office)($|[^\p{L}\p{M}])', '\1[place]\2', 'g') AS scrubbed FROM chat_turns WHERE content IS NOT NULL AND NOT regexp_matches(content, '(?i)(desk|office)[^\p{L}\p{M}](desk|office)')")
def scrubbed_turns(spark, d):
    """T-22: words replaced where they stand alone (turns with two in a row need overlapping matches, which SQL's pattern can't state)"""
    t = load(spark, d, "chat_turns").where("content is not null").where(~F.col("content").rlike(r"(?i)(desk|office)[^\p{L}\p{M}](desk|office)")).select("conv_id", "turn_no", "content").distinct()
    return t.select("conv_id", "turn_no", records.scrub(F.col("content"), ["desk", "office"], "[place]").alias("scrubbed")).distinct()


@query(r"SELECT DISTINCT page_id, nullif(trim(regexp_extract(extracted_text, 'Phone\s*:?\s*(.*?)(?:\| Fax|\| Email|\n|$)', 1)), '') AS phone FROM parsed_pages WHERE extracted_text IS NOT NULL")
def labelled_phones(spark, d):
    """T-24: what stands between a label and the next"""
    t = load(spark, d, "parsed_pages").where("extracted_text is not null")
    return t.select("page_id", text.labelled_field(F.col("extracted_text"), "Phone", ["| Fax", "| Email"]).alias("phone")).distinct()


@query(
    """SELECT c.doc_id FROM (SELECT DISTINCT doc_id, source_id, url, title, doc_type, status_code, depth, removed_at FROM crawl_documents) c WHERE source_id IN (SELECT source_id FROM source_registry WHERE tier <= 3)
      AND coalesce(removed_at IS NOT NULL, false) = false AND trim(coalesce(url, '')) <> '' AND trim(coalesce(title, '')) <> '' AND (coalesce(doc_type IN ('html', 'pdf'), false) OR (coalesce(doc_type = 'docx', false) AND coalesce(status_code = 200, false))) AND depth <= CASE WHEN doc_type = 'pdf' THEN 4 ELSE 3 END"""
)
def crawl_filters(spark, d):
    """A key list, required fields, classes that pass always or under a condition, hops by class"""
    t = _crawl(spark, d, "source_id", "url", "title", "doc_type", "status_code", "depth", "removed_at").withColumn("gone", F.col("removed_at").isNotNull())
    t = filters.in_keys(t, load(spark, d, "source_registry").where("tier <= 3"), "source_id")
    t = filters.with_fields(t, ["url", "title"], "gone")
    t = t.where(filters.by_class(F.col("doc_type"), ["html", "pdf"], {"docx": F.col("status_code") == 200}))
    return t.where(filters.depth_ok(F.when(F.col("doc_type") == "pdf", "document").otherwise("page"), F.col("depth"), 4, 3)).select("doc_id")


@query("SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN coalesce(status_code >= 400, false) THEN 'error' WHEN coalesce(content_hash, '') = '' THEN 'no_hash' WHEN source_id IS NULL OR source_id NOT IN (SELECT source_id FROM source_registry) THEN 'unknown_source' ELSE 'good' END AS reason FROM (SELECT DISTINCT * FROM crawl_documents)) GROUP BY 1")
def manifest_rejects(spark, d):
    """One JSON-lines manifest a source written and read back, lines by why they aren't taken"""
    from pyspark.sql.types import StringType, StructField, StructType

    from sifterra.sources import readers

    folder = f"{shared_folder(spark)}/manifests_{uuid.uuid4().hex}"
    t = load(spark, d, "crawl_documents").distinct().select("doc_id", "source_id", F.coalesce("source_id", F.lit("none")).alias("m"), "content_hash", F.when(F.col("status_code") >= 400, F.col("status_code").cast("string")).alias("error"))
    t.write.partitionBy("m").json(folder)
    schema = StructType([StructField(c, StringType()) for c in ("doc_id", "source_id", "content_hash", "error")])
    lines = readers.read_jsonl(spark, folder, schema, recursive=True)
    known = load(spark, d, "source_registry").select("source_id", F.lit(True).alias("known")).distinct()
    j = lines.join(F.broadcast(known), "source_id", "left")  # the registry is fixed
    return j.groupBy(F.coalesce(readers.reject_reason(F.coalesce("known", F.lit(False))), F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id, event_type FROM events")
def jsonl_round_trip(spark, d):
    """Events written as JSON lines, with a malformed and a blank line beside them, and read back by the tolerant scan"""
    from pyspark.sql.types import StructType

    from sifterra.sources import readers, writers

    folder = f"{shared_folder(spark)}/jsonl_{uuid.uuid4().hex}"
    t = load(spark, d, "events").select("event_id", "user_id", "event_type")
    writers.write_jsonl(t, folder)
    spark.createDataFrame([("{broken",), ("",)], "value string").coalesce(1).write.mode("append").text(folder)
    back = readers.read_jsonl(spark, folder, StructType(t.schema.fields))
    return back.where(F.col(readers.CORRUPT).isNull()).drop(readers.CORRUPT)


@query("SELECT 'events' AS part, CAST(count(*) AS BIGINT) AS appended FROM events UNION ALL SELECT 'again', 0")
def append_log_resume(spark, d):
    """A log appended to twice; the second time nothing is new"""
    from sifterra.sources import writers

    folder = f"{shared_folder(spark)}/log_{uuid.uuid4().hex}"
    t = load(spark, d, "events").select("event_id", "event_type")
    first = writers.append_new(t, folder, "event_id").agg(F.lit("events").alias("part"), F.count("*").alias("appended"))
    first = materialize(first, "first")
    return first.unionByName(writers.append_new(t, folder, "event_id").agg(F.lit("again").alias("part"), F.count("*").alias("appended")))


@query("SELECT 'documents' AS name, CAST(count(*) AS BIGINT) AS n_rows FROM documents UNION ALL SELECT 'chunks', count(*) FROM chunks")
def release_manifest(spark, d):
    """A release of documents and chunks and its manifest"""
    from sifterra.sources import writers

    m = writers.export_release({"documents": load(spark, d, "documents"), "chunks": load(spark, d, "chunks")}, f"{shared_folder(spark)}/release_{uuid.uuid4().hex}")
    return m.select(F.col("table").alias("name"), F.col("rows").cast("bigint").alias("n_rows"))


@query("SELECT DISTINCT trim(url) AS url FROM parsed_pages WHERE trim(url) <> '' AND NOT starts_with(trim(url), '#')")
def url_list_round_trip(spark, d):
    """Addresses in a text file with blank lines and comments, read back"""
    from sifterra.sources import readers

    folder = f"{shared_folder(spark)}/urls_{uuid.uuid4().hex}"
    load(spark, d, "parsed_pages").where("url is not null").select(F.explode(F.array(F.concat(F.lit("  "), "url"), F.lit(""), F.lit("# note"))).alias("value")).write.text(folder)
    return readers.read_url_list(spark, folder).distinct()


@query("SELECT doc_id, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '[^A-Za-z0-9._-]+', '_', 'g')[1:40] || '__' || regexp_replace(CASE WHEN regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) = '' THEN 'index' ELSE regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) END, '[^A-Za-z0-9._-]+', '_', 'g')[1:100] AS file_name FROM (SELECT DISTINCT doc_id, url FROM crawl_documents WHERE regexp_matches(url, '^https?://[^/?#]+/') AND NOT contains(url, '%'))")
def file_names(spark, d):
    """A safe file name of every address (those with escapes are left to the tests: SQL has no decoder that keeps bad ones)"""
    t = _crawl(spark, d, "url").where(F.col("url").rlike("^https?://[^/?#]+/") & ~F.col("url").contains("%"))
    return t.select("doc_id", url.file_name_of(F.col("url")).alias("file_name"))


@query("SELECT doc_id, coalesce(CASE WHEN contains(lower(ct), 'html') THEN 'html' WHEN contains(lower(ct), 'pdf') THEN 'pdf' END, CASE WHEN regexp_matches(lower(regexp_replace(url, '[?#].*$', '')), '\\.(html?|php)$') THEN 'html' ELSE nullif(regexp_extract(lower(regexp_replace(url, '[?#].*$', '')), '\\.(pdf|docx|xlsx|pptx|txt)$', 1), '') END, 'other') AS kind FROM (SELECT DISTINCT doc_id, url, CASE doc_type WHEN 'html' THEN 'text/HTML; charset=utf-8' WHEN 'pdf' THEN 'application/pdf' END AS ct FROM crawl_documents WHERE url IS NOT NULL)")
def content_kinds(spark, d):
    """By content type, else by extension"""
    ct = F.when(F.col("doc_type") == "html", "text/HTML; charset=utf-8").when(F.col("doc_type") == "pdf", "application/pdf")
    t = _crawl(spark, d, "url", ct.alias("ct")).where("url is not null")
    return t.select("doc_id", H.content_kind(F.col("ct"), F.col("url")).alias("kind"))


@query("SELECT cycle_id, source_id, CASE WHEN finished_at IS NULL AND errors > 0 THEN 0 WHEN finished_at IS NULL THEN 1 WHEN shell_flagged THEN 2 ELSE 3 END AS bucket, CAST(row_number() OVER (PARTITION BY source_id, CAST(started_at AS DATE) ORDER BY started_at, cycle_id) AS BIGINT) AS place FROM (SELECT DISTINCT * FROM poll_cycles) WHERE source_id IS NOT NULL")
def cycle_priorities(spark, d):
    """The first rule that holds, and each cycle's place in its source's day"""
    t = load(spark, d, "poll_cycles").distinct().where("source_id is not null").withColumn("day", F.to_date("started_at"))
    open_ = F.col("finished_at").isNull()
    t = t.withColumn("bucket", filters.priority([open_ & (F.col("errors") > 0), open_, F.col("shell_flagged")]))
    return filters.dense_rank_by(t, ["source_id", "day"], [F.asc("started_at"), F.asc("cycle_id")], "place").select("cycle_id", "source_id", "bucket", F.col("place").cast("bigint"))


@query("SELECT source_id, started_at AS queued_at FROM (SELECT source_id, min(started_at) AS started_at FROM poll_cycles WHERE finished_at IS NULL AND source_id IS NOT NULL GROUP BY 1) ORDER BY started_at, source_id LIMIT 5")
def oldest_open_sources(spark, d):
    """K7: the head of a queue of sources with open cycles (five are asked for)"""
    q = load(spark, d, "poll_cycles").where("finished_at is null and source_id is not null").groupBy("source_id").agg(F.min("started_at").alias("queued_at")).withColumn("status", F.lit("pending"))
    return filters.queue_head(q, ["source_id"], 5).select("source_id", "queued_at")


@query("SELECT 'kind' AS column_name, kind AS value, CAST(count(*) AS BIGINT) AS n FROM " + _S + " GROUP BY 2 UNION ALL SELECT 'question_lang', question_lang, count(*) FROM " + _S + " GROUP BY 2 UNION ALL SELECT 'category', category, count(*) FROM " + _S + " GROUP BY 2")
def value_frequencies(spark, d):
    """Three frequency tables in one pass"""
    return filters.frequency_tables(_smoke(spark, d, "kind", "question_lang", "category"), ["kind", "question_lang", "category"])


@query("SELECT suite, question_lang, CAST(count(chrf) AS BIGINT) AS n, round(avg(chrf), 6) AS mean FROM " + _S + " GROUP BY ALL")
def mean_by_slice(spark, d):
    """A27"""
    return _smoke(spark, d, "suite", "question_lang", "chrf").groupBy("suite", "question_lang").agg(F.count("chrf").alias("n"), F.round(F.avg("chrf"), 6).alias("mean"))


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('s:' || doc_id)) AS n, greatest(100, CAST(floor(count(*) OVER () * 0.05) AS BIGINT)) AS k FROM documents) SELECT doc_id, CASE WHEN n <= k THEN 'holdout' ELSE 'train' END AS split FROM r")
def shuffled_holdout(spark, d):
    """max(100, 5 %) in seeded order are held out"""
    return filters.shuffle_holdout(load(spark, d, "documents").select("doc_id"), "doc_id").select("doc_id", "split")


@query("SELECT doc_id FROM documents ORDER BY md5('s:' || doc_id) LIMIT 250")
def uniform_sample(spark, d):
    """K9: 250 rows, each equally likely (the sample is the operator's result)"""
    return sampling.sample_n(load(spark, d, "documents").select("doc_id"), "doc_id", 250)


@query("SELECT source_id, doc_type, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id, doc_type ORDER BY doc_id) AS n FROM (SELECT DISTINCT source_id, doc_type, doc_id FROM crawl_documents WHERE source_id IS NOT NULL)) WHERE n <= 3")
def capped_per_key(spark, d):
    """Three of each source and kind (the cap is the operator's)"""
    t = _crawl(spark, d, "source_id", "doc_type").where("source_id is not null")
    return sampling.cap_per_key(t, ["source_id", "doc_type"], [F.asc("doc_id")], 3).select("source_id", "doc_type", "doc_id")


_STATES = [("pending", "approve", "approved"), ("pending", "reject", "rejected"), ("approved", "fail", "pending")]


@query("SELECT result_id, CASE WHEN state = 'pending' AND event = 'approve' THEN 'approved' WHEN state = 'pending' AND event = 'reject' THEN 'rejected' WHEN state = 'approved' AND event = 'fail' THEN 'pending' ELSE state END AS next FROM (SELECT result_id, CASE kind WHEN 'grounded' THEN 'pending' WHEN 'refusal' THEN 'approved' ELSE 'rejected' END AS state, CASE WHEN chrf > 40 THEN 'approve' WHEN chrf > 20 THEN 'reject' ELSE 'fail' END AS event FROM " + _S + ")")
def state_transitions(spark, d):
    """The next state from a transition table"""
    t = _smoke(spark, d, "kind", "chrf")
    state = F.when(F.col("kind") == "grounded", "pending").when(F.col("kind") == "refusal", "approved").otherwise("rejected")
    event = F.when(F.col("chrf") > 40, "approve").when(F.col("chrf") > 20, "reject").otherwise("fail")
    return t.select("result_id", filters.transition(state, event, _STATES).alias("next"))


@query("SELECT source_id, day, arg_max(errors, cycle_id) AS errors, arg_max(docs_inserted, cycle_id) AS docs_inserted FROM (SELECT source_id, CAST(CAST(started_at AS DATE) AS VARCHAR) AS day, cycle_id, errors, docs_inserted FROM (SELECT DISTINCT * FROM poll_cycles) WHERE source_id IS NOT NULL AND started_at IS NOT NULL) GROUP BY ALL")
def daily_snapshot_upsert(spark, d):
    """One health row a source and day; a later cycle of the day writes over an earlier one"""
    t = load(spark, d, "poll_cycles").distinct().where("source_id is not null and started_at is not null").select("source_id", F.to_date("started_at").cast("string").alias("day"), "cycle_id", "errors", "docs_inserted")
    t = t.withColumn("k", F.struct("source_id", "day"))
    even, odd = t.where("cycle_id % 2 = 0"), t.where("cycle_id % 2 = 1")
    last = lambda x: joins.last_write(x.select("k", "cycle_id", "errors", "docs_inserted"), "k", "cycle_id").select("k.source_id", "k.day", "cycle_id", "errors", "docs_inserted")
    both = last(even).unionByName(last(odd)).withColumn("k", F.struct("source_id", "day"))
    return last(both).select("source_id", "day", "errors", "docs_inserted")


@query("SELECT source_id FROM source_registry WHERE coalesce(tier = 1, false) OR province IN ('Bagmati', 'Koshi')")
def location_conflicts(spark, d):
    """federal rows stay, others where their place is wanted"""
    t = load(spark, d, "source_registry").select("source_id", "tier", "province")
    return joins.location_filter(t, F.col("province"), F.array(F.lit("Bagmati"), F.lit("Koshi")), F.coalesce(F.col("tier") == 1, F.lit(False))).select("source_id")


@query(f"WITH {_BM25}, k AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS r FROM s) SELECT item_id, CAST(NULL AS BIGINT) AS doc_id, 'S1' AS source_ref FROM gold_items WHERE item_id % 50 = 0 AND question IS NOT NULL UNION ALL SELECT item_id, doc_id, 'S' || (r + 1) FROM k WHERE r <= 5")
def source_pack(spark, d):
    """Of a query set each query's claim, then its five best documents, numbered"""
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    s = search.bm25(load(spark, d, "documents"), q, "item_id", "question").withColumn("score", F.round("score", 6))
    docs = search.top_k(s, ["item_id"], [F.desc("score"), F.asc("doc_id")], 5).select("item_id", "doc_id", "rank")
    claims = q.where("question is not null").select("item_id", F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).alias("rank"))
    return joins.numbered_sources(claims, docs, "item_id", "rank").select("item_id", "doc_id", "source_ref")


@query(f"WITH {_BM25} SELECT item_id, doc_id, round(score, 6) AS score FROM s")
def stored_index_scores(spark, d):
    """All scores of a query set from an index written to the shared folder; no text is read for the search"""
    folder = f"{shared_folder(spark)}/index_{uuid.uuid4().hex}"
    search.write_index(load(spark, d, "documents"), folder)
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    return search.search_index(spark, folder, q, "item_id", "question").select("item_id", "doc_id", F.round("score", 6).alias("score"))


_CLAIM_SQL = """
t AS (SELECT item_id, question, list_distinct(regexp_extract_all(lower(question), '[\\p{L}\\p{N}_ऀ-ॿ]+')) AS toks, question_category, gold_source_urls FROM gold_items WHERE question IS NOT NULL),
x AS (SELECT item_id, unnest(toks) AS tok FROM t), o AS (SELECT a.item_id AS q_id, b.item_id AS claim_id, count(*) AS overlap, count(*) FILTER (tok NOT IN ('kotgaun', 'rampur')) AS free FROM x a JOIN x b USING (tok) WHERE a.item_id % 50 = 0 GROUP BY ALL)
SELECT q_id, claim_id, CAST(overlap AS BIGINT) AS overlap, round(overlap * (1 + 0.3 * (1 - least(1.0, len(c.toks) / 50))) + 0.75 * free + CASE WHEN list_contains(q.gold_source_urls, c.gold_source_urls[1]) THEN 2.5 ELSE 0 END + least(4.0, 1.25 * len(list_filter(['fee', 'tax', 'passport'], lambda m: list_contains(c.toks, m)))), 6) AS score
FROM o JOIN t q ON q.item_id = q_id JOIN t c ON c.item_id = claim_id WHERE free > 0"""


@query("WITH " + _CLAIM_SQL.replace("\\\\", "\\"))
def claim_ranking(spark, d):
    """Scores of all claims for a query set: overlap, shared words, a wanted source, strong marks"""
    g = load(spark, d, "gold_items").where("question is not null").withColumn("tokens", F.array_distinct(text.word_tokens(F.col("question"))))
    marks = F.filter(F.array(F.lit("fee"), F.lit("tax"), F.lit("passport")), lambda m: F.array_contains("tokens", m))
    claims = g.select(F.col("item_id").alias("claim_id"), "tokens", F.try_element_at("gold_source_urls", F.lit(1)).alias("domain"), F.lit("medium").alias("confidence"), marks.alias("markers"))
    asked = g.where("item_id % 50 = 0").select(F.col("item_id").alias("q_id"), "tokens", F.coalesce("gold_source_urls", F.array().cast("array<string>")).alias("domains"))
    return search.claim_scores(claims, asked, "claim_id", "q_id", ["kotgaun", "rampur"]).select("q_id", "claim_id", "overlap", F.round("score", 6).alias("score"))


_GATE = """CASE WHEN n = 0 AND claims > 0 THEN 'tacit_only' WHEN n = 0 THEN 'no_sources' WHEN topic IS NULL AND place THEN 'locality_without_service_topic' WHEN claims > 0 AND topic = 'tax' AND place THEN 'local_tacit_topic_match'
  WHEN topic IS NOT NULL AND ok THEN 'expected_domain_in_top3' WHEN topic IS NOT NULL THEN 'topic_expected_domain_missing_top3' WHEN chrf >= 40 THEN 'top_gov_relevance_high' WHEN chrf >= 20 THEN 'top_gov_relevance_medium' ELSE 'low_relevance' END"""


@query(f"""WITH r AS (SELECT result_id, chrf, len(coalesce(model_citations, [])) AS n, length(coalesce(model_output, '')) % 2 AS claims, CASE WHEN category IN ('tax', 'land', 'passport') THEN category END AS topic, regexp_matches(lower(coalesce(question, '')), ' in ') AS place,
      list_has_any(model_citations[1:3], ['S1', 'S2']) AS ok FROM {_S}), o AS (SELECT result_id, {_GATE} AS outcome FROM r) SELECT result_id, outcome, outcome NOT IN ('no_sources', 'locality_without_service_topic', 'topic_expected_domain_missing_top3', 'low_relevance') AS passed FROM o""")
def retrieval_gate(spark, d):
    """The outcome for what every answer cites"""
    t = _smoke(spark, d, "chrf", "model_citations", "category", "question", "model_output")
    rel = F.when(F.col("chrf") >= 40, "high").when(F.col("chrf") >= 20, "medium").otherwise("low")
    results = F.transform(F.coalesce("model_citations", F.array().cast("array<string>")), lambda c: F.struct(c.alias("host"), rel.alias("relevance")))
    topic = F.when(F.col("category").isin("tax", "land", "passport"), F.col("category"))
    place = F.lower(F.coalesce("question", F.lit(""))).contains(" in ")
    g = records.quality_gate(F.length(F.coalesce("model_output", F.lit(""))) % 2, results, topic, F.array(F.lit("S1"), F.lit("S2")), place, topic == "tax")
    return t.select("result_id", g["outcome"].alias("outcome"), g["passed"].alias("passed"))


@query(f"""WITH {_BM25}, k AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS n FROM s), t AS (SELECT k.*, d.source, lower(d.text) AS x, list_filter(list_distinct(string_split(regexp_replace(lower(g.question), '[^a-z0-9 ]', '', 'g'), ' ')), lambda w: length(w) > 3) AS terms
      FROM k JOIN documents d USING (doc_id) JOIN gold_items g USING (item_id) WHERE n <= 64), c AS (SELECT *, CASE WHEN len(terms) = 0 THEN 0.0 ELSE len(list_filter(terms, lambda w: contains(x, w))) / len(terms)::DOUBLE END AS cov, starts_with(source, 'mission') AS dom FROM t)
    SELECT item_id, doc_id, round(greatest(0.0, 4.0 - 0.05 * (n - 1)) + 5.0 * cov + CASE WHEN dom THEN 7.5 ELSE -2.0 END + CASE WHEN length(x) < 200 THEN -1.5 ELSE 0.0 END + least(4.0, len(regexp_extract_all(x, 'fee')) * 1.25), 6) AS total FROM c""")
def rank_feature_scores(spark, d):
    """Order, coverage of the question's terms, domain, noise and a topic's boost for the 64 best documents of each query"""
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    docs = load(spark, d, "documents")
    s = search.bm25(docs, q, "item_id", "question").withColumn("score", F.round("score", 6))
    t = search.top_k(s, ["item_id"], [F.desc("score"), F.asc("doc_id")], 64, "n").join(docs.select("doc_id", "source", "text"), "doc_id").join(F.broadcast(q), "item_id")  # eight queries
    terms = F.filter(F.array_distinct(F.split(F.regexp_replace(F.lower("question"), "[^a-z0-9 ]", ""), " ")), lambda w: F.length(w) > 3)
    x = F.col("text")
    dom, noisy = F.col("source").startswith("mission"), F.length(F.lower(x)) < 200
    boost = search.topic_boost(x, [("fees", "fee", 1.25, 4.0)], F.lit("fees"))
    total = search.rank_features(F.col("n"), search.term_coverage(terms, x), F.coalesce(dom, F.lit(False)), F.lit(False), noisy, boost)
    return t.select("item_id", "doc_id", F.round(total, 6).alias("total"))


@query(r"SELECT result_id, coalesce(nullif(trim(regexp_extract(model_output, 'Rs\.? ?([0-9,]+)', 1)), ''), nullif(trim(regexp_extract(model_output, '([0-9]+) days', 1)), ''), nullif(trim(category), '')) AS answer FROM " + _S)
def first_extractor(spark, d):
    """The first of several extractors that gives something"""
    t, o = _smoke(spark, d, "model_output", "category"), F.col("model_output")
    return t.select("result_id", evaluation.first_answer(F.regexp_extract(o, r"Rs\.? ?([0-9,]+)", 1), F.regexp_extract(o, "([0-9]+) days", 1), F.col("category")).alias("answer"))


@query("SELECT item_id, min(i) AS hit_rank FROM (SELECT item_id, i, regexp_extract(gold_source_urls[i], '://([^/]*)', 1) AS h FROM (SELECT *, unnest(generate_series(1, len(gold_source_urls))) AS i FROM gold_items)) g WHERE EXISTS (SELECT 1 FROM source_registry r WHERE r.tier = 1 AND (g.h = r.domain OR ends_with(g.h, '.' || r.domain))) GROUP BY 1")
def expected_host_rank(spark, d):
    """The first cited address on a host of the first tier, or below one"""
    hosts = load(spark, d, "source_registry").where("tier = 1").agg(F.array_sort(F.collect_set("domain")).alias("e"))
    g = load(spark, d, "gold_items").crossJoin(F.broadcast(hosts))  # one row
    h = F.transform("gold_source_urls", lambda u: F.regexp_extract(u, "://([^/]*)", 1))
    return g.select("item_id", evaluation.first_hit_rank(h, F.col("e")).cast("bigint").alias("hit_rank")).where("hit_rank is not null")


@query("SELECT g.item_id, CASE WHEN r.refused IS NULL THEN 'missing' ELSE 'wrong_refusal' END AS why FROM gold_items g LEFT JOIN (SELECT item_id, arg_max(model_refused, result_id) AS refused FROM (SELECT DISTINCT item_id, result_id, coalesce(model_refused, false) AS model_refused FROM smoke_results) GROUP BY 1) r ON g.item_id = TRY_CAST(regexp_extract(r.item_id, '([0-9]+)$', 1) AS BIGINT) WHERE g.kind = 'grounded' AND coalesce(r.refused, true)")
def repair_candidates(spark, d):
    """DS3, J20: gold items without a result, or wrongly refused"""
    t = load(spark, d, "smoke_results").select("result_id", "item_id", F.coalesce("model_refused", F.lit(False)).alias("model_refused")).distinct()
    last = joins.last_write(t.select("item_id", "result_id", "model_refused"), "item_id", "result_id").select(F.regexp_extract("item_id", "([0-9]+)$", 1).try_cast("bigint").alias("item_id"), "model_refused").where("item_id is not null")
    return evaluation.repair_rows(last, load(spark, d, "gold_items"), "item_id").select("item_id", "why")


@query("SELECT result_id, CASE question_lang WHEN 'ne' THEN 'जानकारी छैन' ELSE 'No information' END AS answer FROM " + _S + " WHERE kind = 'refusal' ORDER BY md5('s:' || result_id) LIMIT 60")
def hard_negative_rows(spark, d):
    """DS4: sixty seeded rows of a kind with the text of their language (the number is the operator's)"""
    t = _smoke(spark, d, "kind", "question_lang")
    return evaluation.hard_negatives(t, "refusal", "result_id", 60, {"en": "No information", "ne": "जानकारी छैन"}, "question_lang").select("result_id", "answer")


@query("SELECT source_id, name_en AS name FROM (SELECT source_id, name_en, row_number() OVER (PARTITION BY domain ORDER BY length(name_en) DESC, name_en DESC) AS n FROM source_registry WHERE name_en IS NOT NULL) WHERE n = 1")
def longest_names(spark, d):
    """DS12: the longest name of each domain"""
    r = load(spark, d, "source_registry").where("name_en is not null")
    best = evaluation.longest_name(r, "domain", "name_en")
    return r.join(best, ["domain", "name_en"]).groupBy("domain").agg(F.max_by("name_en", "source_id").alias("name"), F.max("source_id").alias("source_id")).select("source_id", "name")


@query("SELECT page_id, arg_min(h, i) AS first_host FROM (SELECT page_id, i, regexp_extract(l, '://([^/?#]*)', 1) AS h FROM (SELECT page_id, unnest(links) AS l, generate_subscripts(links, 1) AS i FROM (SELECT DISTINCT page_id, links FROM parsed_pages))) WHERE h IN (SELECT domain FROM source_registry) GROUP BY 1")
def first_known_host(spark, d):
    """DS14: the first host in the order of each page's links that is registered"""
    p = load(spark, d, "parsed_pages").select("page_id", F.transform("links", lambda x: F.regexp_extract(x, "://([^/?#]*)", 1)).alias("hosts")).distinct()
    return joins.first_available(p, "page_id", "hosts", load(spark, d, "source_registry").select(F.col("domain").alias("first_host")), "first_host")


@query(r"SELECT doc_id, nullif(regexp_extract(lower(replace(url, '://', ':/')), '((?:[a-z0-9-]+\.)+[a-z]{2,})', 1), '') AS host FROM (SELECT DISTINCT doc_id, url FROM crawl_documents WHERE url IS NOT NULL)")
def recovered_hosts(spark, d):
    """DS15: the host inside links whose slashes are lost"""
    return _crawl(spark, d, "url").where("url is not null").select("doc_id", evaluation.embedded_host(F.replace("url", F.lit("://"), F.lit(":/"))).alias("host"))


@query(
    r"""WITH t AS (SELECT r.result_id, r.kind, r.model_output, g.gold_answer FROM """ + _S + r""" r JOIN gold_items g ON g.item_id = TRY_CAST(regexp_extract(r.item_id, '([0-9]+)$', 1) AS BIGINT)),
    v AS (SELECT *, TRY_CAST(replace(regexp_extract_all(model_output, '-?[0-9][0-9,]*(?:\.[0-9]+)?')[-1], ',', '') AS DOUBLE) AS a, TRY_CAST(replace(regexp_extract_all(gold_answer, '-?[0-9][0-9,]*(?:\.[0-9]+)?')[-1], ',', '') AS DOUBLE) AS b FROM t)
    SELECT kind, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN abs(a - b) <= 1e-6 THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM v GROUP BY 1"""
)
def numeric_accuracy(spark, d):
    """Answers whose last number is the gold answer's"""
    t = load(spark, d, "smoke_results").select("result_id", "kind", "model_output", F.regexp_extract("item_id", "([0-9]+)$", 1).try_cast("bigint").alias("item_id")).distinct()
    j = t.join(load(spark, d, "gold_items").select("item_id", "gold_answer"), "item_id")
    return evaluation.accuracy(j, ["kind"], evaluation.numeric_match(F.col("model_output"), F.col("gold_answer"))).select("kind", "n", F.round("accuracy", 9).alias("accuracy"))


@query(
    f"""WITH s AS (SELECT result_id, lower(trim(regexp_replace(x, '{_BLANK}', ' ', 'g'))) AS x FROM (SELECT result_id, unnest(list_filter(list_transform(regexp_extract_all(model_output, '[^.।!?\\n]+[.।!?]*'), lambda x: trim(x)), lambda x: x <> '')) AS x FROM {_S} WHERE model_output IS NOT NULL)),
    n AS (SELECT result_id, max(c) AS c FROM (SELECT result_id, x, count(*) AS c FROM s WHERE length(x) >= 20 GROUP BY ALL) GROUP BY 1) SELECT r.result_id, coalesce(n.c >= 3, false) AS repeated FROM {_S} r LEFT JOIN n USING (result_id) WHERE r.model_output IS NOT NULL"""
)
def repeated_sentences(spark, d):
    """T-16"""
    return _smoke(spark, d, "model_output").where("model_output is not null").select("result_id", evaluation.repeated_sentences(F.col("model_output")).alias("repeated"))


@query(
    f"""WITH s AS (SELECT result_id, x, i FROM (SELECT result_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT result_id, list_filter(list_transform(regexp_extract_all(model_output, '[^.।!?\\n]+[.।!?]*'), lambda x: trim(x)), lambda x: x <> '') AS l FROM {_S} WHERE model_output IS NOT NULL))),
    f AS (SELECT *, regexp_matches(x, '{text.REFUSAL_PATTERN.replace("'", "''")}') AS r FROM s), o AS (SELECT *, sum(r::INT) OVER (PARTITION BY result_id ORDER BY i) AS before FROM f)
    SELECT result_id, CAST(count(*) AS BIGINT) AS sentences, CAST(count(*) FILTER (r AND before > 1) AS BIGINT) AS dropped FROM o GROUP BY 1"""
)
def single_refusals(spark, d):
    """T-15: refusing sentences after the first"""
    t = _smoke(spark, d, "model_output").where("model_output is not null")
    n = lambda c: F.size(F.filter(text.sentences(c), lambda s: text.is_refusal(s)))
    kept = evaluation.single_refusal(F.col("model_output"))
    return t.select("result_id", F.size(text.sentences(F.col("model_output"))).cast("bigint").alias("sentences"), (n(F.col("model_output")) - F.least(n(F.col("model_output")), F.lit(1))).cast("bigint").alias("dropped"), kept.alias("kept")).where("sentences > 0").drop("kept")


@query("SELECT kind, coalesce(avg(chrf) >= 30, false) AS ok_chrf, coalesce(avg(CASE WHEN model_refused THEN 1.0 ELSE 0.0 END) <= 0.2, false) AS ok_refused FROM " + _S + " GROUP BY kind")
def metric_gates(spark, d):
    """DS18: gates over a metrics row of each kind"""
    m = _smoke(spark, d, "kind", "chrf", "model_refused").groupBy("kind").agg(F.avg("chrf").alias("chrf"), F.avg(F.when(F.col("model_refused"), 1.0).otherwise(0.0)).alias("refused"))
    return m.select("kind", *records.gates({"chrf": F.col("chrf"), "refused": F.col("refused")}, {"chrf": ("min", 30.0), "refused": ("max", 0.2)}))


@query("SELECT kind, CAST(sum(CASE WHEN kind = 'grounded' THEN chrf END) * 1000 AS BIGINT) // 1000 AS chrf_total, CAST(count(*) FILTER (kind = 'grounded' AND coalesce(model_refused, false)) AS BIGINT) AS wrongly_refused, CAST(count(*) FILTER (kind = 'refusal' AND coalesce(model_refused, false)) AS BIGINT) AS correctly_refused, CAST(count(*) FILTER (kind = 'ungrounded_attempt' AND NOT coalesce(model_refused, false)) AS BIGINT) AS hallucinations FROM " + _S + " GROUP BY kind")
def scores_by_kind(spark, d):
    """E4"""
    t = _smoke(spark, d, "kind", "chrf", "model_refused").withColumn("s", evaluation.type_score(F.col("kind"), F.col("model_refused"), F.col("chrf"), F.lit(None).cast("double")))
    return t.groupBy("kind").agg(F.floor(F.sum("s.chrf")).alias("chrf_total"), F.count_if("s.wrongly_refused").alias("wrongly_refused"), F.count_if("s.correctly_refused").alias("correctly_refused"), F.count_if("s.hallucination").alias("hallucinations"))


@query("SELECT DISTINCT cycle_id, source_id, errors FROM poll_cycles")
def json_in_noise(spark, d):
    """N: every cycle as fenced JSON with a trailing comma among other text, read back"""
    t = load(spark, d, "poll_cycles").select("cycle_id", "source_id", "errors").distinct()
    raw = F.concat(F.lit("Here it is:\n```json\n"), F.regexp_replace(F.to_json(F.struct("cycle_id", "source_id", "errors")), r"\}$", ",}"), F.lit("\n```\nDone."))
    j = records.tolerant_json(raw, "cycle_id bigint, source_id string, errors int")
    return t.select(j.alias("j")).select("j.cycle_id", "j.source_id", "j.errors")


@query(
    """WITH t AS (SELECT result_id, list_transform(range(1, length(coalesce(question, '')) + 1), lambda i: ascii(substr(question, i, 1))) AS p, list_transform(range(1, length(coalesce(model_output, '')) + 1), lambda i: ascii(substr(model_output, i, 1))) AS a FROM """ + _S + """),
    k AS (SELECT result_id, a[1:96] AS tail, CASE WHEN len(a) >= 96 THEN [] ELSE p[greatest(len(p) - (96 - len(a)) + 1, 1):] END AS head FROM t)
    SELECT result_id, len(head) AS prompt_ids, len(tail) AS answer_ids, CAST(list_sum(list_concat(head, tail)) AS BIGINT) AS id_sum, 96 AS padded FROM k"""
)
def sequence_budgets(spark, d):
    """DS16, DS17: code points of question and answer within 96, the answer kept, padded to the right"""
    codes = lambda c: F.transform(F.filter(F.split(F.coalesce(c, F.lit("")), ""), lambda x: x != ""), lambda x: F.ascii(x))
    t = _smoke(spark, d, "question", "model_output").withColumn("b", records.fit_budget(codes(F.col("question")), codes(F.col("model_output")), 96))
    head = F.size(F.filter("b.labels", lambda x: x == -100))
    total = F.aggregate("b.input_ids", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return t.select("result_id", head.cast("bigint").alias("prompt_ids"), (F.size("b.labels") - head).cast("bigint").alias("answer_ids"), F.when(F.size("b.input_ids") > 0, total).alias("id_sum"), F.size(records.pad_right(F.col("b.input_ids"), F.lit(96), 0)).alias("padded"))


@query(
    """WITH t AS (SELECT DISTINCT cv_id, coalesce(before_deva, 0) AS d, coalesce(before_latin, 0) AS l, coalesce(pages, 0) AS p, length(coalesce(preview_before, '')) AS n, coalesce(nepali_word_hits_after, 0) // 40 AS hits, coalesce(before_ratio, 0) AS share,
      coalesce(len(regexp_extract_all(coalesce(preview_before, ''), '[{}\\[\\]|;/]')) / nullif(length(preview_before), 0)::DOUBLE, 0) AS marks, len(regexp_extract_all(lower(coalesce(preview_before, '')), '\\b(?:the|of|and)\\b')) >= 3 AS e FROM converter_validation),
    k AS (SELECT *, hits >= 3 OR (hits >= 2 AND (marks >= 0.02 OR NOT e)) OR (d < 20 AND l > 100 AND marks >= 0.05 AND NOT e) AS legacy FROM t),
    r AS (SELECT *, CASE WHEN p > 0 AND n < 100 THEN 'C' WHEN d >= 50 AND legacy THEN 'Mixed' WHEN d >= 50 THEN 'A' WHEN legacy THEN 'BPreeti' WHEN d < 20 AND (l > 50 OR n > 500) THEN CASE WHEN e THEN 'E' ELSE 'BLegacyUnknown' END ELSE 'Unknown' END AS tier FROM k)
    SELECT DISTINCT cv_id, tier, CASE WHEN tier = 'A' AND d >= 200 AND share >= 0.15 OR tier = 'BPreeti' AND hits >= 5 THEN 'high' WHEN tier IN ('Unknown', 'BLegacyUnknown') THEN 'low' ELSE 'medium' END AS confidence FROM r""".replace("\\\\", "\\")
)
def pdf_tiers(spark, d):
    """Tier and confidence from the counts of every conversion"""
    t = load(spark, d, "converter_validation")
    c, text_ = F.col, F.coalesce("preview_before", F.lit(""))
    marks = F.try_divide(F.regexp_count(text_, F.lit(r"[{}\[\]|;/]")).cast("double"), F.length("preview_before"))
    english = F.regexp_count(F.lower(text_), F.lit(r"\b(?:the|of|and)\b")) >= 3
    x = script.pdf_tier(c("before_deva"), c("before_latin"), F.length(text_), c("pages"), F.floor(F.coalesce("nepali_word_hits_after", F.lit(0)) / 40), marks, c("before_ratio"), english)
    return t.select("cv_id", x.alias("x")).select("cv_id", "x.tier", "x.confidence").distinct()


_LANG = """deva AS (SELECT result_id, question, model_output, len(regexp_extract_all(question, '[ऀ-ॿ]')) AS qd, len(regexp_extract_all(question, '[A-Za-z]')) AS ql, len(regexp_extract_all(coalesce(model_output, ''), '[ऀ-ॿ]')) AS ad, len(regexp_extract_all(coalesce(model_output, ''), '[A-Za-z]')) AS al FROM """ + _S + " WHERE question IS NOT NULL)"


@query(
    f"""WITH {_LANG}, l AS (SELECT *, CASE WHEN qd + ql = 0 THEN 'english' WHEN qd / (qd + ql)::DOUBLE > 0.5 THEN 'devanagari' WHEN regexp_matches(question, '(?i)\\b(?:{"|".join(script.SERVER_ROMAN)})\\b') THEN 'roman_nepali' ELSE 'english' END AS server,
      CASE WHEN qd > 0 AND qd >= ql THEN 'devanagari' WHEN regexp_matches(question, '(?i)\\b(?:{"|".join(script.NAVIGATOR_ROMAN)})\\b') THEN 'roman_nepali' ELSE 'english' END AS navigator FROM deva)
    SELECT result_id, server, navigator, CASE server WHEN 'english' THEN ad > greatest(24, al * 0.20) WHEN 'roman_nepali' THEN ad > greatest(12, al * 0.08) ELSE false END AS mismatch FROM l"""
)
def question_languages(spark, d):
    """Two rules for a question's language, and answers in another script"""
    t, q = _smoke(spark, d, "question", "model_output").where("question is not null"), F.col("question")
    t = t.withColumn("server", script.server_language(q))
    return t.select("result_id", "server", script.navigator_language(q).alias("navigator"), script.answer_script_mismatch(F.col("model_output"), F.col("server")).alias("mismatch"))


@query(
    r"""WITH t AS (SELECT result_id, model_output, list_filter(regexp_extract_all(lower(model_output), '[\p{L}\p{N}_ऀ-ॿ]+'), lambda w: length(w) >= 3) AS w FROM """ + _S + r""" WHERE model_output IS NOT NULL),
    g AS (SELECT result_id, max(c) AS c FROM (SELECT result_id, g, count(*) AS c FROM (SELECT result_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT *, unnest(generate_series(1, len(w) - 2)) AS i FROM t WHERE len(w) >= 20)) GROUP BY ALL) GROUP BY 1)
    SELECT t.result_id, coalesce(g.c >= 4, false) AS looping FROM t LEFT JOIN g USING (result_id)"""
)
def phrase_loops(spark, d):
    """T-17, A28"""
    return _smoke(spark, d, "model_output").where("model_output is not null").select("result_id", text.phrase_loop(F.col("model_output")).alias("looping"))


@query(
    r"""WITH w AS (SELECT source, doc_id, len(regexp_split_to_array(text, '""" + _BLANK + r"""')) AS n, len(list_filter(regexp_split_to_array(text, '""" + _BLANK + r"""'), lambda w: regexp_matches(w, '[ऀ-ॿ]') AND regexp_matches(regexp_replace(regexp_replace(w, '^[^\p{L}\p{M}\p{N}]+', ''), '[^\p{L}\p{M}\p{N}]+$', ''), '[A-Za-z0-9{}|\[\]*+=<>^~@#$%&]'))) AS bad FROM documents WHERE text IS NOT NULL)
    SELECT source, CAST(count(*) AS BIGINT) AS docs, CAST(count(*) FILTER (bad > 0) AS BIGINT) AS flagged, round(count(*) FILTER (bad > 0) / count(*)::DOUBLE, 9) AS share FROM w GROUP BY 1 ORDER BY share DESC, docs DESC, source LIMIT 20"""
)
def garbled_by_source(spark, d):
    """The twenty sources with the largest share of documents that hold garbled tokens (the report's length)"""
    t = _docs(spark, d).select("source", (F.size(records.garbled_tokens(F.col("text"))) > 0).alias("bad"))
    g = t.groupBy("source").agg(F.count("*").alias("docs"), F.count_if("bad").alias("flagged"))
    g = g.select("source", "docs", "flagged", F.round(F.col("flagged") / F.col("docs"), 9).alias("share"))
    return g.orderBy(F.desc("share"), F.desc("docs"), F.asc_nulls_last("source")).limit(20)


@query(
    """WITH d AS (SELECT coalesce(category, 'other') AS category, question, CAST(sum(CASE kind WHEN 'grounded' THEN 10 WHEN 'refusal' THEN 2 ELSE 0 END) AS BIGINT) AS demand, CAST(count(*) AS BIGINT) AS n, min(result_id) AS first FROM """ + _S + """ WHERE question IS NOT NULL GROUP BY 1, 2)
    SELECT category, question, demand, n, CAST(k AS BIGINT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, question) AS k FROM d) WHERE k <= 8"""
)
def top_demand(spark, d):
    """The eight most frequent questions of each category with their weighted demand (eight are the report)"""
    t = _smoke(spark, d, F.coalesce("category", F.lit("other")).alias("category"), "question", "kind").where("question is not null")
    weight = F.when(F.col("kind") == "grounded", 10).when(F.col("kind") == "refusal", 2).otherwise(0)
    g = t.groupBy("category", "question").agg(F.sum(weight).cast("bigint").alias("demand"), F.count("*").alias("n"))
    return search.top_k(g, ["category"], [F.desc("n"), F.asc("question")], 8, "place").select("category", "question", "demand", "n", F.col("place").cast("bigint"))


@query("SELECT r.source_id, r.status, CAST(count(DISTINCT d.doc_id) AS BIGINT) AS docs FROM source_registry r LEFT JOIN (SELECT DISTINCT doc_id, source_id FROM crawl_documents) d USING (source_id) GROUP BY ALL")
def file_to_source_map(spark, d):
    """Files to sources by a derived key, files without one left out"""
    t = _crawl(spark, d, "source_id").where("source_id is not null").groupBy("source_id").agg(F.count("*").alias("docs"))
    return load(spark, d, "source_registry").select("source_id", "status").join(t, "source_id", "left").select("source_id", "status", F.coalesce("docs", F.lit(0).cast("bigint")).alias("docs"))


@query("WITH e AS (SELECT user_id || ':' || CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, event_type FROM events) SELECT day, event_id FROM e WHERE day IN (SELECT day FROM e GROUP BY 1 HAVING count(*) = count(*) FILTER (event_type <> 'error'))")
def clean_user_days(spark, d):
    """days of users all of whose events are good"""
    e = load(spark, d, "events").select(F.concat_ws(":", F.col("user_id").cast("string"), F.to_date(F.col("ts").cast("timestamp")).cast("string")).alias("day"), "event_id", "event_type")
    return filters.children_all(e, e, "day", F.col("event_type") != "error").select("day", "event_id")


@query("SELECT * FROM (SELECT DISTINCT on (event_id) event_id, user_id FROM events)")
def insert_or_ignore(spark, d):
    """Half of the events are there, all are inserted: the new ones come in once"""
    e = load(spark, d, "events").select("event_id", "user_id")
    return lifecycle.insert_new(e.where("event_id % 2 = 0"), e.unionByName(e), "event_id")


@query()
def corpus_score_by_kind(spark, d):
    """BLEU and chrF++ of answers against their questions by kind (tested against brute force)"""
    return metrics.corpus_scores(_smoke(spark, d, "kind", "question", "model_output"), ["kind"], F.col("model_output"), F.col("question"))


_CASE_RULES = [("service", "passport", "passport"), ("service", "passport", "राहदानी"), ("service", "citizenship", "citizenship"), ("service", "citizenship", "नागरिकता"), ("service", "licence", "driving licence"), ("action", "fee", "fee"), ("action", "fee", "दस्तुर"), ("action", "complaint", "complaint")]


def _case_sql(slot: str) -> str:
    """Best value of a slot, stated for each value in turn."""
    from sifterra.operators.cases import alias_points

    values = list(dict.fromkeys(v for s, v, _ in _CASE_RULES if s == slot))
    points = {v: " + ".join(f"CASE WHEN contains(q, '{a if ' ' in a or not a.isascii() else ' ' + a + ' '}') THEN {alias_points(a)} ELSE 0 END" for s, w, a in _CASE_RULES if (s, w) == (slot, v)) for v in values}
    best = ", ".join(f"({p})" for p in points.values())
    return f"CASE WHEN greatest({best}) = 0 THEN NULL " + " ".join(f"WHEN ({p}) = greatest({best}) THEN '{v}'" for v, p in points.items()) + " END"


@query(
    r"WITH t AS (SELECT result_id, ' ' || regexp_replace(lower(coalesce(question, '')), '[^\p{L}\p{M}\p{N}]+', ' ', 'g') || ' ' AS q FROM ".replace("\\\\", "\\") + _S + f"), s AS (SELECT result_id, {_case_sql('service')} AS service, {_case_sql('action')} AS action FROM t)"
    " SELECT result_id, service, action, CASE WHEN service IS NULL THEN 'partial_answer_plus_followup' WHEN action = 'complaint' THEN 'complaint_handoff_or_retrieve' ELSE 'retrieve_then_answer' END AS decision FROM s"
)
def question_cases(spark, d):
    """Service and action of every question by alias rules, and the next step"""
    t = _smoke(spark, d, "question")
    s = cases.resolve_slots(t, "result_id", F.col("question"), _CASE_RULES)
    no = F.lit(False)
    c = cases.contract(F.col("slots"), F.lit("english"), no, no, [(None, None, ["service"])], {"service": {"english": "Which service?"}})
    return s.select("result_id", c.alias("c")).select("result_id", "c.service", "c.action", "c.decision")


@query(f"WITH {_BM25}, h AS (SELECT item_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS r FROM s) SELECT h.item_id, h.doc_id, d.source, r.name_en AS name FROM h JOIN documents d USING (doc_id) LEFT JOIN source_registry r ON r.source_id = d.source WHERE h.r <= 10 AND d.text IS NOT NULL")
def matched_documents_with_sources(spark, d):
    """The ten best matches of each query joined to their documents and sources"""
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    docs = load(spark, d, "documents")
    s = search.bm25(docs, q, "item_id", "question").withColumn("score", F.round("score", 6))
    top = search.top_k(s, ["item_id"], [F.desc("score"), F.asc("doc_id")], 10)
    names = load(spark, d, "source_registry").select(F.col("source_id").alias("source"), F.col("name_en").alias("name"))
    return top.join(docs.where("text is not null").select("doc_id", "source"), "doc_id").join(names, "source", "left").select("item_id", "doc_id", "source", "name")


@query("SELECT source, doc_type, CAST(count(*) AS BIGINT) AS docs, CAST(coalesce(sum(len(regexp_extract_all(text, 'https?://'))), 0) AS BIGINT) AS links, CAST(coalesce(sum(len(regexp_extract_all(text, '[0-9०-९]+'))), 0) AS BIGINT) AS numbers, CAST(coalesce(sum(len(regexp_extract_all(text, '\\?'))), 0) AS BIGINT) AS questions FROM documents GROUP BY ALL".replace("\\\\", "\\"))
def quality_by_source(spark, d):
    """Documents by source and kind with the hits of three patterns"""
    n = lambda p: F.coalesce(F.sum(F.regexp_count("text", F.lit(p))), F.lit(0)).cast("bigint")
    return load(spark, d, "documents").groupBy("source", "doc_type").agg(F.count("*").alias("docs"), n("https?://").alias("links"), n("[0-9०-९]+").alias("numbers"), n(r"\?").alias("questions"))


@query(
    r"""WITH r AS (SELECT result_id, suite, model_output AS o, list_filter(regexp_extract_all(lower(model_output), '[\p{L}\p{N}_ऀ-ॿ]+'), lambda w: length(w) >= 3) AS w FROM """ + _S + r"""),
    g AS (SELECT result_id, max(c) >= 4 AS looping FROM (SELECT result_id, g, count(*) AS c FROM (SELECT result_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT *, unnest(generate_series(1, len(w) - 2)) AS i FROM r WHERE len(w) >= 20)) GROUP BY ALL) GROUP BY 1)
    SELECT suite, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (o IS NULL OR NOT regexp_matches(o, '[^\s\x{00A0}]')) AS BIGINT) AS degenerate, CAST(count(*) FILTER (coalesce(looping, false)) AS BIGINT) AS looping,
      CAST(count(*) FILTER (len(list_filter(regexp_split_to_array(o, '""" + _BLANK + r"""'), lambda w: regexp_matches(w, '[ऀ-ॿ]') AND regexp_matches(regexp_replace(regexp_replace(w, '^[^\p{L}\p{M}\p{N}]+', ''), '[^\p{L}\p{M}\p{N}]+$', ''), '[A-Za-z0-9{}|\[\]*+=<>^~@#$%&]'))) > 0) AS BIGINT) AS garbled,
      CAST(count(*) FILTER (coalesce(regexp_matches(o, '""" + text.REFUSAL_PATTERN.replace("'", "''") + r"""'), false)) AS BIGINT) AS refusing, round(avg(length(o)), 1) AS mean_chars FROM r LEFT JOIN g USING (result_id) GROUP BY suite"""
)
def sweep_counts(spark, d):
    """Degenerate, looping, garbled and refusing answers of each suite, and their mean length"""
    t, o = _smoke(spark, d, "suite", "model_output"), F.col("model_output")
    return t.groupBy("suite").agg(
        F.count("*").alias("n"), F.count_if(text.is_blank(o)).alias("degenerate"), F.count_if(F.coalesce(text.phrase_loop(o), F.lit(False))).alias("looping"), F.count_if(F.size(records.garbled_tokens(o)) > 0).alias("garbled"),
        F.count_if(text.is_refusal(o)).alias("refusing"), F.round(F.avg(F.length(o)), 1).alias("mean_chars"),
    )


@query("SELECT result_id, 'Q: ' || question AS row FROM " + _S + " WHERE question IS NOT NULL UNION ALL SELECT result_id, 'A: ' || model_output FROM " + _S + " WHERE model_output IS NOT NULL AND kind = 'grounded'")
def training_rows(spark, d):
    """DS5: one training row or two of each record"""
    t = _smoke(spark, d, "question", "model_output", "kind")
    return evaluation.one_or_two(t, F.concat(F.lit("Q: "), "question"), F.when(F.col("kind") == "grounded", F.concat(F.lit("A: "), "model_output"))).select("result_id", "row")
