"""Queries over documents, chunks and pages: scalars, chunking, curation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifterra.functions import ids, script, text, url
from sifterra.functions import html as H
from sifterra.operators import chunking, lifecycle, sampling
from sifterra.plans.registry import ORACLES, query
from sifterra.session import broadcast_if_small, load

_SQUEEZE = r"trim(regexp_replace({t}, '[\s\x{{00A0}}\x{{0085}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{1680}}]+', ' ', 'g'))"
_TOKENS = r"list_filter(list_transform(regexp_split_to_array({t}, '[\s\x{{00A0}}\x{{0085}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{1680}}]+'), lambda w: lower(regexp_replace(w, '[^A-Za-z0-9ऀ-ॿ]', '', 'g'))), lambda w: length(w) >= 2)"


@query("SELECT doc_id, " + _SQUEEZE.format(t="text") + " AS clean FROM documents WHERE text IS NOT NULL")
def whitespace_normalize(spark, d):
    """T-1"""
    return load(spark, d, "documents").where("text is not null").select("doc_id", text.squeeze(F.col("text")).alias("clean"))


@query(
    """
    SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[ऀ-ॿ]')), 0) AS BIGINT) AS deva, CAST(coalesce(len(regexp_extract_all(text, '[A-Za-z]')), 0) AS BIGINT) AS latin,
      CAST(coalesce(len(regexp_extract_all(text, '[A-Za-zऀ-ॿ]')), 0) AS BIGINT) AS substantive FROM documents WHERE text IS NOT NULL"""
)
def script_counts(spark, d):
    """L2, L9"""
    t = F.col("text")
    return load(spark, d, "documents").where("text is not null").select("doc_id", script.devanagari_count(t).cast("bigint").alias("deva"), script.latin_count(t).cast("bigint").alias("latin"), script.substantive_chars(t).cast("bigint").alias("substantive"))


_BUCKET = r"""
    WITH w AS (SELECT {key}, {text} AS t, list_filter(regexp_split_to_array({text}, '[\s\x{{00A0}}\x{{0085}}\x{{2028}}\x{{2029}}\x{{3000}}]+'), lambda x: x <> '') AS ws FROM {table} WHERE {text} IS NOT NULL),
    c AS (SELECT {key}, t, ws, length(t) AS n, len(regexp_extract_all(t, '[ऀ-ॿ]')) AS dv, len(regexp_extract_all(t, '[A-Za-z]')) AS la,
      list_filter(ws, lambda x: regexp_matches(x, '[ऀ-ॿ]')) AS dw FROM w),
    r AS (SELECT *, CASE WHEN len(ws) < 20 OR len(dw) = 0 THEN 0.0 ELSE len(list_filter(dw, lambda x: regexp_matches(x, 'ाा|िि|ीी|ुु|ूू|ेे|ैै|ोो|ौौ|ंं|ःः|ृृ')
        OR regexp_matches(regexp_replace(regexp_replace(x, '^[^\p{{L}}\p{{N}}ऀ-ॿ]+', ''), '[^\p{{L}}\p{{N}}ऀ-ॿ]+$', ''), '[^ऀ-ॿ]'))) / len(dw)::DOUBLE END AS hybrid,
      CASE WHEN len(ws) < 20 THEN 0.0 ELSE len(list_filter(ws, lambda x: regexp_matches(x, '^.+[{{}}|\[\]].+$'))) / len(ws)::DOUBLE END AS brace FROM c)
    SELECT {key}, CASE WHEN n = 0 OR dv + la < 50 THEN 'other'
      WHEN dv / n::DOUBLE > 0.10 AND la / n::DOUBLE > 0.10 THEN CASE WHEN hybrid >= 0.10 THEN 'mojibake_suspected' ELSE 'mixed' END
      WHEN dv / n::DOUBLE > 0.15 THEN CASE WHEN hybrid >= 0.10 THEN 'mojibake_suspected' ELSE 'devanagari' END
      WHEN la / n::DOUBLE > 0.15 THEN CASE WHEN brace > 0.05 THEN 'mojibake_suspected' ELSE 'latin' END ELSE 'other' END AS bucket FROM r"""


def _bucketed(df):
    """Adds the script counts, then the bucket from them."""
    t = F.col("text")
    counted = df.withColumn("deva", script.devanagari_count(t)).withColumn("latin", script.latin_count(t))
    return counted.withColumn("bucket", script.script_bucket(t, F.col("deva"), F.col("latin")))


@query(_BUCKET.format(key="doc_id", text="text", table="documents"))
def language_bucket(spark, d):
    """L1, L3, L4 over documents"""
    return _bucketed(load(spark, d, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", "bucket")


@query("SELECT bucket, tier, CAST(count(*) AS BIGINT) AS n FROM (" + _BUCKET.format(key="cv_id, tier", text="preview_before", table="(SELECT DISTINCT cv_id, tier, preview_before FROM converter_validation)") + ") GROUP BY bucket, tier")
def legacy_bucket_by_tier(spark, d):
    """L1, L4, A21 over legacy-font previews"""
    t = load(spark, d, "converter_validation").select("cv_id", "tier", "preview_before").distinct().where("preview_before is not null")
    return t.groupBy(script.script_bucket(F.col("preview_before")).alias("bucket"), "tier").agg(F.count("*").alias("n"))


@query(
    """
    WITH starts AS (SELECT doc_id, text, length(text) AS n, unnest(generate_series(0, CASE WHEN length(text) < 200 THEN 0 ELSE length(text) - 1 END, 1620)) AS s FROM documents WHERE length(text) > 0),
    ends AS (SELECT *, least(s + 1800, n) AS want, substr(text, CAST(least(s + 1800, n) + 1 AS BIGINT), 121) AS ahead FROM starts),
    cut AS (SELECT *, CASE WHEN n < 200 OR want >= n THEN 0 ELSE least(
        CASE WHEN regexp_matches(substr(ahead, 1, 120), '[।?!]') THEN length(regexp_extract(substr(ahead, 1, 120), '^([^।?!]*)[।?!]', 1)) + 1 ELSE 9999 END,
        CASE WHEN regexp_matches(ahead, '(?s)^.{0,119}?\\.\\s') THEN length(regexp_extract(ahead, '(?s)^(.{0,119}?)\\.\\s', 1)) + 1 ELSE 9999 END,
        CASE WHEN strpos(ahead, chr(10) || chr(10)) BETWEEN 1 AND 120 THEN strpos(ahead, chr(10) || chr(10)) + 1 ELSE 9999 END) END AS hit FROM ends),
    e AS (SELECT doc_id, text, n, s, CASE WHEN n < 200 THEN n WHEN hit BETWEEN 1 AND 9998 THEN want + hit ELSE want END AS e FROM cut),
    k AS (SELECT *, lag(e) OVER (PARTITION BY doc_id ORDER BY s) AS pe, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS i FROM e)
    SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(s AS INTEGER) AS char_start, CAST(e AS INTEGER) AS char_end, CAST(length(substr(text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT))) AS INTEGER) AS chars
    FROM k WHERE pe IS NULL OR pe < n"""
)
def chunk_fixed_target(spark, d):
    """T-2"""
    c = chunking.chunk_documents(load(spark, d, "documents"))
    return c.select("doc_id", "chunk_index", "char_start", "char_end", F.length("text").alias("chars"))


# The index as four bytes, the lowest first.
_U32 = "unhex(printf('%02x%02x%02x%02x', i & 255, (i >> 8) & 255, (i >> 16) & 255, (i >> 24) & 255))"


@query(
    "WITH c AS (" + ORACLES["chunk_fixed_target"] + "), x AS (SELECT doc_id, chunk_index, CAST(chunk_index AS BIGINT) AS i, substr(text, CAST(char_start + 1 AS BIGINT), CAST(char_end - char_start AS BIGINT)) AS piece FROM c JOIN documents USING (doc_id))"
    " SELECT doc_id, chunk_index, left(sha256(encode(CAST(doc_id AS VARCHAR)) || '\\x00'::BLOB || " + _U32 + " || '\\x00'::BLOB || encode(piece)), 24) AS chunk_id FROM x"
)
def chunk_ids_all(spark, d):
    """Ids of all chunks of all documents"""
    return chunking.chunk_documents(load(spark, d, "documents")).select("doc_id", "chunk_index", "chunk_id")


# Where a window that begins at st ends: after the last mark in its last quarter, else at its hard end.
_BACKWARD_END = r"CASE WHEN hard < length(text) AND regexp_matches(substr(text, low + 1, hard - low), '[.।!?\n]') THEN low + length(regexp_extract(substr(text, low + 1, hard - low), '(?s)^(.*[.।!?\n])', 1)) ELSE hard END"
_WHITE = r"[\s\x{001C}-\x{001F}\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]+"


@query(
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, text, 0 AS st FROM documents WHERE length(text) > 0 UNION ALL SELECT doc_id, text, greatest(e - 80, st + 1) FROM (SELECT *, """
    + _BACKWARD_END
    + r""" AS e FROM (SELECT *, greatest(hard - 150, st + 100) AS low FROM (SELECT *, least(st + 600, length(text)) AS hard FROM w))) WHERE e < length(text)),
    c AS (SELECT doc_id, st, """
    + _BACKWARD_END
    + " AS e, text FROM (SELECT *, greatest(hard - 150, st + 100) AS low FROM (SELECT *, least(st + 600, length(text)) AS hard FROM w))),"
    + f" p AS (SELECT doc_id, st, e, regexp_replace(regexp_replace(substr(text, st + 1, e - st), '^{_WHITE}', ''), '{_WHITE}$', '') AS piece FROM c)"
    " SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1 AS INTEGER) AS chunk_index, st AS char_start, e AS char_end, piece AS text FROM p WHERE octet_length(encode(piece)) >= 100"
)
def chunk_backward(spark, d):
    """T-3"""
    return chunking.chunk_backward(load(spark, d, "documents"))


@query("SELECT DISTINCT doc_id, left(sha256(url), 16) AS url_hash, 'blobs/' || source_id || '/' || left(content_hash, 2) || '/' || content_hash || '.' || doc_type AS path FROM crawl_documents WHERE url IS NOT NULL AND content_hash IS NOT NULL AND source_id IS NOT NULL AND doc_type IS NOT NULL")
def content_paths(spark, d):
    """I, S15"""
    t = load(spark, d, "crawl_documents").where("url is not null and content_hash is not null and source_id is not null and doc_type is not null")
    return t.select("doc_id", ids.content_hash(F.col("url")).alias("url_hash"), ids.blob_path(F.col("source_id"), F.col("content_hash"), F.col("doc_type")).alias("path")).distinct()


@query(
    """
    WITH kept AS (SELECT doc_id, source, left(sha256(trim(text)), 16) AS h FROM documents WHERE length(trim(text)) > 0)
    SELECT doc_id, source, h AS body_hash FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS n FROM kept) WHERE n = 1"""
)
def exact_dedup_hash(spark, d):
    """W5, I: the first of equal bodies"""
    t = load(spark, d, "documents").where(F.length(F.trim("text")) > 0).select("doc_id", "source", ids.content_hash(F.trim("text")).alias("body_hash"))
    return t.groupBy("body_hash").agg(F.min_by(F.struct("doc_id", "source"), "doc_id").alias("m")).select("m.doc_id", "m.source", "body_hash")


@query(
    """
    WITH c AS (SELECT DISTINCT chunk_id, doc_id, chunk_index, text FROM chunks), s AS (SELECT DISTINCT doc_id, source_id FROM crawl_documents WHERE source_id IS NOT NULL),
    j AS (SELECT c.chunk_id, s.source_id, c.text, c.doc_id, c.chunk_index FROM c JOIN s USING (doc_id) WHERE c.text IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY source_id, sha256(text) ORDER BY doc_id, chunk_index, chunk_id) AS n FROM j)
    SELECT chunk_id, source_id FROM r WHERE n <= 3"""
)
def boilerplate_cap3(spark, d):
    """At most three copies of a chunk per source. The window carries hashes, not texts."""
    c = load(spark, d, "chunks").where("text is not null").select("chunk_id", "doc_id", "chunk_index", F.sha2("text", 256).alias("h")).distinct()
    s = load(spark, d, "crawl_documents").where("source_id is not null").select("doc_id", "source_id").distinct()
    return sampling.cap_per_key(c.join(s, "doc_id"), ["source_id", "h"], [F.col("doc_id"), F.col("chunk_index"), F.col("chunk_id")], 3).select("chunk_id", "source_id")


@query(
    r"""
    WITH g AS (SELECT chunk_id, max(c) AS best FROM (SELECT chunk_id, substr(text, i, 30) AS w, count(*) AS c FROM (SELECT chunk_id, text, unnest(generate_series(1, length(text) - 29)) AS i FROM (SELECT DISTINCT chunk_id, text FROM chunks WHERE length(text) >= 120)) GROUP BY 1, 2) GROUP BY 1)
    SELECT chunk_id, best >= 4 AS repetitive FROM g UNION ALL SELECT DISTINCT chunk_id, false FROM chunks WHERE length(text) < 120"""
)
def repetition_window(spark, d):
    """T-4"""
    return load(spark, d, "chunks").where("text is not null").select("chunk_id", "text").distinct().select("chunk_id", text.repeats_window(F.col("text")).alias("repetitive"))


@query(
    """
    WITH b AS ("""
    + _BUCKET.format(key="doc_id", text="text", table="documents")
    + """)
    SELECT coalesce(reason, 'kept') AS drop_reason, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT CASE WHEN d.text IS NULL OR length(d.text) = 0 THEN 'empty' WHEN len(regexp_extract_all(d.text, '[A-Za-zऀ-ॿ]')) < 100 THEN 'short' WHEN b.bucket = 'other' THEN 'other'
        WHEN b.bucket = 'mojibake_suspected' THEN 'mojibake' END AS reason FROM documents d LEFT JOIN b USING (doc_id)) GROUP BY 1"""
)
def filter_drop_reasons(spark, d):
    """F8: the first failing rule of each document, counted"""
    t = F.col("text")
    d1 = _bucketed(load(spark, d, "documents").select("text"))
    reason = F.when(t.isNull() | (F.length(t) == 0), "empty").when(F.col("deva") + F.col("latin") < 100, "short").when(F.col("bucket") == "other", "other").when(F.col("bucket") == "mojibake_suspected", "mojibake").otherwise("kept")
    return d1.groupBy(reason.alias("drop_reason")).agg(F.count("*").alias("n"))


_PARTS = r"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract({u}, '^[^?#]*\?([^#]*)', 1) AS q"
_NORM = r"""
  SELECT *, CASE WHEN p3 = '' THEN '/' ELSE p3 END AS npath, list_aggregate(list_sort(list_transform(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(split_part(x, '=', 1), 'utm_')
      AND split_part(x, '=', 1) NOT IN ('fbclid','gclid','msclkid','dclid','ref','referrer','source','_ga','_gl','mc_cid','mc_eid')), lambda x: split_part(x, '=', 1) || '=' || CASE WHEN strpos(x, '=') > 0 THEN regexp_replace(x, '^[^=]*=', '') ELSE '' END)), 'string_agg', '&') AS nq
  FROM (SELECT *, CASE WHEN length(p2) > 1 THEN regexp_replace(p2, '/$', '') ELSE p2 END AS p3 FROM (SELECT *, regexp_replace(regexp_replace(path, '/index\.(html|htm|php)$', ''), '/{2,}', '/', 'g') AS p2 FROM (
    SELECT DISTINCT url, """ + _PARTS.format(u="url") + r""" FROM parsed_pages WHERE url IS NOT NULL)))"""


@query("SELECT url, scheme || '://' || regexp_replace(host, ':(80|443)$', '') || npath || CASE WHEN coalesce(nq, '') <> '' THEN '?' || nq ELSE '' END AS canonical FROM (" + _NORM + ")")
def url_canonicalize(spark, d):
    """U1-U3 over pages"""
    return load(spark, d, "parsed_pages").where("url is not null").select("url").distinct().select("url", url.canonical_url(F.col("url")).alias("canonical"))


@query(
    "SELECT canonical, CAST(count(*) AS BIGINT) AS docs FROM (SELECT DISTINCT doc_id, lower(regexp_extract(url, '://(?:www\\.)?([^/?#]*)', 1)) || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') || CASE WHEN regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) <> '' THEN '?' || regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) ELSE '' END AS canonical FROM crawl_documents WHERE url IS NOT NULL) GROUP BY 1 HAVING count(*) > 1"
)
def duplicate_canonical_urls(spark, d):
    """Addresses that more than one document has"""
    t = load(spark, d, "crawl_documents").where("url is not null").select("doc_id", url.audit_url(F.col("url")).alias("canonical")).distinct()
    return t.groupBy("canonical").agg(F.count("*").alias("docs")).where("docs > 1")


@query(
    r"""SELECT class, CAST(count(*) AS BIGINT) AS pages FROM (SELECT CASE
      WHEN regexp_extract(lower(regexp_extract(path, '[^/]*$')), '^.+(\.[a-z0-9]{1,6})$', 1) IN ('.pdf','.doc','.docx','.xls','.xlsx','.ppt','.pptx','.txt','.csv') THEN 'document'
      WHEN list_has_any(string_split(lower(path), '/'), ['category','categories','archive','archives']) THEN 'listing'
      WHEN list_has_any(string_split(lower(path), '/'), ['content','post','posts','download','downloads','notice','notices','circular','circulars','act','acts','rule','rules','bulletin','bulletins','announcement','announcements']) THEN 'content_page'
      WHEN TRY_CAST(regexp_extract(q, '(?:^|&)(?:page|p|pg|pageno)=([0-9]{1,9})(?:&|$)', 1) AS INTEGER) <= 5 THEN 'listing'
      WHEN list_has_any(string_split(lower(path), '/'), ['gallery','carousel','team','staff','contact','contacts','map','tag','tags']) THEN 'low_value' ELSE 'navigation' END AS class
      FROM (SELECT """ + _PARTS.format(u="url") + r""" FROM (SELECT DISTINCT doc_id, url FROM crawl_documents WHERE url IS NOT NULL))) GROUP BY 1"""
)
def url_audit_histogram(spark, d):
    """Crawl addresses by class"""
    t = load(spark, d, "crawl_documents").where("url is not null").select("doc_id", "url").distinct()
    return t.groupBy(url.url_class(F.col("url")).alias("class")).agg(F.count("*").alias("pages"))


@query("SELECT page_id, regexp_replace(trim(url), '/+$', '') AS scored, regexp_replace(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(https?://)www\\.', '\\1'), '/+$', '') AS fetched, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS host_path FROM (SELECT DISTINCT page_id, url FROM parsed_pages WHERE url IS NOT NULL)")
def url_normalizers(spark, d):
    """U8, U9, U11"""
    u = F.col("url")
    t = load(spark, d, "parsed_pages").where("url is not null").select("page_id", "url").distinct()
    return t.select("page_id", url.scored_url(u).alias("scored"), url.fetch_url(u).alias("fetched"), url.host_path(u).alias("host_path"))


@query(
    "SELECT source_id, url, depth, CAST(row_number() OVER (PARTITION BY source_id ORDER BY score DESC, depth, url) AS BIGINT) AS place FROM (SELECT source_id, url, min(depth) AS depth, max(priority_at_fetch) AS score FROM crawl_documents WHERE url IS NOT NULL AND source_id IS NOT NULL AND depth IS NOT NULL GROUP BY ALL) QUALIFY place <= 20"
)
def frontier_order(spark, d):
    """The first 20 of each source's frontier by score, depth and address; frontier_places has all"""
    from sifterra.operators.search import top_k

    t = load(spark, d, "crawl_documents").where("url is not null and source_id is not null and depth is not null").groupBy("source_id", "url").agg(F.min("depth").alias("depth"), F.max("priority_at_fetch").alias("score"))
    return top_k(t, ["source_id"], [F.desc("score"), F.asc("depth"), F.asc("url")], 20, "place").select("source_id", "url", "depth", F.col("place").cast("bigint"))


@query(
    "SELECT source_id, url, depth, CAST(row_number() OVER (PARTITION BY source_id ORDER BY score DESC, depth, url) AS BIGINT) AS place FROM (SELECT source_id, url, min(depth) AS depth, max(priority_at_fetch) AS score FROM crawl_documents WHERE url IS NOT NULL AND source_id IS NOT NULL AND depth IS NOT NULL GROUP BY ALL)"
)
def frontier_places(spark, d):
    """K4: every address's place in its source's frontier by score, depth and address. Counts of each score and depth give where its addresses start, so a window ranks inside one of them only."""
    t = load(spark, d, "crawl_documents").where("url is not null and source_id is not null and depth is not null").groupBy("source_id", "url").agg(F.min("depth").alias("depth"), F.max("priority_at_fetch").alias("score"))
    sizes = t.groupBy("source_id", "score", "depth").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_id").orderBy(F.desc("score"), F.asc("depth")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("source_id").alias("s"), F.col("score").alias("p"), F.col("depth").alias("q"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    j = t.join(broadcast_if_small(starts), (F.col("source_id") == F.col("s")) & F.col("score").eqNullSafe(F.col("p")) & (F.col("depth") == F.col("q")))
    inner = F.row_number().over(Window.partitionBy("source_id", "score", "depth").orderBy("url"))
    return j.select("source_id", "url", "depth", (F.col("start") + inner).cast("bigint").alias("place"))


@query("SELECT DISTINCT page_id, length(coalesce(extracted_text, '')) < 200 AND raw_link_count < 3 AND script_count >= 1 AS is_shell FROM parsed_pages")
def html_shell_verdict(spark, d):
    """H4"""
    t = load(spark, d, "parsed_pages")
    return t.select("page_id", H.is_shell(F.col("extracted_text"), F.col("raw_link_count"), F.col("script_count")).alias("is_shell")).distinct()


@query(
    """
    WITH h AS (SELECT DISTINCT page_id, lower(regexp_extract(link, '://([^/?#]+)', 1)) AS host FROM (SELECT page_id, unnest(links) AS link FROM parsed_pages)),
    x AS (SELECT page_id, host, unnest(list_transform(generate_series(1, len(string_split(host, '.'))), lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'))) AS suffix FROM h WHERE host <> ''),
    m AS (SELECT x.page_id, x.host, arg_max(r.source_id, length(x.suffix)) AS source_id FROM x JOIN (SELECT domain, min(source_id) AS source_id FROM source_registry WHERE domain IS NOT NULL GROUP BY 1) r ON x.suffix = r.domain GROUP BY 1, 2)
    SELECT source_id, CAST(count(*) AS BIGINT) AS linked_pages FROM m GROUP BY 1"""
)
def host_suffix_join(spark, d):
    """Hosts of links to the registry's domains by their longest suffix"""
    from sifterra.session import broadcast_if_small

    p = load(spark, d, "parsed_pages").select("page_id", F.explode("links").alias("link"))
    h = p.select("page_id", F.lower(F.regexp_extract("link", r"://([^/?#]+)", 1)).alias("host")).where("host <> ''").distinct()
    x = h.select("page_id", "host", F.explode(url.host_suffixes(F.col("host"))).alias("domain"))
    r = load(spark, d, "source_registry").where("domain is not null").groupBy("domain").agg(F.min("source_id").alias("source_id"))
    m = x.join(broadcast_if_small(r), "domain").groupBy("page_id", "host").agg(F.max_by("source_id", F.length("domain")).alias("source_id"))
    return m.groupBy("source_id").agg(F.count("*").alias("linked_pages"))


@query("SELECT host, CAST(count(*) AS BIGINT) AS links, CAST(count(DISTINCT page_id) AS BIGINT) AS pages, regexp_replace(regexp_replace(lower(host), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS source_guess FROM (SELECT page_id, lower(regexp_extract(link, '://([^/?#]+)', 1)) AS host FROM (SELECT page_id, unnest(links) AS link FROM parsed_pages)) WHERE host <> '' GROUP BY host")
def candidate_sources_by_host(spark, d):
    """A24, U16"""
    p = load(spark, d, "parsed_pages").select("page_id", F.explode("links").alias("link")).select("page_id", F.lower(F.regexp_extract("link", r"://([^/?#]+)", 1)).alias("host")).where("host <> ''")
    per = p.groupBy("host", "page_id").agg(F.count("*").alias("n"))
    return per.groupBy("host").agg(F.sum("n").alias("links"), F.count("*").alias("pages")).withColumn("source_guess", url.slug(F.col("host")))


@query("SELECT DISTINCT doc_id FROM crawl_documents WHERE superseded_by IS NULL AND removed_at IS NULL")
def live_documents(spark, d):
    """F1"""
    return lifecycle.live(load(spark, d, "crawl_documents")).select("doc_id").distinct()


@query("SELECT DISTINCT doc_id FROM crawl_documents c WHERE superseded_by IS NULL AND removed_at IS NULL AND NOT EXISTS (SELECT 1 FROM chunks k WHERE k.doc_id = c.doc_id)")
def unchunked_documents(spark, d):
    """J4, J5"""
    return lifecycle.live(load(spark, d, "crawl_documents")).select("doc_id").distinct().join(load(spark, d, "chunks").select("doc_id"), "doc_id", "left_anti")


@query(
    """
    WITH l AS (SELECT DISTINCT doc_id, source_id, doc_type FROM crawl_documents WHERE superseded_by IS NULL AND removed_at IS NULL AND source_id IS NOT NULL),
    k AS (SELECT l.source_id, l.doc_id, l.doc_type, count(DISTINCT c.chunk_id) AS n FROM l LEFT JOIN chunks c USING (doc_id) GROUP BY ALL)
    SELECT source_id, CAST(count(*) AS BIGINT) AS active_docs, CAST(sum(n) AS BIGINT) AS chunks, CAST(sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_chunks, CAST(sum(CASE WHEN n = 0 AND lower(coalesce(doc_type, '')) = 'pdf' THEN 1 ELSE 0 END) AS BIGINT) AS pdf_no_chunks FROM k GROUP BY 1"""
)
def corpus_health_by_source(spark, d):
    """Two-level aggregation; documents without chunks count 0"""
    docs = lifecycle.live(load(spark, d, "crawl_documents")).where("source_id is not null").select("doc_id", "source_id", "doc_type").distinct()
    n = load(spark, d, "chunks").select("doc_id", "chunk_id").distinct().groupBy("doc_id").agg(F.count("*").alias("n"))
    k = docs.join(n, "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return k.groupBy("source_id").agg(
        F.count("*").alias("active_docs"), F.sum("n").cast("bigint").alias("chunks"), F.count_if(F.col("n") == 0).alias("no_chunks"), F.count_if((F.col("n") == 0) & (F.lower(F.coalesce("doc_type", F.lit(""))) == "pdf")).alias("pdf_no_chunks")
    )


@query("SELECT doc_type, upper(coalesce(province, '?')) AS province, CAST(count(DISTINCT c.chunk_id) AS BIGINT) AS chunks FROM chunks c JOIN crawl_documents d USING (doc_id) JOIN source_registry s USING (source_id) GROUP BY ALL")
def chunk_document_source_join(spark, d):
    """Three-way equi-join with the registry broadcast while small"""
    from sifterra.session import broadcast_if_small

    c = load(spark, d, "chunks").select("chunk_id", "doc_id").distinct()
    docs = load(spark, d, "crawl_documents").select("doc_id", "source_id", "doc_type").distinct()
    j = c.join(docs, "doc_id").join(broadcast_if_small(load(spark, d, "source_registry").select("source_id", "province")), "source_id")
    per = j.select("doc_type", F.upper(F.coalesce("province", F.lit("?"))).alias("province"), "chunk_id").distinct()
    return per.groupBy("doc_type", "province").agg(F.count("*").alias("chunks"))


@query(
    """
    WITH d AS (SELECT DISTINCT doc_id, source_id, url, content_hash FROM crawl_documents WHERE source_id IS NOT NULL AND url IS NOT NULL),
    w AS (SELECT doc_id, content_hash, lag(content_hash) OVER v AS prev_hash, lead(doc_id) OVER v AS successor FROM d WINDOW v AS (PARTITION BY source_id, url ORDER BY doc_id))
    SELECT doc_id, successor, CASE WHEN prev_hash IS NULL THEN 'inserted' WHEN prev_hash = content_hash THEN 'unchanged' ELSE 'superseded' END AS outcome FROM w"""
)
def scd2_versions(spark, d):
    """W17, W18, P2"""
    t = load(spark, d, "crawl_documents").where("source_id is not null and url is not null").select("doc_id", "source_id", "url", "content_hash").distinct()
    return lifecycle.versions(t, ["source_id", "url"], [F.col("doc_id")], "content_hash").select("doc_id", "successor", "outcome")


@query(
    r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[ऀ-ॿ]')) // 3 AS BIGINT) + CAST((length(text) - len(regexp_extract_all(text, '[ऀ-ॿ]'))) // 4 AS BIGINT) AS tokens FROM documents WHERE text IS NOT NULL"""
)
def token_estimates(spark, d):
    """T-26"""
    return load(spark, d, "documents").where("text is not null").select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


@query(
    r"""
    WITH t AS (SELECT doc_id, source, md5('s:' || doc_id) AS o, CAST(len(regexp_extract_all(text, '[ऀ-ॿ]')) // 3 AS BIGINT) + CAST((length(text) - len(regexp_extract_all(text, '[ऀ-ॿ]'))) // 4 AS BIGINT) AS tokens FROM documents WHERE text IS NOT NULL),
    r AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t)
    SELECT source, doc_id, tokens FROM r WHERE before < 5000"""
)
def token_budget_slice(spark, d):
    """Documents of each source in seeded order until 5,000 tokens are reached"""
    t = load(spark, d, "documents").where("text is not null").select("doc_id", "source", sampling.shuffled("doc_id").alias("o"), text.token_estimate(F.col("text")).alias("tokens"))
    return sampling.token_budget(t, ["source"], "o", "tokens", 5000).select("source", "doc_id", "tokens")


@query(
    r"SELECT page_id, CAST(len(list_distinct(list_transform(regexp_extract_all(extracted_text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), lambda e: lower(e)))) AS INTEGER) AS emails, CAST(len(list_distinct(list_filter(list_transform(regexp_extract_all(extracted_text, '\+?[0-9][0-9() -]{5,16}[0-9]'), lambda p: regexp_replace(p, '[^0-9]', '', 'g')), lambda n: length(n) BETWEEN 7 AND 13))) AS INTEGER) AS phones FROM (SELECT DISTINCT page_id, extracted_text FROM parsed_pages WHERE extracted_text IS NOT NULL)"
)
def contact_extract(spark, d):
    """T-23: numbers of addresses and phones on each page"""
    t = load(spark, d, "parsed_pages").where("extracted_text is not null").select("page_id", "extracted_text").distinct()
    c = text.contacts(F.col("extracted_text"))
    return t.select("page_id", F.size(c["emails"]).alias("emails"), F.size(c["phones"]).alias("phones"))
