"""Further queries: joins, dialogue and record assembly, audits, streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifterra.functions import script, text, url
from sifterra.operators import joins, records, sampling, search
from sifterra.plans.operations import _BM25
from sifterra.plans.registry import query
from sifterra.session import broadcast_if_small, load, shared_folder

_S = "(SELECT DISTINCT result_id, item_id, suite, kind, category, question_lang, question, model_output, model_citations, model_refused, chrf FROM smoke_results)"


def _smoke(spark, d, *cols):
    return load(spark, d, "smoke_results").select("result_id", *cols).distinct()


@query("SELECT item_id, arg_max(result_id, result_id) AS result_id, arg_max(kind, result_id) AS kind FROM smoke_results GROUP BY item_id")
def last_result_per_item(spark, d):
    """J10, P9"""
    return joins.last_write(_smoke(spark, d, "item_id", "kind").select("item_id", "kind", "result_id", F.col("result_id").alias("o")), "item_id", "o").select("item_id", "result_id", "kind")


@query("SELECT question, min(result_id) AS result_id FROM smoke_results WHERE question IS NOT NULL GROUP BY question")
def first_per_question(spark, d):
    """W5, DS9, X7"""
    return joins.first_write(_smoke(spark, d, "question").where("question is not null").select("question", "result_id", F.col("result_id").alias("o")), "question", "o").select("question", "result_id")


@query(
    """
    WITH k AS (SELECT DISTINCT url AS k FROM crawl_documents WHERE url IS NOT NULL), u AS (SELECT DISTINCT left(url, length(url) - 2) AS cut FROM parsed_pages WHERE length(url) > 20),
    e AS (SELECT cut, cut AS repaired FROM u WHERE cut IN (SELECT k FROM k)), p AS (SELECT cut, count(*) AS n, min(k) AS m FROM u JOIN k ON starts_with(k, cut) WHERE cut NOT IN (SELECT k FROM k) GROUP BY 1)
    SELECT u.cut, coalesce(e.repaired, CASE WHEN p.n = 1 THEN p.m END) AS repaired FROM u LEFT JOIN e USING (cut) LEFT JOIN p USING (cut)"""
)
def citation_url_repair(spark, d):
    """Cut-off addresses completed where exactly one known address fits"""
    u = load(spark, d, "parsed_pages").where(F.length("url") > 20).select(F.expr("left(url, length(url) - 2)").alias("cut")).distinct()
    return joins.prefix_repair(u, "cut", load(spark, d, "crawl_documents"), "url", 20)


@query("SELECT result_id, list_aggregate(list_transform([2, 1], lambda r: coalesce(model_citations[r], '-')), 'string_agg', ',') AS picked FROM " + _S + " WHERE len(model_citations) > 0")
def citation_elements(spark, d):
    """Reference numbers against an array, by place"""
    t = _smoke(spark, d, "model_citations").where("size(model_citations) > 0").withColumn("items", F.transform("model_citations", lambda c, i: F.struct(F.lit(None).cast("int").alias("rank"), c.alias("v")))).withColumn("refs", F.array(F.lit(2), F.lit(1)))
    return joins.element_join(t, "refs", "items", "rank", "v", "picked").select("result_id", F.array_join(F.transform("picked", lambda x: F.coalesce(x, F.lit("-"))), ",").alias("picked"))


@query(
    r"""
    WITH t AS (SELECT DISTINCT result_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(question), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> ''), ' ') || ' ' AS q FROM smoke_results WHERE question IS NOT NULL),
    a AS (SELECT * FROM (VALUES ('land transfer', 'land'), ('passport renewal', 'passport'), ('renewal', 'other'), ('fee', 'fee'), ('driving licence renewal', 'licence')) v(alias, service))
    SELECT result_id, arg_max(service, length(alias)) AS service FROM t JOIN a ON contains(q, ' ' || alias || ' ') GROUP BY 1"""
)
def longest_alias(spark, d):
    """The service named by the longest alias"""
    a = spark.createDataFrame([("land transfer", "land"), ("passport renewal", "passport"), ("renewal", "other"), ("fee", "fee"), ("driving licence renewal", "licence")], "alias string, service string")
    return joins.alias_match(_smoke(spark, d, "question").where("question is not null"), "result_id", F.col("question"), a, "alias", "service")


@query("SELECT source_id, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs, r.source_id IS NOT NULL AS known FROM crawl_documents c LEFT JOIN (SELECT DISTINCT source_id FROM source_registry) r USING (source_id) WHERE c.source_id IS NOT NULL GROUP BY source_id, r.source_id")
def known_sources(spark, d):
    """Sources of the crawl in and out of the registry"""
    docs = load(spark, d, "crawl_documents").where("source_id is not null").select("source_id", "doc_id").distinct().groupBy("source_id").agg(F.count("*").alias("docs"))
    r = load(spark, d, "source_registry").select("source_id", F.lit(True).alias("known")).distinct()
    return docs.join(broadcast_if_small(r), "source_id", "left").select("source_id", "docs", F.coalesce("known", F.lit(False)).alias("known"))


@query("SELECT r.source_id, coalesce(n.docs, 0) AS docs FROM source_registry r LEFT JOIN (SELECT source_id, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs FROM crawl_documents WHERE superseded_by IS NULL AND removed_at IS NULL GROUP BY 1) n USING (source_id)")
def registry_with_counts(spark, d):
    """Every registered source with its live documents"""
    n = load(spark, d, "crawl_documents").where("superseded_by is null and removed_at is null").select("source_id", "doc_id").distinct().groupBy("source_id").agg(F.count("*").alias("docs"))
    return load(spark, d, "source_registry").select("source_id").join(n, "source_id", "left").select("source_id", F.coalesce("docs", F.lit(0).cast("bigint")).alias("docs"))


@query("SELECT a.item_id, a.question AS left_text, b.gold_answer AS right_text FROM gold_items a JOIN gold_items b USING (item_id)")
def parallel_alignment(spark, d):
    """Two parallel lists by line number"""
    g = load(spark, d, "gold_items")
    return joins.zip_files(g.select("item_id", F.col("question").alias("left_text")), g.select("item_id", F.col("gold_answer").alias("right_text")), "item_id")


@query("SELECT DISTINCT page_id FROM parsed_pages WHERE regexp_matches(lower(extracted_text), 'fee|दस्तुर') AND length(extracted_text) BETWEEN 200 AND 4000 AND coalesce(lang, 'unknown') <> 'de'")
def text_predicates(spark, d):
    """term disjunctions as one pattern, length range and null-safe exclusion"""
    t = load(spark, d, "parsed_pages")
    return t.where(F.lower("extracted_text").rlike("fee|दस्तुर") & F.length("extracted_text").between(200, 4000) & (F.coalesce("lang", F.lit("unknown")) != "de")).select("page_id").distinct()


@query(
    r"""
    WITH t AS (SELECT DISTINCT conv_id, turn_no, content FROM chat_turns WHERE role = 'user' AND length(content) BETWEEN 20 AND 2000),
    a AS (SELECT conv_id, turn_no, regexp_replace(content, '!?\[([^\]\n]*)\]\([^()\s]*\)', '\1', 'g') AS x FROM t),
    b AS (SELECT conv_id, turn_no, regexp_replace(regexp_replace(x, '(?im)^[ \t]*(?:>|&gt;).*$|^[ \t]*\**edit(?:ed)?\b[^\n:]{0,20}:.*$|\bhttps?://[^\s<>]+|\bwww\.[^\s<>]+', '', 'g'), '(?m)(^|[^\w/])/?[ur]/[A-Za-z0-9_-]+', '\1', 'g') AS x FROM a)
    SELECT DISTINCT conv_id, turn_no, trim(regexp_replace(array_to_string(list_transform(regexp_split_to_array(x, '\r?\n'), lambda l: trim(regexp_replace(l, '[ \t]+', ' ', 'g'))), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), chr(10) || ' ') AS cleaned FROM b"""
)
def forum_clean(spark, d):
    """T-8, F7: user turns of 20 to 2,000 characters"""
    t = load(spark, d, "chat_turns").where("content is not null and role = 'user'").where(F.length("content").between(20, 2000))
    return t.select("conv_id", "turn_no", text.clean_forum(F.col("content")).alias("cleaned")).distinct()


@query(r"SELECT DISTINCT result_id, len(list_filter(regexp_split_to_array(model_output, '[\s\x{00A0}\x{0085}]+'), lambda w: regexp_matches(w, '[ऀ-ॿ]') AND regexp_matches(regexp_replace(regexp_replace(w, '^[^\p{L}\p{M}\p{N}]+', ''), '[^\p{L}\p{M}\p{N}]+$', ''), '[A-Za-z0-9{}|\[\]*+=<>^~@#$%&]'))) AS garbled FROM smoke_results WHERE model_output IS NOT NULL")
def mojibake_tokens(spark, d):
    """L7, A18"""
    return _smoke(spark, d, "model_output").where("model_output is not null").select("result_id", F.size(records.garbled_tokens(F.col("model_output"))).cast("bigint").alias("garbled"))


@query("SELECT source, CAST(count(*) AS BIGINT) AS docs, CAST(count(*) FILTER (d / nullif(d + l, 0)::DOUBLE >= 0.5) AS BIGINT) AS dominant FROM (SELECT source, len(regexp_extract_all(text, '[ऀ-ॿ]')) AS d, len(regexp_extract_all(text, '[A-Za-z]')) AS l FROM documents WHERE text IS NOT NULL) GROUP BY source")
def script_dominance(spark, d):
    """F13, DS19"""
    return load(spark, d, "documents").where("text is not null").groupBy("source").agg(F.count("*").alias("docs"), F.count_if(script.dominant(F.col("text"))).alias("dominant"))


@query(r"SELECT doc_id FROM documents WHERE text IS NOT NULL AND source LIKE 'm%' AND len(list_distinct(regexp_extract_all(lower(text), '\b(?:the|of|and|to|for)\b'))) >= 3")
def english_filter(spark, d):
    """a source pattern and three different function words"""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\b(?:the|of|and|to|for)\b"), F.lit(0)))
    return load(spark, d, "documents").where(F.col("text").isNotNull() & F.col("source").startswith("m") & (F.size(words) >= 3)).select("doc_id")


@query("SELECT result_id, CASE WHEN w IS NULL THEN 0 ELSE w END AS longest FROM (SELECT DISTINCT result_id FROM smoke_results WHERE model_output IS NOT NULL) LEFT JOIN (SELECT result_id, max(n) AS w FROM (SELECT result_id, grp, t, count(*) AS n FROM (SELECT result_id, t, i - row_number() OVER (PARTITION BY result_id, t ORDER BY i) AS grp FROM (SELECT result_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM (SELECT DISTINCT result_id, regexp_extract_all(lower(model_output), '[\\p{L}\\p{N}_ऀ-ॿ]+') AS ts FROM smoke_results WHERE model_output IS NOT NULL))) GROUP BY ALL) GROUP BY 1) USING (result_id)")
def longest_token_run(spark, d):
    """W15"""
    return _smoke(spark, d, "model_output").where("model_output is not null").select("result_id", text.longest_equal_run(text.word_tokens(F.col("model_output"))).cast("bigint").alias("longest"))


@query("SELECT question_lang, kind, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (model_refused) AS BIGINT) AS refused, CAST(count(*) FILTER (model_output IS NULL OR NOT regexp_matches(model_output, '[^\\s\\x{00A0}]')) AS BIGINT) AS empty, round(avg(length(model_output)), 1) AS mean_chars FROM " + _S + " GROUP BY ALL")
def sweep_summary(spark, d):
    """A23, A28"""
    t = _smoke(spark, d, "kind", "question_lang", "model_output", "model_refused")
    return t.groupBy("question_lang", "kind").agg(F.count("*").alias("n"), F.count_if("model_refused").alias("refused"), F.count_if(text.is_blank(F.col("model_output"))).alias("empty"), F.round(F.avg(F.length("model_output")), 1).alias("mean_chars"))


@query("SELECT suite, CAST(count(*) AS BIGINT) AS queries, avg(CASE WHEN r <= 1 THEN 1.0 ELSE 0 END) AS hit_1, avg(CASE WHEN r <= 3 THEN 1.0 ELSE 0 END) AS hit_3, avg(CASE WHEN r <= 5 THEN 1.0 ELSE 0 END) AS hit_5 FROM (SELECT suite, CASE WHEN len(model_citations) > 0 THEN TRY_CAST(substr(model_citations[1], 2) AS INTEGER) END AS r FROM " + _S + ") GROUP BY suite")
def hit_at_k(spark, d):
    """A15, R15"""
    t = _smoke(spark, d, "suite", "model_citations").select("suite", F.when(F.size("model_citations") > 0, F.substring(F.col("model_citations")[0], 2, 9).try_cast("int")).alias("r"))
    return records.hit_metrics(t, ["suite"], "r")


@query("SELECT result_id, CASE WHEN question IS NULL THEN 0 ELSE 1 END + CASE WHEN model_output IS NULL OR NOT regexp_matches(model_output, '[^\\s\\x{00A0}]') THEN 0 ELSE 1 END AS turns FROM " + _S)
def training_messages(spark, d):
    """N, DS5: assembled messages; empty parts are left out"""
    t = _smoke(spark, d, "question", "model_output")
    return t.select("result_id", F.size(records.messages(None, F.col("question"), F.col("model_output"))).alias("turns"))


@query("SELECT result_id, array_to_string(list_filter([CASE WHEN length(trim(model_output)) < 20 THEN 'short' END, CASE WHEN length(model_output) > 1500 THEN 'long' END], lambda x: x IS NOT NULL), ',') AS issues FROM " + _S + " WHERE model_output IS NOT NULL")
def pair_length_issues(spark, d):
    """L19, DS8, DS11"""
    t = _smoke(spark, d, "question", "model_output").where("model_output is not null")
    issues = records.pair_issues(F.col("question"), F.col("model_output"), 20, 1500)
    return t.select("result_id", F.array_join(F.filter(issues, lambda x: x.isin("short", "long")), ",").alias("issues"))


@query(
    """
    WITH l AS (SELECT source_id, count(DISTINCT doc_id) AS docs FROM crawl_documents WHERE superseded_by IS NULL AND removed_at IS NULL GROUP BY 1),
    k AS (SELECT source_id, count(DISTINCT c.chunk_id) AS chunks, count(DISTINCT d.doc_id) FILTER (c.chunk_id IS NULL) AS un FROM (SELECT DISTINCT doc_id, source_id FROM crawl_documents WHERE superseded_by IS NULL AND removed_at IS NULL) d LEFT JOIN chunks c USING (doc_id) GROUP BY 1)
    SELECT r.source_id, round(CASE tier WHEN 1 THEN 34 WHEN 2 THEN 32 WHEN 3 THEN 28 WHEN 4 THEN 18 WHEN 5 THEN 10 ELSE 8 END + CASE WHEN status = 'active' THEN 0.0 ELSE -70.0 END
      + CASE WHEN docs IS NULL THEN 16.0 WHEN docs = 0 THEN 42.0 ELSE CASE WHEN chunks = 0 THEN 38.0 ELSE 0.0 END + CASE WHEN un > 0 THEN least(34.0, ln(1 + un) * 8.0) + un / greatest(docs, 1)::DOUBLE * 18.0 ELSE 0.0 END END, 2) AS score FROM source_registry r LEFT JOIN l USING (source_id) LEFT JOIN k USING (source_id)"""
)
def coverage_score(spark, d):
    """R23, K6"""
    docs = load(spark, d, "crawl_documents").where("superseded_by is null and removed_at is null and source_id is not null").select("doc_id", "source_id").distinct()
    n = load(spark, d, "chunks").select("doc_id", "chunk_id").distinct().groupBy("doc_id").agg(F.count("*").alias("n"))
    k = docs.join(n, "doc_id", "left").groupBy("source_id").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"), F.count_if(F.col("n").isNull()).alias("un"))
    r = load(spark, d, "source_registry").select("source_id", "tier", "status").join(k, "source_id", "left")
    c = F.col
    return r.select("source_id", records.coverage_score(c("tier"), c("status"), c("docs"), c("chunks"), c("un"), F.lit(0), F.lit(0), F.lit(False)).alias("score"))


@query("SELECT source_id, CAST(count(*) AS BIGINT) AS docs, list_aggregate(list_sort(list(title) FILTER (n <= 3)), 'string_agg', '|') AS sample FROM (SELECT source_id, title, row_number() OVER (PARTITION BY source_id ORDER BY title, doc_id) AS n FROM (SELECT DISTINCT doc_id, source_id, title FROM crawl_documents WHERE source_id IS NOT NULL AND title IS NOT NULL)) GROUP BY source_id")
def source_samples(spark, d):
    """Counts with three sample titles, chosen by rank before anything is gathered"""
    t = load(spark, d, "crawl_documents").where("source_id is not null and title is not null").select("doc_id", "source_id", "title").distinct()
    three = search.top_k(t, ["source_id"], [F.asc("title"), F.asc("doc_id")], 3, "n").groupBy("source_id").agg(F.array_join(F.sort_array(F.collect_list("title")), "|").alias("sample"))
    return t.groupBy("source_id").agg(F.count("*").alias("docs")).join(three, "source_id").select("source_id", "docs", "sample")


@query("WITH r AS (SELECT doc_id, doc_type, row_number() OVER (PARTITION BY doc_type ORDER BY md5('s:' || doc_id), doc_id) AS n FROM documents) SELECT doc_id, doc_type FROM r JOIN (VALUES ('law', 7), ('faq', 5), ('news', 2)) q(doc_type, quota) USING (doc_type) WHERE n <= quota")
def quota_topn(spark, d):
    """Per-type quotas"""
    q = spark.createDataFrame([("law", 7), ("faq", 5), ("news", 2)], "doc_type string, quota int")
    t = load(spark, d, "documents").select("doc_id", "doc_type").join(F.broadcast(q), "doc_type")  # three rows
    n = F.row_number().over(Window.partitionBy("doc_type").orderBy(sampling.shuffled("doc_id"), "doc_id"))
    return t.withColumn("n", n).where("n <= quota").select("doc_id", "doc_type")


@query("WITH a AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents WHERE doc_type = 'law'), f AS (SELECT doc_id, h, row_number() OVER (ORDER BY md5('s:' || doc_id), doc_id) AS n FROM (SELECT min(doc_id) AS doc_id, sha256(coalesce(text, '')) AS h FROM documents WHERE doc_type = 'guide' GROUP BY 2) WHERE h NOT IN (SELECT h FROM a)) SELECT doc_id FROM a UNION ALL SELECT doc_id FROM f WHERE n <= greatest(0, 300 - (SELECT count(*) FROM a))")
def fill_fallback(spark, d):
    """Filled to 300 from another kind without repeating a text"""
    t = load(spark, d, "documents").select("doc_id", "doc_type", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return sampling.fill_to(t.where("doc_type = 'law'").select("doc_id", "h"), t.where("doc_type = 'guide'").select("doc_id", "h"), "doc_id", "h", 300).select("doc_id")


@query("SELECT 'Steps for ' || s AS filled FROM (SELECT DISTINCT question_category AS s FROM gold_items WHERE question_category IS NOT NULL) UNION ALL SELECT 'Fee of ' || s FROM (SELECT DISTINCT question_category AS s FROM gold_items WHERE question_category IS NOT NULL)")
def template_expansion(spark, d):
    """DS7"""
    t = spark.createDataFrame([("Steps for {}",), ("Fee of {}",)], "t string")
    e = load(spark, d, "gold_items").where("question_category is not null").select(F.col("question_category").alias("s")).distinct()
    return joins.expand_templates(t, "t", e, "s").select("filled")


@query("SELECT page_id, CAST(count(DISTINCT link) AS BIGINT) AS same_site FROM (SELECT page_id, url, unnest(links) AS link FROM parsed_pages) WHERE array_to_string(string_split(lower(regexp_extract(url, '://([^/?#]+)', 1)), '.')[-3:], '.') = array_to_string(string_split(lower(regexp_extract(link, '://([^/?#]+)', 1)), '.')[-3:], '.') GROUP BY page_id")
def same_site_links(spark, d):
    """F22, U7, U15"""
    p = load(spark, d, "parsed_pages").select("page_id", "url", F.explode("links").alias("link")).distinct()
    host = lambda c: F.lower(F.regexp_extract(c, r"://([^/?#]+)", 1))
    same = p.where(url.last_labels(host(F.col("url"))) == url.last_labels(host(F.col("link"))))
    return same.select("page_id", "link").distinct().groupBy("page_id").agg(F.count("*").alias("same_site"))


@query("SELECT DISTINCT page_id, NOT list_has_any(string_split(lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '/'), ['notice', 'file']) AS allowed, length(coalesce(extracted_text, '')) >= 200 AND coalesce(len(links), 0) >= 1 AS passes FROM parsed_pages")
def crawl_policy(spark, d):
    """F21, F24"""
    t = load(spark, d, "parsed_pages")
    return t.select("page_id", url.path_allowed(url.url_parts(F.col("url"))["path"], None, ["notice", "file"]).alias("allowed"), records.repair_gate(F.col("extracted_text"), F.col("links")).alias("passes")).distinct()


@query("SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS errors FROM events GROUP BY ALL")
def stream_daily_counts(spark, d):
    """ST1, ST6: a stream over the files, run until it has read all, equals the batch"""
    import uuid

    from sifterra.streaming import jobs

    root = f"{shared_folder(spark)}/stream_{uuid.uuid4().hex}"
    batch = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.select("event_id", "ts", "user_id", "event_type").write.parquet(f"{root}/in")
    live = jobs.tumbling_counts(jobs.file_stream(spark, f"{root}/in", batch.select("event_id", "ts", "user_id", "event_type").schema, 100), "user_id", late="400 days")
    jobs.run_available(live, lambda b, i: b.write.mode("append").parquet(f"{root}/out/{i}"), f"{root}/ckpt", "update")
    out = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out")
    # An update may restate a window; its last statement has the largest count.
    return out.groupBy("user_id", F.to_date("window.start").cast("string").alias("day")).agg(F.max("n").alias("n"), F.max("errors").alias("errors"))


@query("SELECT user_id, event_type, min(event_id) AS first_seen FROM (SELECT * FROM events) GROUP BY ALL")
def first_seen_per_kind(spark, d):
    """Insert-or-ignore over repeated keys"""
    return load(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_seen"))


@query(
    f"""
    WITH b AS (SELECT item_id, question FROM gold_items), q AS (SELECT item_id, question FROM b WHERE item_id % 50 = 0),
    t AS (SELECT DISTINCT item_id, unnest(list_distinct(regexp_extract_all(lower(question), '[\\p{{L}}\\p{{N}}_ऀ-ॿ]+'))) AS tok FROM b)
    SELECT x.item_id AS q_id, y.item_id AS claim_id, CAST(count(*) AS BIGINT) AS overlap FROM t x JOIN t y USING (tok) WHERE x.item_id % 50 = 0 AND length(tok) > 2 AND tok NOT IN ('the', 'for') GROUP BY ALL"""
)
def claim_overlap_score(spark, d):
    """Token overlap of a query set with all claims"""
    g = load(spark, d, "gold_items").where("question is not null")
    o = search.overlap_score(g.select(F.col("item_id").alias("claim_id"), F.col("question").alias("c")), g.where("item_id % 50 = 0").select(F.col("item_id").alias("q_id"), F.col("question").alias("q")), "claim_id", "c", "q_id", "q", ["the", "for"])
    return o.select("q_id", "claim_id", "overlap")


_FLAT = _BM25.replace("tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))", "tf * 2.5 / (tf + 1.5)")


@query(
    f"""
    WITH a AS (WITH {_BM25} SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS r FROM s), b AS (WITH {_FLAT} SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS r FROM s)
    SELECT item_id, doc_id, round(sum(1.0::DOUBLE / (60 + r)), 9) AS fused, CAST(count(*) AS BIGINT) AS lists FROM (FROM a UNION ALL FROM b) GROUP BY ALL"""
)
def rrf_rankings(spark, d):
    """The whole rankings of the items divisible by 50 over all documents, by BM25 with and without length normalisation, fused. No table links vectors to documents, so both lists are of BM25."""
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    docs = load(spark, d, "documents")
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    lists = [search.bm25(docs, q, "item_id", "question", b=b).withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(w)) for b in (search.B, 0.0)]
    return search.reciprocal_rank_fusion(lists, "item_id", "doc_id").select("item_id", "doc_id", F.round("score", 9).alias("fused"), "lists")


@query()
def near_dup_sentences(spark, d):
    """T-12: answers without sentences that nearly repeat an earlier one"""
    return _smoke(spark, d, "model_output").where("model_output is not null").select("result_id", text.drop_near_sentences(F.col("model_output")).alias("kept"))


@query("SELECT source_id, CASE WHEN tier = 1 THEN 9 WHEN tier = 2 THEN 7 ELSE tier END AS tier FROM source_registry")
def override_replay(spark, d):
    """Patches in order, the last one of each source wins"""
    from sifterra.operators import lifecycle

    base = load(spark, d, "source_registry").select("source_id", "tier")
    one, two = base.where("tier = 1"), base.where("tier <= 2")
    patches = two.select("source_id", F.lit(7).alias("tier"), F.lit(1).alias("at")).unionByName(one.select("source_id", F.lit(9).alias("tier"), F.lit(2).alias("at")))
    return lifecycle.replay_patches(base, patches, "source_id", "tier", "at")[0]


@query(r"SELECT label, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT conv_id, turn_no, CASE WHEN d + l < 10 THEN 'other' WHEN d / (d + l)::DOUBLE > 0.5 THEN 'devanagari' WHEN d > 0 AND d / (d + l)::DOUBLE > 0.05 THEN 'code_mixed' WHEN r >= 3 AND r > e THEN 'roman_nepali' ELSE 'english' END AS label FROM (SELECT conv_id, turn_no, len(regexp_extract_all(content, '[ऀ-ॿ]')) AS d, len(regexp_extract_all(content, '[A-Za-z]')) AS l, len(regexp_extract_all(lower(content), '\b(?:ko|ma|ra|le|garn|chha|ke)\b')) AS r, contains(lower(content), 'the ')::INT + contains(lower(content), 'what')::INT AS e FROM chat_turns WHERE content IS NOT NULL)) GROUP BY label")
def forum_languages(spark, d):
    """Rule-based labels with the caller's marker lists"""
    t = load(spark, d, "chat_turns").where("content is not null").select("conv_id", "turn_no", "content").distinct()
    label = script.forum_language(F.col("content"), ["the ", "what"], ["ko", "ma", "ra", "le", "garn", "chha", "ke"])
    return t.select("conv_id", "turn_no", label.alias("label")).distinct().groupBy("label").agg(F.count("*").alias("n"))


@query()
def romanised_titles(spark, d):
    """L15"""
    return load(spark, d, "crawl_documents").where(F.col("title").rlike("[ऀ-ॿ]")).select("doc_id", script.romanise("title").alias("romanised")).distinct()


@query("SELECT doc_id, CAST(count(*) AS BIGINT) AS chunks, CAST(sum(char_end - char_start) AS BIGINT) AS chars FROM (SELECT DISTINCT chunk_id, doc_id, char_start, char_end FROM chunks) GROUP BY doc_id HAVING count(*) > 1")
def chunk_coverage(spark, d):
    """Documents of several chunks and the characters they hold"""
    c = load(spark, d, "chunks").select("chunk_id", "doc_id", "char_start", "char_end").distinct()
    return c.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(F.col("char_end") - F.col("char_start")).alias("chars")).where("chunks > 1")


@query("SELECT page_id, kind FROM (SELECT DISTINCT page_id, CASE WHEN length(coalesce(extracted_text, '')) < 20 THEN 'empty' ELSE 'ok' END AS kind FROM parsed_pages)")
def extraction_states(spark, d):
    """H5"""
    from sifterra.functions import html as H

    return load(spark, d, "parsed_pages").select("page_id", H.extraction_status(F.lit("html"), F.col("extracted_text")).alias("kind")).distinct()


def _ann(spark, d):
    from sifterra.operators import vectors

    e = load(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    cells = vectors.fit_cells(e, "vec_id", "embedding")
    probes = vectors.fit_probes(e, "vec_id", "embedding", cells)
    return e, q, vectors.ann_search(e, q, "vec_id", "embedding", "qid", "qv", cells, 10, probes)


@query()
def vector_ann_topk(spark, d):
    """The inverted file; ids divisible by 50 against all rows"""
    return _ann(spark, d)[2].select("qid", "vec_id", F.col("rank").cast("bigint"))


@query()
def vector_recall(spark, d):
    """Recall of the inverted file against the exact search"""
    from sifterra.operators import vectors

    e, q, found = _ann(spark, d)
    s = search.cosine_scores(e, q, "vec_id", "embedding", "qid", "qv").withColumn("score", F.round("score", 6))
    return vectors.recall_at_k(found, search.top_k(s, ["qid"], [F.desc("score"), F.asc("vec_id")], 10), "qid", "vec_id")
