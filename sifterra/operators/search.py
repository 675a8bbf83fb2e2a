"""Inverted index, BM25, reranking and fusion."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifterra.functions.text import index_tokens, word_tokens
from sifterra.session import broadcast_if_small, size_in_bytes

K1, B = 1.5, 0.75


def build_postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(term, key, tf, dl). The tokens of one document are counted in one map-side group, then by (term, key): no group is larger than a document."""
    t = docs.where(F.col(text).isNotNull()).select(F.col(key), index_tokens(F.col(text)).alias("toks"))
    t = t.select(key, F.size("toks").alias("dl"), F.explode("toks").alias("term"))
    return t.groupBy("term", key, "dl").agg(F.count("*").alias("tf"))


def index_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: number of documents with a text, mean length."""
    return docs.where(F.col(text).isNotNull()).agg(F.count("*").alias("n_docs"), F.avg(F.size(index_tokens(F.col(text)))).alias("avgdl"))


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(query key, term, weight): a repeated term weighs its count."""
    return queries.select(F.col(key), F.explode(index_tokens(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("weight"))


def bm25(docs: DataFrame, queries: DataFrame, query_key: str, query_text: str, key: str = "doc_id", text: str = "text", k1: float = K1, b: float = B) -> DataFrame:
    """R2: (query, document, score). Only the queries' terms pass the scan: tokens are filtered before they are counted or shuffled."""
    terms = query_terms(queries, query_key, query_text)
    wanted = terms.select("term").distinct()
    t = docs.where(F.col(text).isNotNull()).select(F.col(key), index_tokens(F.col(text)).alias("toks"))
    t = t.select(key, F.size("toks").alias("dl"), F.explode("toks").alias("term")).join(broadcast_if_small(wanted, 32 << 20), "term", "left_semi")
    post = t.groupBy("term", key, "dl").agg(F.count("*").alias("tf"))
    return _bm25_scores(post, index_stats(docs, text), terms, query_key, key, k1, b)


def _bm25_scores(post: DataFrame, stats: DataFrame, terms: DataFrame, query_key: str, key: str, k1: float, b: float) -> DataFrame:
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    stats = F.broadcast(stats.select("n_docs", "avgdl"))  # one row
    idf = F.greatest(F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0), F.lit(0.0))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    scored = post.join(broadcast_if_small(df), "term").crossJoin(stats).select("term", key, part.alias("part"))
    return scored.join(broadcast_if_small(terms), "term").groupBy(query_key, key).agg(F.sum(F.col("part") * F.col("weight")).alias("score"))


def top_k(scored: DataFrame, partition: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group by a total order; Spark prunes inside the map tasks (WindowGroupLimit)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return scored.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def one_per_url(ranked: DataFrame, partition: list[str], url: Column, order: list[Column]) -> DataFrame:
    """The best row of each normalised URL, ranked anew without gaps."""
    d = ranked.withColumn("_u", url)
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy(*partition, "_u").orderBy(*order))).where("_n = 1")
    return d.withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).drop("_u", "_n")


def keyword_score(text: Column, keywords: list[str]) -> Column:
    """Sum of each keyword's count, 3 at most, plus half the number of distinct ones."""
    low = F.lower(F.coalesce(text, F.lit("")))
    n = [F.regexp_count(low, F.lit(k)) for k in keywords]
    return sum((F.least(c, F.lit(3)) for c in n), F.lit(0)) + 0.5 * sum((F.when(c > 0, 1).otherwise(0) for c in n), F.lit(0))


def overlap_score(claims: DataFrame, queries: DataFrame, claim_key: str, claim_text: str, query_key: str, query_text: str, stopwords: list[str]) -> DataFrame:
    """Shared distinct tokens, scaled up for short claims. An equi-join on tokens, not a comparison of all pairs."""
    tok = lambda d, k, t, name: d.select(F.col(k), F.explode(F.array_distinct(word_tokens(F.col(t)))).alias("tok")).where(~F.col("tok").isin(stopwords) & (F.length("tok") > 2))
    c = tok(claims, claim_key, claim_text, "c")
    q = tok(queries, query_key, query_text, "q")
    size = claims.select(F.col(claim_key), F.size(F.array_distinct(word_tokens(F.col(claim_text)))).alias("n"))
    shared = c.join(broadcast_if_small(q), "tok").groupBy(query_key, claim_key).agg(F.count("*").alias("overlap"))
    return shared.join(size, claim_key).select(query_key, claim_key, "overlap", short_claim_score(F.col("overlap"), F.col("n")).alias("score"))


def short_claim_score(overlap: Column, tokens: Column) -> Column:
    """The overlap, up to 30 % more for claims under 50 tokens."""
    return overlap * (1 + 0.3 * (1 - F.least(F.lit(1.0), tokens / 50)))


# What a claim's confidence adds.
CONFIDENCE = {"high": 0.5, "medium": 0.0, "low": -0.5}


def claim_scores(claims: DataFrame, queries: DataFrame, claim_key: str, query_key: str, places: list[str]) -> DataFrame:
    """``query, claim, overlap, score`` of every pair that shares a token which is no place name (any token where a query has none but place names).

    ``claims`` has ``tokens`` (array), ``domain``, ``confidence`` and ``markers`` (array of its topic's strong marks it holds);
    ``queries`` has ``tokens`` and ``domains`` (array of wanted local domains). Overlap scaled for short claims, 0.75 for each shared
    token that is no place, 2.5 for a wanted domain or one below it, 1.25 a mark up to 4, and the confidence. An equi-join on tokens.
    """
    c = claims.select(claim_key, F.explode(F.array_distinct("tokens")).alias("tok"))
    q = queries.select(query_key, F.explode(F.array_distinct("tokens")).alias("tok"))
    free = ~F.col("tok").isin(places) if places else F.lit(True)
    shared = c.join(broadcast_if_small(q), "tok").groupBy(query_key, claim_key).agg(F.count("*").alias("overlap"), F.count_if(free).alias("free"))
    named = F.lit(False) if not places else F.forall("tokens", lambda t: t.isin(places))
    own = claims.select(claim_key, F.size(F.array_distinct("tokens")).alias("_n"), "domain", "confidence", F.size("markers").alias("_marks"))
    asked = queries.select(query_key, "domains", named.alias("_places_only"))
    j = shared.join(broadcast_if_small(asked), query_key).join(own, claim_key).where((F.col("free") > 0) | F.col("_places_only"))
    near = F.exists("domains", lambda d: (F.col("domain") == d) | F.col("domain").endswith(F.concat(F.lit("."), d)))
    sure = F.create_map(*[F.lit(x) for p in CONFIDENCE.items() for x in p])
    score = (
        short_claim_score(F.col("overlap"), F.col("_n"))
        + 0.75 * F.col("free")
        + F.when(F.coalesce(near, F.lit(False)), 2.5).otherwise(0.0)
        + F.least(F.lit(4.0), 1.25 * F.greatest(F.coalesce("_marks", F.lit(0)), F.lit(0)))
        + F.coalesce(F.try_element_at(sure, F.coalesce("confidence", F.lit("medium"))), F.lit(0.0))
    )
    return j.select(query_key, claim_key, "overlap", score.alias("score"))


def rank_features(rank: Column, coverage: Column, domain_match: Column, local_match: Column, noisy: Column, boost: Column | None = None, wants_place: Column | None = None) -> Column:
    """Order bonus, coverage, domain, locality, noise and the topic's boost as one score. A local query whose place isn't met gets 1 for a matching domain."""
    near = F.when(local_match, 7.5)
    if wants_place is not None:
        near = near.when(wants_place & domain_match, 1.0)
    return (
        F.greatest(F.lit(0.0), F.lit(4.0) - 0.05 * (rank - 1))
        + 5.0 * coverage
        + F.when(domain_match, 7.5).otherwise(-2.0)
        + near.otherwise(0.0)
        + F.when(noisy, -1.5).otherwise(0.0)
        + (F.lit(0.0) if boost is None else F.coalesce(boost, F.lit(0.0)))
    )


def topic_boost(text: Column, rules: list[tuple[str, str, float, float]], topic: Column) -> Column:
    """The boosts of a topic: rules (topic, mark, points, most); a topic's points for the marks that a text holds, ``most`` at most of each rule."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return sum((F.when(topic.eqNullSafe(F.lit(t)), F.least(F.lit(most), F.regexp_count(low, F.lit(re.escape(mark))) * points)).otherwise(0.0) for t, mark, points, most in rules), F.lit(0.0))


def relevance_of(domain_match: Column, local_match: Column, coverage: Column, score: Column) -> Column:
    """High for an expected or local domain, medium for half of the terms and 5 points, else low."""
    return F.when(domain_match | local_match, "high").when((coverage >= 0.5) & (score >= 5.0), "medium").otherwise("low")


def term_coverage(terms: Column, text: Column) -> Column:
    """The share of a query's terms that a text holds."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(F.try_divide(F.size(F.filter(terms, lambda t: low.contains(t))).cast("double"), F.size(terms)), F.lit(0.0))


def contains_fallback(found: DataFrame, docs: DataFrame, queries: DataFrame, query_key: str, terms: str, key: str, text: str) -> DataFrame:
    """(query, document, score) of ``found``, and for queries without any hit the documents that hold a term anywhere in their text, by their number of such terms.

    Each document's terms are looked for in blocks of unanswered queries, each broadcast.
    """
    lost = queries.join(found.select(query_key).distinct(), query_key, "left_anti").select(query_key, terms)
    texts = docs.where(F.col(text).isNotNull()).select(key, F.lower(text).alias("_t"))
    out = found.select(query_key, key, "score")
    for part in query_blocks(lost, query_key):
        met = F.filter(terms, lambda w: F.col("_t").contains(w))
        out = out.unionByName(texts.join(F.broadcast(part), F.exists(terms, lambda w: F.col("_t").contains(w))).select(query_key, key, F.size(met).cast("double").alias("score")))
    return out


def supplement(pulls: list[DataFrame], query_key: str, key: str) -> DataFrame:
    """Candidate lists merged by id: a candidate keeps the score and the ``pull`` number of the first list that has it."""
    union = None
    for i, d in enumerate(pulls):
        part = d.select(query_key, key, "score", F.lit(i).alias("pull"))
        union = part if union is None else union.unionByName(part)
    return union.groupBy(query_key, key).agg(F.min("pull").alias("pull"), F.min_by("score", "pull").alias("score"))


def write_index(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", buckets: int = 64) -> None:
    """The inverted index as tables: postings partitioned by a hash of the term, and one row of statistics. Searches read the partitions of their terms only."""
    post = build_postings(docs, key, text).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    post.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(8))).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    index_stats(docs, text).withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/stats")


def search_index(spark: SparkSession, folder: str, queries: DataFrame, query_key: str, query_text: str, key: str = "doc_id", k1: float = K1, b: float = B) -> DataFrame:
    """R2: (query, document, score) from a stored index, without reading a text: of the postings only the buckets of the queries' terms."""
    stats = spark.read.parquet(f"{folder}/stats")
    terms = query_terms(queries, query_key, query_text)
    n = stats.first().buckets
    wanted = sorted(r[0] for r in terms.select(F.pmod(F.xxhash64("term"), F.lit(n)).cast("int")).distinct().collect())  # no more than there are buckets
    post = spark.read.parquet(f"{folder}/postings").where(F.col("bucket").isin(wanted))
    post = post.join(broadcast_if_small(terms.select("term").distinct(), 32 << 20), "term", "left_semi")
    return _bm25_scores(post, stats, terms, query_key, key, k1, b)


def relevance_label(score: Column, high: float = 12.0, medium: float = 6.0) -> Column:
    """R9."""
    return F.when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def apply_rules(items: DataFrame, rules: DataFrame, text: Column, key: str, most_rules: int = 2_000) -> DataFrame:
    """Weighted keyword rules (``topic, keyword, weight, rule_order``) on texts: score by topic. A rule set is a caller's small table; it is folded into one expression, so no join of texts and rules; more than ``most_rules`` raise an error."""
    rows = rules.limit(most_rules + 1).collect()
    if len(rows) > most_rules:
        raise ValueError(f"more than {most_rules} rules")
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = F.array(*[F.when(low.contains(r["keyword"]), F.struct(F.lit(r["topic"]).alias("topic"), F.lit(float(r["weight"])).alias("weight"), F.lit(r["rule_order"]).alias("rule_order"))) for r in rows])
    d = items.select(key, F.explode(F.array_compact(hits)).alias("h"))
    by = d.groupBy(key, F.col("h.topic").alias("topic")).agg(F.sum("h.weight").alias("score"), F.min("h.rule_order").alias("first_rule"))
    return top_k(by, [key], [F.desc("score"), F.asc("first_rule")], 1).select(key, "topic", "score")


def cosine(a: Column, b: Column) -> Column:
    """R24."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def vector_search(vectors: DataFrame, queries: DataFrame, key: str, vec: str, query_key: str, query_vec: str, k: int) -> DataFrame:
    """Exact cosine of a query set against all rows, in blocks: each block of queries is broadcast, the best k kept inside each map task before the shuffle."""
    return top_k(cosine_scores(vectors, queries, key, vec, query_key, query_vec), [query_key], [F.desc("score"), F.asc(key)], k)


def cosine_scores(vectors: DataFrame, queries: DataFrame, key: str, vec: str, query_key: str, query_vec: str, block_bytes: int = 64 << 20) -> DataFrame:
    """``query, key, score`` of a stated query set against all rows. Queries beyond ``block_bytes`` are split by hash into blocks of that size, each a pass over the rows, so a broadcast is always bounded."""
    out = None
    for part in query_blocks(queries.select(F.col(query_key), F.col(query_vec)), query_key, block_bytes):
        scored = vectors.select(F.col(key), F.col(vec)).crossJoin(F.broadcast(part)).select(query_key, key, cosine(F.col(vec), F.col(query_vec)).alias("score"))
        out = scored if out is None else out.unionByName(scored)
    return out


def query_blocks(queries: DataFrame, key: str, block_bytes: int = 64 << 20) -> list[DataFrame]:
    """A query set in parts of about ``block_bytes``, by the hash of its key; what the estimate takes for more than one part is measured."""
    blocks = -(-size_in_bytes(queries) // block_bytes)
    if blocks > 1:
        measured = queries.agg(F.sum(F.length(F.to_json(F.struct(*queries.columns)))).alias("b")).first().b or 1
        blocks = -(-int(measured) // block_bytes)
    if blocks <= 1:
        return [queries]
    return [queries.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == i) for i in range(blocks)]


def reciprocal_rank_fusion(lists: list[DataFrame], query_key: str, key: str, k: int = 60) -> DataFrame:
    """Sum of 1 / (k + rank) over ranked lists."""
    union = None
    for d in lists:
        part = d.select(query_key, key, (1.0 / (F.lit(k) + F.col("rank"))).alias("part"))
        union = part if union is None else union.unionByName(part)
    return union.groupBy(query_key, key).agg(F.sum("part").alias("score"), F.count("*").alias("lists"))
