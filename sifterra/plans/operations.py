"""Queries over cycles, events, dialogues, evaluation records, registry and the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sifterra.functions import script, text, url
from sifterra.operators import lifecycle, metrics, sampling, search, sequences
from sifterra.plans.registry import query
from sifterra.session import broadcast_if_small, load

_CYC = """c AS (SELECT *, html_fetched + binaries_fetched AS touched, (html_fetched + binaries_fetched > 0 AND docs_inserted = 0 AND docs_superseded = 0) AS idle FROM (SELECT DISTINCT * FROM poll_cycles) WHERE source_id IS NOT NULL),
    o AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, cycle_id DESC) AS n FROM c),
    s AS (SELECT source_id, coalesce(min(CASE WHEN NOT idle THEN n END) - 1, max(n)) AS streak, coalesce(min(CASE WHEN errors = 0 OR touched > 0 THEN n END) - 1, max(n)) AS failures FROM o GROUP BY 1),
    m AS (SELECT source_id, count(*) AS n_cycles, count(*) FILTER (errors = 0 OR touched > 0) AS successes, count(*) FILTER (idle) AS empty_extractions, count(*) FILTER (errors > touched) / count(*)::DOUBLE AS error_rate,
      CASE WHEN sum(docs_inserted + docs_superseded + docs_unchanged) = 0 THEN 0.0 ELSE sum(docs_inserted + docs_superseded) / sum(docs_inserted + docs_superseded + docs_unchanged)::DOUBLE END AS change_rate, bool_or(shell_flagged) FILTER (n = 1) AS last_shell, sum(docs_inserted) AS docs_ever FROM o GROUP BY 1)"""


def _cycles(spark, d):
    return load(spark, d, "poll_cycles").distinct().where("source_id is not null")


@query("WITH " + _CYC + " SELECT source_id, CAST(n_cycles AS BIGINT) AS n_cycles, CAST(successes AS BIGINT) AS successes, CAST(empty_extractions AS BIGINT) AS empty_extractions, error_rate, change_rate, CAST(streak AS BIGINT) AS streak FROM m JOIN s USING (source_id)")
def health_metrics(spark, d):
    """A6, W1"""
    return lifecycle.health_metrics(_cycles(spark, d)).select("source_id", "n_cycles", "successes", "empty_extractions", "error_rate", "change_rate", "streak")


@query("WITH " + _CYC + " SELECT source_id, CAST(failures AS BIGINT) AS consecutive_failures FROM s")
def failure_streak(spark, d):
    """W2, T10"""
    return lifecycle.failure_runs(_cycles(spark, d))


@query(
    "WITH " + _CYC + """ SELECT m.source_id, CASE WHEN r.status = 'js_only' OR coalesce(last_shell, false) THEN 'shell_detected' WHEN failures >= 20 THEN 'dead' WHEN n_cycles < 3 THEN 'insufficient_data' WHEN error_rate >= 0.8 THEN 'dormant_blocked'
      WHEN streak >= 5 AND docs_ever >= 5 THEN 'structurally_failed' ELSE 'healthy' END AS verdict FROM m JOIN s USING (source_id) LEFT JOIN (SELECT DISTINCT source_id, status FROM source_registry) r USING (source_id)"""
)
def health_verdict(spark, d):
    """One ordered chain of rules"""
    c = _cycles(spark, d)
    m = lifecycle.health_metrics(c).join(lifecycle.failure_runs(c), "source_id").join(c.groupBy("source_id").agg(F.sum("docs_inserted").alias("docs_ever")), "source_id")
    r = load(spark, d, "source_registry").select("source_id", "status").distinct()
    m = m.join(broadcast_if_small(r), "source_id", "left")
    x = {k: F.col(k) for k in ("status", "last_shell", "consecutive_failures", "n_cycles", "error_rate", "streak", "docs_ever")}
    return m.select("source_id", lifecycle.verdict(x["status"], x["last_shell"], x["consecutive_failures"], x["n_cycles"], x["error_rate"], x["streak"], x["docs_ever"]).alias("verdict"))


@query("SELECT source_id, stop_reason, errors FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, cycle_id DESC) AS n FROM (SELECT DISTINCT * FROM poll_cycles) WHERE source_id IS NOT NULL) WHERE n = 1")
def latest_cycle(spark, d):
    """By max_by, so no source's rows are sorted in one task"""
    c = _cycles(spark, d)
    return c.groupBy("source_id").agg(F.max_by(F.struct("stop_reason", "errors"), F.struct("started_at", "cycle_id")).alias("x")).select("source_id", "x.stop_reason", "x.errors")


@query("SELECT source_id, CAST(CAST(started_at AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS cycles, CAST(sum(errors) AS BIGINT) AS errors, CAST(coalesce(sum(docs_inserted), 0) AS BIGINT) AS inserted, CAST(greatest(coalesce(sum(docs_inserted - docs_superseded), 0), 0) AS BIGINT) AS net FROM (SELECT DISTINCT * FROM poll_cycles) WHERE started_at IS NOT NULL GROUP BY ALL")
def poll_cycles_daily(spark, d):
    """A5, A6"""
    c = load(spark, d, "poll_cycles").distinct().where("started_at is not null")
    return c.groupBy("source_id", F.to_date("started_at").cast("string").alias("day")).agg(
        F.count("*").alias("cycles"), F.sum("errors").alias("errors"), F.coalesce(F.sum("docs_inserted"), F.lit(0)).cast("bigint").alias("inserted"), F.greatest(F.coalesce(F.sum(F.col("docs_inserted") - F.col("docs_superseded")), F.lit(0)), F.lit(0)).cast("bigint").alias("net")
    )


@query("SELECT tier, CAST(count(*) AS BIGINT) AS sources, CAST(count(*) FILTER (status = 'active') AS BIGINT) AS active FROM source_registry GROUP BY tier")
def registry_tier_counts(spark, d):
    """A1, A2"""
    return load(spark, d, "source_registry").groupBy("tier").agg(F.count("*").alias("sources"), F.count_if(F.col("status") == "active").alias("active"))


@query(
    """
    WITH l AS (SELECT source_id, max(started_at) AS last FROM poll_cycles GROUP BY 1), now AS (SELECT max(started_at) AS t FROM poll_cycles)
    SELECT source_id, tier FROM source_registry LEFT JOIN l USING (source_id), now
    WHERE status = 'active' AND (last IS NULL OR last + coalesce(poll_interval_hours, CASE tier WHEN 1 THEN 6 WHEN 2 THEN 12 WHEN 3 THEN 24 WHEN 4 THEN 84 ELSE 48 END) * INTERVAL 1 HOUR <= t)"""
)
def due_sources_order(spark, d):
    """Active sources never polled or past their interval, by tier and id"""
    last = load(spark, d, "poll_cycles").groupBy("source_id").agg(F.max("started_at").alias("last"))
    now = F.broadcast(load(spark, d, "poll_cycles").agg(F.max("started_at").alias("t")))  # one row
    hours = F.coalesce("poll_interval_hours", F.when(F.col("tier") == 1, 6).when(F.col("tier") == 2, 12).when(F.col("tier") == 3, 24).when(F.col("tier") == 4, 84).otherwise(48))
    due = load(spark, d, "source_registry").join(last, "source_id", "left").crossJoin(now).where("status = 'active'").where(F.col("last").isNull() | (F.col("last") + F.make_interval(hours=hours) <= F.col("t")))
    return due.select("source_id", "tier").orderBy("tier", "source_id")


@query("SELECT r.source_id, coalesce(p.name_en, r.name_en) AS name_en, coalesce(p.status, r.status) AS status, coalesce(r.first_seen, p.first_seen) AS first_seen, CASE WHEN p.source_id IS NULL THEN 'kept' ELSE 'updated' END AS upsert_state FROM source_registry r LEFT JOIN (SELECT source_id, domain AS name_en, 'dormant' AS status, '2099-01-01' AS first_seen FROM source_registry WHERE tier = 2) p USING (source_id)")
def registry_upsert_overlay(spark, d):
    """A patch over the registry; first_seen never changes"""
    base = load(spark, d, "source_registry").select("source_id", "name_en", "status", "first_seen")
    patch = load(spark, d, "source_registry").where("tier = 2").select("source_id", F.col("domain").alias("name_en"), F.lit("dormant").alias("status"), F.lit("2099-01-01").alias("first_seen"))
    return lifecycle.overlay(base, patch, ["source_id"], immutable=("first_seen",)).select("source_id", "name_en", "status", F.col("first_seen"), "upsert_state")


@query(
    """
    WITH d AS (SELECT DISTINCT doc_id, source_id, url, content_hash, superseded_by, removed_at FROM crawl_documents WHERE source_id IS NOT NULL AND url IS NOT NULL),
    cur AS (SELECT * FROM d WHERE left(md5(url), 1) < 'c'), inc AS (SELECT doc_id || '#' AS doc_id, source_id, url, CASE WHEN left(md5(doc_id), 1) < '8' THEN content_hash ELSE 'new' END AS content_hash, row_number() OVER (PARTITION BY source_id, url ORDER BY doc_id) AS n FROM d),
    a AS (SELECT source_id, url, doc_id AS prev_id, content_hash AS prev_hash FROM cur WHERE superseded_by IS NULL AND removed_at IS NULL)
    SELECT inc.doc_id, prev_id, CASE WHEN prev_id IS NULL THEN 'inserted' WHEN prev_hash = content_hash THEN 'unchanged' ELSE 'superseded' END AS outcome FROM (SELECT * FROM inc WHERE n = 1) inc LEFT JOIN a USING (source_id, url)"""
)
def upsert_outcome(spark, d):
    """Incoming versions against the live snapshot"""
    t = load(spark, d, "crawl_documents").where("source_id is not null and url is not null").select("doc_id", "source_id", "url", "content_hash", "superseded_by", "removed_at", F.lit("0").alias("fetched_at")).distinct()
    cur = t.where(F.left(F.md5("url"), F.lit(1)) < "c")
    inc = t.select(F.concat("doc_id", F.lit("#")).alias("doc_id"), "source_id", "url", F.when(F.left(F.md5("doc_id"), F.lit(1)) < "8", F.col("content_hash")).otherwise("new").alias("content_hash"), "fetched_at")
    return lifecycle.upsert_documents(cur, inc)[1].select("doc_id", "prev_id", "outcome")


@query("SELECT DISTINCT source_id FROM poll_cycles WHERE shell_flagged AND source_id NOT IN (SELECT source_id FROM source_registry WHERE status = 'active' AND source_id IS NOT NULL)")
def repair_queue_reaction(spark, d):
    """Flagged sources that have no pending entry yet"""
    flagged = load(spark, d, "poll_cycles").where("shell_flagged").select("source_id").distinct()
    queue = load(spark, d, "source_registry").select("source_id", F.when(F.col("status") == "active", "pending").otherwise("done").alias("status"))
    return lifecycle.enqueue_once(flagged, queue, "source_id")


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_event_per_user(spark, d):
    """J6, J10, W4"""
    e = load(spark, d, "events")
    return e.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("x")).select("user_id", "x.event_type", "x.value")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS events, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS errors FROM events, (SELECT max(ts) AS m FROM events) WHERE ts >= m - INTERVAL 7 DAY GROUP BY 1")
def rolling_window_7d(spark, d):
    """F3, ST6"""
    e = load(spark, d, "events")
    m = F.broadcast(e.agg(F.max("ts").alias("m")))  # one row
    return e.crossJoin(m).where(F.col("ts") >= F.col("m") - F.make_dt_interval(F.lit(7))).groupBy("user_id").agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query("SELECT event_id, CAST(n AS BIGINT) AS in_24h, n > 5 AS limited FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS n FROM events)")
def rate_limit_24h(spark, d):
    """ST3: events of the last 24 hours per key"""
    e = load(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    n = sequences.rolling_count(e, "user_id", "us", "event_id", 86_400_000_000, "in_24h")
    return n.select("event_id", "in_24h", (F.col("in_24h") > 5).alias("limited"))


@query("SELECT event_id, coalesce(ts - p < INTERVAL 5 MINUTE, false) AS cooling FROM (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)")
def cooldown_gate(spark, d):
    """ST4, ST8: interval to the key's previous event"""
    e = load(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    g = sequences.gap_to_previous(e, "user_id", "us", "event_id")
    return g.select("event_id", F.coalesce(F.col("gap") < 300_000_000, F.lit(False)).alias("cooling"))


@query("SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(event_id) AS event_id FROM events GROUP BY ALL")
def message_dedup_ttl(spark, d):
    """ST2 in batch form: one message of a key a day"""
    e = load(spark, d, "events")
    return e.groupBy("user_id", "event_type", F.to_date("ts").cast("string").alias("day")).agg(F.min("event_id").alias("event_id"))


@query("SELECT user_id, CAST(sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 30 MINUTE THEN 1 ELSE 0 END) AS BIGINT) AS sessions FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1")
def user_sessions(spark, d):
    """Extension: visits by a gap of 30 minutes"""
    e = load(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    g = sequences.gap_to_previous(e, "user_id", "us", "event_id")
    return g.groupBy("user_id").agg(F.count_if(F.col("gap").isNull() | (F.col("gap") > 1_800_000_000)).alias("sessions"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN json_extract_string(props, '$.k') IS NOT NULL OR props IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_props, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def event_type_stats(spark, d):
    """N, A2: JSON as a variant column"""
    e = load(spark, d, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.try_parse_json("props").isNotNull()).alias("with_props"), F.round(F.avg("value"), 6).alias("mean"))


_TURNS = "(SELECT DISTINCT conv_id, turn_no, role, content FROM chat_turns)"


@query(f"SELECT conv_id, turn_no, last_value(CASE WHEN role = 'user' THEN turn_no END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked_turn FROM (SELECT DISTINCT conv_id, turn_no, role FROM chat_turns) QUALIFY role = 'assistant'")
def previous_user_turn(spark, d):
    """W13"""
    t = load(spark, d, "chat_turns").select("conv_id", "turn_no", "role").distinct()
    return sequences.last_before(t, "conv_id", "turn_no", F.col("turn_no"), F.col("role") == "user", "asked_turn").where("role = 'assistant'").select("conv_id", "turn_no", "asked_turn")


@query("SELECT conv_id, turn_no, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn_no DESC) AS n FROM (SELECT DISTINCT conv_id, turn_no, role FROM chat_turns)) WHERE n <= 8")
def history_last_k(spark, d):
    """W12, ST5: the last eight turns, ranks pruned before the shuffle"""
    t = load(spark, d, "chat_turns").select("conv_id", "turn_no", "role").distinct()
    return search.top_k(t, ["conv_id"], [F.desc("turn_no")], 8, "n").select("conv_id", "turn_no", "role")


@query(f"SELECT conv_id, turn_no FROM (SELECT conv_id, turn_no, role, content, lead(content) OVER w AS nc, lead(role) OVER w AS nr FROM {_TURNS} WINDOW w AS (PARTITION BY conv_id ORDER BY turn_no)) WHERE role = 'user' AND nr = 'user' AND nc = content")
def resent_turns(spark, d):
    """User turns sent twice in a row"""
    t = load(spark, d, "chat_turns").select("conv_id", "turn_no", "role", F.sha2("content", 256).alias("h")).distinct()
    x = sequences.last_before(t, "conv_id", "turn_no", F.struct("turn_no", "role", "h"), F.lit(True), "prev")
    return x.where("role = 'user' and prev.role = 'user' and prev.h = h").select("conv_id", F.col("prev.turn_no").alias("turn_no"))


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS turns, list_aggregate(list_transform(list_sort(list({'n': turn_no, 's': role || ': ' || content})), lambda x: x.s), 'string_agg', chr(10)) AS messages FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn_no DESC, role DESC, content DESC) AS k FROM (SELECT DISTINCT conv_id, turn_no, role, content FROM chat_turns WHERE content IS NOT NULL)) WHERE k <= 8 GROUP BY conv_id")
def messages_whole(spark, d):
    """N, ST5: the last eight turns of a dialogue with their whole contents as one message list"""
    t = load(spark, d, "chat_turns").where("content is not null").select("conv_id", "turn_no", "role", "content").distinct()
    last = search.top_k(t, ["conv_id"], [F.desc("turn_no"), F.desc("role"), F.desc("content")], 8, "k")
    g = last.groupBy("conv_id").agg(F.count("*").alias("turns"), F.sort_array(F.collect_list(F.struct("turn_no", F.concat("role", F.lit(": "), "content").alias("s")))).alias("m"))
    return g.select("conv_id", "turns", F.array_join(F.transform("m", lambda x: x["s"]), "\n").alias("messages"))


@query(r"SELECT DISTINCT conv_id, turn_no, regexp_matches(content, '(?i)\?|^\s*(?:how|what|where|when|why|who|which|can|could|is|are|do|does|should|anyone)\b|\b(?:kasari|kaha|kahile|kati|kina)\b|कसरी|कहाँ|कहिले|कति|किन') AS question FROM chat_turns WHERE content IS NOT NULL AND role = 'user'")
def question_filter(spark, d):
    """T-9"""
    return load(spark, d, "chat_turns").where("content is not null and role = 'user'").select("conv_id", "turn_no", text.is_question(F.col("content")).alias("question")).distinct()


@query("SELECT DISTINCT result_id, coalesce(regexp_matches(model_output, '" + text.REFUSAL_PATTERN.replace("'", "''") + "'), false) AS refusal FROM smoke_results")
def refusal_detect(spark, d):
    """T-14"""
    return load(spark, d, "smoke_results").select("result_id", text.is_refusal(F.col("model_output")).alias("refusal")).distinct()


@query(
    r"""
    WITH t AS (SELECT DISTINCT result_id, regexp_extract_all(lower(model_output), '[\p{L}\p{N}_ऀ-ॿ]+') AS w FROM smoke_results WHERE model_output IS NOT NULL),
    g AS (SELECT result_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT result_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM t WHERE len(w) >= 3)), m AS (SELECT result_id, max(n) AS n FROM (SELECT result_id, s, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1)
    SELECT t.result_id, coalesce(m.n >= 4, false) AS looping FROM t LEFT JOIN m USING (result_id)"""
)
def loop_detect(spark, d):
    """T-17, A29"""
    return load(spark, d, "smoke_results").where("model_output is not null").select("result_id", "model_output").distinct().select("result_id", text.loops(F.col("model_output")).alias("looping"))


@query(r"SELECT result_id, list_aggregate(list_sort(list_distinct(list_transform(regexp_extract_all(model_output, '\[(S?\d+)\]', 1), lambda m: 'S' || regexp_replace(m, '^S', '')))), 'string_agg', ',') AS marks FROM (SELECT DISTINCT result_id, model_output FROM smoke_results WHERE regexp_matches(model_output, '\[S?\d+\]'))")
def citation_extract(spark, d):
    """T-19, T-20"""
    t = load(spark, d, "smoke_results").where(F.col("model_output").rlike(r"\[S?\d+\]")).select("result_id", "model_output").distinct()
    return t.select("result_id", F.array_join(F.array_sort(text.citations(F.col("model_output"))), ",").alias("marks"))


@query("SELECT DISTINCT result_id, CASE WHEN len(model_citations) = 0 OR model_citations IS NULL THEN NULL ELSE len(list_intersect(list_distinct(model_citations), regexp_extract_all(coalesce(model_output, ''), '\\[(S\\d+)\\]', 1))) / len(list_distinct(model_citations))::DOUBLE END AS citation_recall FROM smoke_results")
def citation_recall(spark, d):
    """E3"""
    found = F.regexp_extract_all(F.coalesce("model_output", F.lit("")), F.lit(r"\[(S\d+)\]"), F.lit(1))
    return load(spark, d, "smoke_results").select("result_id", metrics.recall(F.col("model_citations"), F.col("model_citations")).alias("_"), "model_citations", found.alias("f")).select("result_id", F.when(F.size("model_citations") > 0, metrics.recall(F.col("f"), F.col("model_citations"))).alias("citation_recall")).distinct()


@query(
    """
    WITH s AS (SELECT DISTINCT result_id, coalesce(model_output, '') AS h, coalesce(question, '') AS r FROM smoke_results), k AS (SELECT *, unnest(generate_series(1, 6)) AS n FROM s),
    hg AS (SELECT result_id, n, g, count(*) AS c FROM (SELECT result_id, n, substr(h, unnest(generate_series(1, length(h) - n + 1)), n) AS g FROM k WHERE length(h) >= n) GROUP BY ALL),
    rg AS (SELECT result_id, n, g, count(*) AS c FROM (SELECT result_id, n, substr(r, unnest(generate_series(1, length(r) - n + 1)), n) AS g FROM k WHERE length(r) >= n) GROUP BY ALL),
    o AS (SELECT result_id, n, sum(least(hg.c, rg.c)) AS hit FROM hg JOIN rg USING (result_id, n, g) GROUP BY ALL),
    f AS (SELECT k.result_id, avg(coalesce(hit, 0) / (length(h) - n + 1)::DOUBLE) AS p, avg(coalesce(hit, 0) / (length(r) - n + 1)::DOUBLE) AS q FROM k LEFT JOIN o USING (result_id, n) WHERE length(h) >= n AND length(r) >= n GROUP BY 1)
    SELECT s.result_id, round(coalesce(CASE WHEN p + q = 0 THEN 0.0 ELSE 100 * 5 * p * q / (4 * p + q) END, 0.0), 6) AS chrf FROM s LEFT JOIN f USING (result_id)"""
)
def chrf_score(spark, d):
    """Question against answer of the evaluation records"""
    return load(spark, d, "smoke_results").select("result_id", "question", "model_output").distinct().select("result_id", F.round(metrics.chrf("model_output", "question"), 6).alias("chrf"))


@query(
    r"""
    WITH RECURSIVE t AS (SELECT DISTINCT result_id, list_filter(regexp_split_to_array(coalesce(question, ''), '[\s\x{001C}-\x{001F}\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]+'), lambda w: w <> '') AS q,
      list_filter(regexp_split_to_array(coalesce(model_output, ''), '[\s\x{001C}-\x{001F}\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]+'), lambda w: w <> '') AS o FROM smoke_results),
    r AS (SELECT result_id, q, o, 0 AS i, list_transform(q, lambda x: 0) AS line FROM t WHERE len(q) > 0 AND len(o) > 0
      UNION ALL SELECT result_id, q, o, i + 1, list_transform(range(1, len(q) + 1), lambda j: list_max(c[1:j])) FROM (
        SELECT *, list_transform(range(1, len(q) + 1), lambda j: greatest(line[j], CASE WHEN q[j] = o[i + 1] THEN CASE WHEN j > 1 THEN line[j - 1] ELSE 0 END + 1 ELSE 0 END)) AS c FROM r WHERE i < len(o))),
    l AS (SELECT result_id, len(q) AS nq, len(o) AS no, line[len(q)] AS n FROM r WHERE i = len(o))
    SELECT t.result_id, coalesce(CASE WHEN n > 0 THEN 2.0::DOUBLE * (n / no::DOUBLE) * (n / nq::DOUBLE) / (n / no::DOUBLE + n / nq::DOUBLE) END, 0.0::DOUBLE) AS rouge_l FROM t LEFT JOIN l USING (result_id)"""
)
def rouge_l_score(spark, d):
    """E2"""
    return load(spark, d, "smoke_results").select("result_id", "question", "model_output").distinct().select("result_id", metrics.rouge_l("model_output", "question").alias("rouge_l"))


@query(
    """
    WITH r AS (SELECT DISTINCT result_id, kind, category, question_lang, chrf, model_refused FROM smoke_results)
    SELECT kind, category, question_lang, CAST(count(*) AS BIGINT) AS n, round(avg(chrf), 6) AS mean_chrf, list_sort(list(chrf) FILTER (chrf IS NOT NULL))[CAST(count(chrf) // 2 + 1 AS BIGINT)] AS median_chrf, CAST(count(*) FILTER (model_refused) AS BIGINT) AS refused
    FROM r GROUP BY GROUPING SETS ((kind), (kind, category), (question_lang))"""
)
def eval_aggregate_sets(spark, d):
    """Grouping sets with the upper median"""
    t = load(spark, d, "smoke_results").select("result_id", "kind", "category", "question_lang", "chrf", "model_refused").distinct()
    none = F.lit(None).cast("string")
    sets = [(F.lit(1), F.col("kind"), none, none), (F.lit(2), F.col("kind"), F.col("category"), none), (F.lit(3), none, none, F.col("question_lang"))]
    keys = F.array(*[F.struct(a.alias("s"), b.alias("kind"), c.alias("category"), e.alias("question_lang")) for a, b, c, e in sets])
    x = t.select("chrf", "model_refused", F.explode(keys).alias("k")).withColumn("g", F.to_json("k"))
    agg = x.groupBy("g", "k").agg(F.count("*").alias("n"), F.round(F.avg("chrf"), 6).alias("mean_chrf"), F.count_if("model_refused").alias("refused"))
    med = metrics.upper_median(x, "g", "chrf", name="median_chrf")
    return agg.join(med, "g", "left").select("k.kind", "k.category", "k.question_lang", "n", "mean_chrf", "median_chrf", "refused")


@query("SELECT kind, CAST(count(*) FILTER (model_refused) AS BIGINT) AS refused, CAST(count(*) FILTER (NOT model_refused) AS BIGINT) AS answered, CAST(count(*) FILTER (model_refused IS NULL) AS BIGINT) AS pending FROM (SELECT DISTINCT result_id, kind, model_refused FROM smoke_results) GROUP BY kind")
def review_progress_pivot(spark, d):
    """Matrix with a default column"""
    t = load(spark, d, "smoke_results").select("result_id", "kind", F.when(F.col("model_refused"), "refused").when(~F.col("model_refused"), "answered").otherwise("pending").alias("v")).distinct()
    return t.groupBy("kind").pivot("v", ["refused", "answered", "pending"]).agg(F.count("v")).na.fill(0)


@query("SELECT suite, CAST(count(*) AS BIGINT) AS valid, (count(*) FILTER (r = 'win') + 0.5 * count(*) FILTER (r = 'tie')) / count(*) AS win_rate FROM (SELECT suite, CASE WHEN chrf > 50 THEN 'win' WHEN chrf < 30 THEN 'loss' ELSE 'tie' END AS r FROM (SELECT DISTINCT result_id, suite, chrf FROM smoke_results) WHERE chrf IS NOT NULL) GROUP BY suite")
def pairwise_winrate(spark, d):
    """A14"""
    t = load(spark, d, "smoke_results").where("chrf is not null").select("result_id", "suite", "chrf").distinct()
    return metrics.win_rate(t.withColumn("r", F.when(F.col("chrf") > 50, "win").when(F.col("chrf") < 30, "loss").otherwise("tie")), ["suite"], "r")


@query(r"SELECT result_id, array_to_string(list_filter([CASE WHEN model_output IS NULL OR NOT regexp_matches(model_output, '[^\s\x{00A0}]') THEN 'empty' END, CASE WHEN len(model_citations) = 0 AND kind = 'grounded' THEN 'no_citation' END, CASE WHEN kind = 'refusal' AND model_refused = false THEN 'not_refused' END, CASE WHEN chrf < 10 THEN 'low_chrf' END], lambda x: x IS NOT NULL), ',') AS issues FROM (SELECT DISTINCT result_id, kind, model_output, model_citations, model_refused, chrf FROM smoke_results)")
def answer_audit(spark, d):
    """R16, A16, E4, E8, N"""
    t = load(spark, d, "smoke_results").select("result_id", "kind", "model_output", "model_citations", "model_refused", "chrf").distinct()
    issues = metrics.issue_list([("empty", text.is_blank(F.col("model_output"))), ("no_citation", (F.size("model_citations") == 0) & (F.col("kind") == "grounded")), ("not_refused", (F.col("kind") == "refusal") & ~F.col("model_refused")), ("low_chrf", F.col("chrf") < 10)])
    return t.select("result_id", F.array_join(issues, ",").alias("issues"))


_HASH = "md5('s:' || doc_id)"


@query(f"WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_HASH}, doc_id) AS n, count(*) OVER (PARTITION BY source) AS c FROM documents) SELECT doc_id, CASE WHEN n <= greatest(1, floor(c * 0.1)) THEN 'val' ELSE 'train' END AS split FROM r")
def stratified_split(spark, d):
    """K12"""
    return sampling.stratified_split(load(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", 0.1).select("doc_id", "split")


@query(f"WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY source, doc_type ORDER BY {_HASH}, doc_id) AS n, count(*) OVER (PARTITION BY source, doc_type) AS c FROM documents) SELECT doc_id, CASE WHEN c >= 12 AND n <= greatest(1, round(c * 0.1)) THEN 'val' ELSE 'train' END AS split FROM r")
def min12_split(spark, d):
    """K13, DS6"""
    return sampling.stratified_split(load(spark, d, "documents").select("doc_id", "source", "doc_type"), ["source", "doc_type"], "doc_id", 0.1, 12, "round").select("doc_id", "split")


@query(f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_HASH}, doc_id) AS n FROM documents) WHERE n <= 5")
def stratified_pick(spark, d):
    """K10, K11, K14"""
    return sampling.stratified_pick(load(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", 5)


@query(f"SELECT doc_id, doc_type, lang FROM (SELECT doc_id, doc_type, lang, row_number() OVER (PARTITION BY doc_type, lang ORDER BY {_HASH}, doc_id) AS n FROM (SELECT doc_id, coalesce(doc_type, '') AS doc_type, coalesce(lang, '') AS lang FROM documents)) ORDER BY n, doc_type, lang, doc_id LIMIT 60")
def round_robin_sample(spark, d):
    """A sample of 60 over cells of type and label"""
    t = load(spark, d, "documents").select("doc_id", F.coalesce("doc_type", F.lit("")).alias("doc_type"), F.coalesce("lang", F.lit("")).alias("lang"))
    return sampling.round_robin(t, ["doc_type", "lang"], "doc_id", 60)


@query(f"WITH a AS (SELECT count(*) AS n FROM documents WHERE doc_type <> 'forum'), f AS (SELECT doc_id, row_number() OVER (ORDER BY {_HASH}, doc_id) AS n FROM documents WHERE doc_type = 'forum') SELECT doc_id FROM documents WHERE doc_type <> 'forum' UNION ALL SELECT doc_id FROM f, a WHERE f.n <= floor(0.1 * a.n / 0.9 + 1e-9)")
def fraction_cap(spark, d):
    """Forum documents are at most a tenth of the result"""
    return sampling.cap_share(load(spark, d, "documents").where("doc_type is not null").select("doc_id", "doc_type"), F.col("doc_type") == "forum", "doc_id", 0.1).select("doc_id")


@query("SELECT doc_id, CAST(unnest(generate_series(1, CASE doc_type WHEN 'law' THEN 3 WHEN 'faq' THEN 2 ELSE 1 END)) AS INTEGER) AS copy_no FROM documents")
def mix_repeat(spark, d):
    """K17"""
    r = F.when(F.col("doc_type") == "law", 3).when(F.col("doc_type") == "faq", 2).otherwise(1)
    return sampling.repeat_mix(load(spark, d, "documents").select("doc_id", "doc_type"), r).select("doc_id", "copy_no")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM mix_targets m WHERE m.source = d.source)")
def heldout_exclusion(spark, d):
    """K19, F20"""
    return sampling.exclude_held_out(load(spark, d, "documents").select("doc_id", "source"), load(spark, d, "mix_targets"), ["source"]).select("doc_id")


@query("SELECT source FROM (SELECT source FROM documents INTERSECT SELECT source FROM mix_targets) UNION ALL SELECT 'only:' || source FROM (SELECT source FROM documents EXCEPT SELECT source FROM mix_targets)")
def set_ops_sources(spark, d):
    """X3, X4"""
    a, b = load(spark, d, "documents").select("source"), load(spark, d, "mix_targets").select("source")
    return a.intersect(b).unionByName(a.subtract(b).select(F.concat(F.lit("only:"), "source").alias("source")))


@query("SELECT 'gold:' || item_id AS rec, question AS body, question_lang AS lang FROM gold_items UNION ALL SELECT DISTINCT 'smoke:' || result_id, question, question_lang FROM smoke_results")
def merge_unified(spark, d):
    """X1, X2"""
    g = load(spark, d, "gold_items").select(F.concat(F.lit("gold:"), F.col("item_id").cast("string")).alias("rec"), F.col("question").alias("body"), F.col("question_lang").alias("lang"))
    s = load(spark, d, "smoke_results").select(F.concat(F.lit("smoke:"), F.col("result_id").cast("string")).alias("rec"), F.col("question").alias("body"), F.col("question_lang").alias("lang")).distinct()
    return g.unionByName(s)


@query("SELECT doc_id FROM (SELECT DISTINCT doc_id, chunk_id, length(text) >= 200 AND language IS NOT NULL AS ok FROM chunks) GROUP BY doc_id HAVING bool_and(ok)")
def all_children_clean(spark, d):
    """F10, F14"""
    c = load(spark, d, "chunks").select("doc_id", "chunk_id", ((F.length("text") >= 200) & F.col("language").isNotNull()).alias("ok")).distinct()
    return c.groupBy("doc_id").agg(F.bool_and("ok").alias("ok")).where("ok").select("doc_id")


_BM25_TOK = r"list_filter(list_transform(regexp_split_to_array({t}, '[\s\x{{00A0}}\x{{0085}}\x{{2028}}\x{{2029}}\x{{3000}}]+'), lambda w: lower(regexp_replace(w, '[^A-Za-z0-9ऀ-ॿ]', '', 'g'))), lambda w: length(w) >= 2)"
_BM25 = (
    "d AS (SELECT doc_id, " + _BM25_TOK.format(t="text") + " AS ts FROM documents WHERE text IS NOT NULL), st AS (SELECT count(*) AS nd, avg(len(ts)) AS avgdl FROM d), q AS (SELECT item_id, term, count(*) AS w FROM (SELECT item_id, unnest(" + _BM25_TOK.format(t="question") + ") AS term FROM (SELECT item_id, question FROM gold_items WHERE item_id % 50 = 0)) GROUP BY 1, 2),"
    " p AS (SELECT term, doc_id, dl, count(*) AS tf FROM (SELECT doc_id, len(ts) AS dl, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),"
    " s AS (SELECT q.item_id, p.doc_id, sum(q.w * greatest(ln((nd - df + 0.5) / (df + 0.5) + 1.0), 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN p USING (term) JOIN f USING (term), st GROUP BY 1, 2)"
)


@query("WITH " + _BM25 + " SELECT item_id, doc_id, round(score, 6) AS score, CAST(n AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS n FROM s) WHERE n <= 10")
def bm25_topk(spark, d):
    """The query set of items divisible by 50 against all documents"""
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    s = search.bm25(load(spark, d, "documents"), q, "item_id", "question").withColumn("score", F.round("score", 6))
    return search.top_k(s, ["item_id"], [F.desc("score"), F.asc("doc_id")], 10).withColumn("rank", F.col("rank").cast("bigint"))


@query("WITH d AS (SELECT doc_id, " + _BM25_TOK.format(t="text") + " AS ts FROM documents WHERE text IS NOT NULL), p AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) GROUP BY 1, 2) SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY term")
def postings_stats(spark, d):
    """A11, R1"""
    return search.build_postings(load(spark, d, "documents")).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@query("WITH " + _BM25 + ", t AS (SELECT s.item_id, s.doc_id, d2.url, d2.source, row_number() OVER (PARTITION BY s.item_id ORDER BY round(score, 6) DESC, s.doc_id) AS n, round(score, 6) AS score FROM s JOIN documents d2 USING (doc_id) QUALIFY n <= 64), x AS (SELECT *, round(score + greatest(0, 4 - 0.05 * (n - 1)) + CASE WHEN source LIKE 'mission%' THEN 7.5 ELSE -2 END, 6) AS total FROM t), o AS (SELECT *, row_number() OVER (PARTITION BY item_id, source ORDER BY total DESC, doc_id) AS k FROM x) SELECT item_id, doc_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY total DESC, doc_id) AS BIGINT) AS rank, CASE WHEN total >= 12 THEN 'high' WHEN total >= 6 THEN 'medium' ELSE 'low' END AS label FROM o WHERE k = 1")
def rerank_one_per_key(spark, d):
    """Over-fetch, features, one result per source, ranked anew"""
    q = load(spark, d, "gold_items").where("item_id % 50 = 0").select("item_id", "question")
    docs = load(spark, d, "documents")
    s = search.bm25(docs, q, "item_id", "question").withColumn("score", F.round("score", 6))
    t = search.top_k(s, ["item_id"], [F.desc("score"), F.asc("doc_id")], 64).withColumnRenamed("rank", "n").join(docs.select("doc_id", "source"), "doc_id")
    total = F.round(F.col("score") + search.rank_features(F.col("n"), F.lit(0.0), F.col("source").startswith("mission"), F.lit(False), F.lit(False)), 6)
    r = search.one_per_url(t.withColumn("total", total), ["item_id"], F.col("source"), [F.desc("total"), F.asc("doc_id")])
    return r.select("item_id", "doc_id", F.col("rank").cast("bigint"), search.relevance_label(F.col("total")).alias("label"))


@query(r"SELECT doc_id, CAST(least(len(regexp_extract_all(lower(text), 'fee')), 3) + least(len(regexp_extract_all(lower(text), 'office')), 3) + 0.5 * ((len(regexp_extract_all(lower(text), 'fee')) > 0)::INT + (len(regexp_extract_all(lower(text), 'office')) > 0)::INT) AS DOUBLE) AS score FROM documents WHERE text IS NOT NULL")
def keyword_scorer(spark, d):
    """R13"""
    return load(spark, d, "documents").where("text is not null").select("doc_id", search.keyword_score(F.col("text"), ["fee", "office"]).cast("double").alias("score"))


@query(
    r"""
    WITH rules AS (SELECT * FROM (VALUES ('fees', 'fee', 2.0, 1), ('fees', 'rupees', 1.0, 2), ('desk', 'desk', 2.0, 3), ('online', 'online', 2.5, 4)) t(topic, keyword, weight, rule_order)),
    h AS (SELECT doc_id, topic, sum(weight) AS score, min(rule_order) AS o FROM documents JOIN rules ON contains(lower(text), keyword) GROUP BY 1, 2)
    SELECT doc_id, topic, CAST(score AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, o) AS n FROM h) WHERE n = 1"""
)
def topic_detect(spark, d):
    """A small rule table"""
    rules = spark.createDataFrame([("fees", "fee", 2.0, 1), ("fees", "rupees", 1.0, 2), ("desk", "desk", 2.0, 3), ("online", "online", 2.5, 4)], "topic string, keyword string, weight double, rule_order int")
    return search.apply_rules(load(spark, d, "documents").where("text is not null"), rules, F.col("text"), "doc_id")


_DOT = "CAST(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS DOUBLE)"


@query(f"SELECT qid, vec_id, CAST(n AS BIGINT) AS rank FROM (SELECT b.vec_id AS qid, a.vec_id, row_number() OVER (PARTITION BY b.vec_id ORDER BY round({_DOT}, 6) DESC, a.vec_id) AS n FROM embeddings a, embeddings b WHERE b.vec_id % 50 = 0) WHERE n <= 10")
def vector_topk(spark, d):
    """Ids divisible by 50 against all rows, exact"""
    e = load(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    s = search.cosine_scores(e, q, "vec_id", "embedding", "qid", "qv").withColumn("score", F.round("score", 6))
    return search.top_k(s, ["qid"], [F.desc("score"), F.asc("vec_id")], 10).select("qid", "vec_id", F.col("rank").cast("bigint"))


@query("SELECT c_mktsegment, n_name, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_shipdate < TIMESTAMP '1998-09-02' GROUP BY ALL")
def revenue_by_segment(spark, d):
    """J1 on the relational tables: filters reach the scans, the small sides are broadcast by AQE"""
    li = load(spark, d, "lineitem").where("l_shipdate < timestamp_ntz'1998-09-02'").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    per = li.groupBy("l_orderkey").agg(F.sum("r").alias("r"))
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(load(spark, d, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    j = per.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("orders"), F.round(F.sum("r"), 2).alias("revenue"))


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS charge, round(avg(l_discount), 6) AS avg_disc, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL")
def pricing_summary(spark, d):
    """A3: aggregation without a join, map-side combined"""
    li = load(spark, d, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("double").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))), 2).alias("charge"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )


@query("SELECT tier, CAST(count(*) AS BIGINT) AS files, round(avg(before_ratio), 6) AS before_mean, round(avg(after_ratio), 6) AS after_mean, CAST(count(*) FILTER (nepali_word_hits_after >= 3) AS BIGINT) AS hits3, CAST(count(*) FILTER (nepali_word_hits_after = 0) AS BIGINT) AS hits0 FROM (SELECT DISTINCT cv_id, tier, before_ratio, after_ratio, nepali_word_hits_after FROM converter_validation) GROUP BY tier")
def converter_summary(spark, d):
    """A21, A22"""
    t = load(spark, d, "converter_validation").select("cv_id", "tier", "before_ratio", "after_ratio", "nepali_word_hits_after").distinct()
    return t.groupBy("tier").agg(F.count("*").alias("files"), F.round(F.avg("before_ratio"), 6).alias("before_mean"), F.round(F.avg("after_ratio"), 6).alias("after_mean"), F.count_if(F.col("nepali_word_hits_after") >= 3).alias("hits3"), F.count_if(F.col("nepali_word_hits_after") == 0).alias("hits0"))


@query("SELECT DISTINCT result_id, CASE WHEN qd + ql = 0 OR ad + al = 0 THEN false ELSE (qd >= ql) <> (ad >= al) END AS mismatch FROM (SELECT result_id, len(regexp_extract_all(question, '[ऀ-ॿ]')) AS qd, len(regexp_extract_all(question, '[A-Za-z]')) AS ql, len(regexp_extract_all(model_output, '[ऀ-ॿ]')) AS ad, len(regexp_extract_all(model_output, '[A-Za-z]')) AS al FROM smoke_results WHERE question IS NOT NULL AND model_output IS NOT NULL)")
def script_mismatch(spark, d):
    """L6"""
    t = load(spark, d, "smoke_results").where("question is not null and model_output is not null")
    return t.select("result_id", F.coalesce(script.script_mismatch(F.col("question"), F.col("model_output")), F.lit(False)).alias("mismatch")).distinct()


@query("SELECT category, CAST(sum(CASE kind WHEN 'grounded' THEN 10 WHEN 'refusal' THEN 2 ELSE 0 END) AS BIGINT) AS demand, CAST(count(*) AS BIGINT) AS n, round(1 + ln(1 + sum(CASE kind WHEN 'grounded' THEN 10 WHEN 'refusal' THEN 2 ELSE 0 END)) / 3, 6) AS damped FROM (SELECT DISTINCT result_id, coalesce(category, 'other') AS category, kind FROM smoke_results) GROUP BY category")
def demand_summary(spark, d):
    """A9, A10, M"""
    t = load(spark, d, "smoke_results").select("result_id", F.coalesce("category", F.lit("other")).alias("category"), "kind").distinct()
    s = F.sum(F.when(F.col("kind") == "grounded", 10).when(F.col("kind") == "refusal", 2).otherwise(0))
    return t.groupBy("category").agg(s.alias("demand"), F.count("*").alias("n"), F.round(1 + F.log1p(s) / 3, 6).alias("damped"))
