"""Records for training and evaluation: parsing, validation, assembly, budgets (DS1-DS19, N, L7, L19, R14-R23)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifterra.functions import text as T
from sifterra.functions.script import DEVANAGARI, devanagari_count, latin_count
from sifterra.operators.metrics import issue_list


def tolerant_json(raw: Column, schema: str) -> Column:
    """N: a JSON object inside other text: code fences off, the outermost braces, trailing commas out; null where it still can't be read."""
    body = F.regexp_extract(F.regexp_replace(raw, r"```(?:json)?", ""), r"(?s)(\{.*\})", 1)
    return F.from_json(F.nullif(F.regexp_replace(body, r",\s*([}\]])", "$1"), F.lit("")), schema)


def garbled_tokens(text: Column) -> Column:
    """Tokens with Devanagari and a foreign mark inside, brackets and punctuation at the ends apart."""
    inner = lambda w: F.regexp_replace(w, r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$", "")
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w.rlike(DEVANAGARI) & inner(w).rlike(r"[A-Za-z0-9{}|\[\]*+=<>^~@#$%&]"))


def without_garbled(text: Column) -> Column:
    """The text without those tokens, blanks narrowed."""
    bad = garbled_tokens(text)
    return F.trim(F.array_join(F.filter(F.split(text, r"(?U)\s+"), lambda w: ~F.array_contains(bad, w)), " "))


def pair_issues(question: Column, answer: Column, least: int = 20, most: int = 4000) -> Column:
    """L19, DS11: names of what is wrong with a synthetic pair."""
    share = lambda c: F.coalesce(F.try_divide(devanagari_count(c).cast("double"), devanagari_count(c) + latin_count(c)), F.lit(0.0))
    return issue_list([("short", F.length(F.trim(answer)) < least), ("long", F.length(answer) > most), ("script", F.abs(share(question) - share(answer)) > 0.6), ("refusal", T.is_refusal(answer)), ("loop", T.loops(answer)), ("missing", T.is_blank(answer))])


def messages(system: Column | None, question: Column, answer: Column) -> Column:
    """N, DS5: an array of role and content; empty parts are left out."""
    parts = ([("system", system)] if system is not None else []) + [("user", question), ("assistant", answer)]
    return F.array_compact(F.array(*[F.when(~T.is_blank(c), F.struct(F.lit(r).alias("role"), c.alias("content"))) for r, c in parts]))


def fit_budget(prompt: Column, answer: Column, limit: int) -> Column:
    """DS16: token ids of prompt and answer within ``limit``: the answer is kept, the prompt loses its left end; labels of the prompt are -100."""
    room = F.greatest(F.lit(limit) - F.size(answer), F.lit(0))
    kept = F.when(F.size(prompt) <= room, prompt).when(room == 0, F.slice(prompt, 1, 0)).otherwise(F.slice(prompt, F.size(prompt) - room + 1, F.greatest(room, F.lit(1))))
    tail = F.slice(answer, F.lit(1), F.lit(limit))
    return F.struct(F.concat(kept, tail).alias("input_ids"), F.concat(F.transform(kept, lambda _: F.lit(-100)), tail).alias("labels"))


def pad_right(ids: Column, width: Column, pad: int) -> Column:
    """DS17."""
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(width - F.size(ids), F.lit(0))))


def gates(metrics: dict[str, Column], rules: dict[str, tuple[str, float]]) -> list[Column]:
    """DS18: one boolean a rule, (at least | at most, bound)."""
    return [F.coalesce(metrics[k] >= bound if op == "min" else metrics[k] <= bound, F.lit(False)).alias(f"ok_{k}") for k, (op, bound) in rules.items()]


def scrub(text: Column, names: list[str], replacement: str) -> Column:
    """T-22: names, as whole words and in any case, replaced."""
    return F.regexp_replace(text, r"(?i)(?<![\p{L}\p{M}])(?:" + "|".join(map(re.escape, names)) + r")(?![\p{L}\p{M}])", replacement)


def quality_gate(claims: Column, results: Column, topic: Column, expected: Column, wants_place: Column, strict_topic: Column) -> Column:
    """Struct of ``outcome`` and ``passed`` for what a query found; the first of these that holds.

    ``claims``: number of claims found; ``results``: array of structs ``host, relevance`` in rank order; ``topic``: null where
    none was detected; ``expected``: hosts that should be among the first three (equal, or above at a dot); ``wants_place``: the query
    names a place; ``strict_topic``: a topic for which a local claim is enough.
    """
    none = F.coalesce(F.size(results), F.lit(0)) <= 0
    has_claims, named = F.coalesce(claims, F.lit(0)) > 0, topic.isNotNull()
    place = F.coalesce(wants_place, F.lit(False))
    fits = lambda h: F.exists(expected, lambda e: (h == e) | h.endswith(F.concat(F.lit("."), e)))
    top3 = F.exists(F.slice(results, 1, 3), lambda r: fits(r["host"]))
    first = F.try_element_at(results, F.lit(1))["relevance"]
    wanted = named & (F.coalesce(F.size(expected), F.lit(0)) > 0)
    outcome = (
        F.when(none & has_claims, "tacit_only")
        .when(none, "no_sources")
        .when(~named & place, "locality_without_service_topic")
        .when(has_claims & F.coalesce(strict_topic, F.lit(False)) & place, "local_tacit_topic_match")
        .when(wanted & F.coalesce(top3, F.lit(False)), "expected_domain_in_top3")
        .when(wanted, "topic_expected_domain_missing_top3")
        .when(first.isin("high", "medium"), F.concat(F.lit("top_gov_relevance_"), first))
        .otherwise("low_relevance")
    )
    passed = ~outcome.isin("no_sources", "locality_without_service_topic", "topic_expected_domain_missing_top3", "low_relevance")
    return F.struct(outcome.alias("outcome"), passed.alias("passed"))


def hit_metrics(ranks: DataFrame, by: list[str], rank: str) -> DataFrame:
    """Hits at 1, 3 and 5 from each query's first relevant rank (null: none)."""
    return ranks.groupBy(*by).agg(*[F.avg(F.when(F.col(rank) <= k, 1.0).otherwise(0.0)).alias(f"hit_{k}") for k in (1, 3, 5)], F.count("*").alias("queries"))


# Fixed values of the coverage score: weights by tier, points for what is missing, penalties and their limits.
TIER_WEIGHTS, OTHER_TIER = {1: 34, 2: 32, 3: 28, 4: 18, 5: 10}, 8
INACTIVE, UNKNOWN_DOCS, NO_DOCS, NO_CHUNKS, UNCHUNKED_MOST, UNCHUNKED_LOG, UNCHUNKED_SHARE = -70.0, 16.0, 42.0, 38.0, 34.0, 8.0, 18.0
FAILURE_POINTS, FAILURES_MOST, ERRORS_MOST, STOPPED_POINTS = 3, 12, 8, 10.0


def coverage_score(tier: Column, status: Column, docs: Column, chunks: Column, unchunked: Column, failures: Column, errors: Column, stopped: Column) -> Column:
    """R23, M: how much a source needs attention: weights by tier and state, logarithms of what is missing with caps."""
    c = lambda x: F.coalesce(x, F.lit(0))
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in TIER_WEIGHTS.items() for x in p]), tier.cast("int")), F.lit(OTHER_TIER))
    partly = F.least(F.lit(UNCHUNKED_MOST), F.log1p(c(unchunked)) * UNCHUNKED_LOG) + c(unchunked) / F.greatest(docs, F.lit(1)) * UNCHUNKED_SHARE
    some = F.when(c(chunks) == 0, NO_CHUNKS).otherwise(0.0) + F.when(c(unchunked) > 0, partly).otherwise(0.0)
    missing = F.when(docs.isNull(), UNKNOWN_DOCS).when(docs == 0, NO_DOCS).otherwise(some)
    trouble = F.least(F.lit(FAILURES_MOST), c(failures) * FAILURE_POINTS) + F.least(F.lit(ERRORS_MOST), c(errors)) + F.when(stopped, STOPPED_POINTS).otherwise(0.0)
    return F.round(weight + F.when(status.eqNullSafe("active"), 0.0).otherwise(INACTIVE) + missing + trouble, 2)


def repair_gate(text: Column, links: Column) -> Column:
    """a repaired recipe passes with 200 characters of text and one link."""
    return (F.length(F.coalesce(text, F.lit(""))) >= 200) & (F.coalesce(F.size(links), F.lit(0)) >= 1)
