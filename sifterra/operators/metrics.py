"""Similarity and evaluation metrics."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType
from pyspark.sql.window import Window


def _chrf(hyp: str, ref: str, longest: int = 6, beta: float = 2.0) -> float:
    if not hyp or not ref:
        return 0.0
    ps, rs = [], []
    for n in range(1, longest + 1):
        if len(hyp) < n or len(ref) < n:
            continue
        want: dict[str, int] = {}
        for i in range(len(ref) - n + 1):
            g = ref[i : i + n]
            want[g] = want.get(g, 0) + 1
        hit = 0
        for i in range(len(hyp) - n + 1):
            left = want.get(hyp[i : i + n], 0)
            if left:
                want[hyp[i : i + n]] = left - 1
                hit += 1
        ps.append(hit / (len(hyp) - n + 1))
        rs.append(hit / (len(ref) - n + 1))
    if not ps:
        return 0.0
    p, r = sum(ps) / len(ps), sum(rs) / len(rs)
    return 100.0 * (1 + beta**2) * p * r / (beta**2 * p + r) if p + r else 0.0


@F.pandas_udf(DoubleType())
def chrf(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """Character n-grams of 1 to 6 with white space, beta 2, averaged over the orders that both sides have, times 100."""
    return pd.Series([_chrf(h or "", r or "") for h, r in zip(hyp, ref)])


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel: one pass over ``b`` with whole-number operations of ``len(a)`` bits."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit) | (row - hit)
    return len(a) - (row & full).bit_count()


def _rouge_l(a: list[str], b: list[str]) -> float:
    if not a or not b:
        return 0.0
    n = lcs_length(a, b)
    p, r = n / len(a), n / len(b)
    return 2 * p * r / (p + r) if p + r else 0.0


@F.pandas_udf(DoubleType())
def rouge_l(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """F1 of the longest common subsequence of blank-separated tokens."""
    return pd.Series([_rouge_l((h or "").split(), (r or "").split()) for h, r in zip(hyp, ref)])


def recall(found: Column, gold: Column) -> Column:
    """Share of distinct gold entries found; null without gold."""
    g = F.array_distinct(gold)
    return F.when(F.size(g) > 0, F.size(F.array_intersect(g, found)) / F.size(g))


def jaccard(a: Column, b: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)))


def upper_median(df: DataFrame, key: str, value: str, buckets: int = 4096, name: str = "median") -> DataFrame:
    """``key, median``: element n // 2 of each key's sorted values (the upper of two middle ones); keys without a value are left out.

    Exact for groups of any size, and for any ties and outliers: equal values are one row with their count, made before
    the shuffle. Counts in ``buckets`` ranges of a group's values say which range holds the element; that range is
    cut again until it holds few different values or one, and only those are sorted.
    """
    from sifterra.session import broadcast_if_small, materialize

    d = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(key, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    d = materialize(d, "values")
    at = materialize(d.groupBy(key).agg(F.floor(F.sum("_n") / 2).alias("_at")), "median_place")
    inside, before = d, at.select(key, F.lit(0).cast("bigint").alias("_before"))
    while True:
        ends = inside.groupBy(key).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_kinds"))
        ends = materialize(ends.join(at, key).join(before, key), "ranges")
        if not ends.where((F.col("_kinds") > buckets) & (F.col("_hi") > F.col("_lo"))).limit(1).count():
            break
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * buckets), F.lit(buckets - 1))).otherwise(0)
        placed = inside.join(broadcast_if_small(ends), key).withColumn("_b", place)
        sizes = placed.groupBy(key, "_b", "_at", "_before").agg(F.sum("_n").alias("_c"))
        w = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        reach = F.col("_before") + F.coalesce(F.sum("_c").over(w), F.lit(0))
        found = sizes.withColumn("_reach", reach).where((F.col("_reach") <= F.col("_at")) & (F.col("_at") < F.col("_reach") + F.col("_c")))
        found = materialize(found.select(key, "_b", F.col("_reach").alias("_from")), "range")
        inside = materialize(placed.join(broadcast_if_small(found), [key, "_b"]).select(key, "_v", "_n"), "values")
        before = found.select(key, F.col("_from").alias("_before"))
    last = inside.join(broadcast_if_small(ends.select(key, "_at", "_before")), key)
    w = Window.partitionBy(key).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = last.withColumn("_reach", F.col("_before") + F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return ranked.where((F.col("_reach") <= F.col("_at")) & (F.col("_at") < F.col("_reach") + F.col("_n"))).select(key, F.col("_v").alias(name))


def win_rate(df: DataFrame, by: list[str], result: str) -> DataFrame:
    """(wins + half the ties) over valid results."""
    valid = F.count_if(F.col(result).isin("win", "tie", "loss"))
    return df.groupBy(*by).agg(valid.alias("valid"), F.try_divide(F.count_if(F.col(result) == "win") + 0.5 * F.count_if(F.col(result) == "tie"), valid).alias("win_rate"))


def issue_list(checks: list[tuple[str, Column]]) -> Column:
    """R16, E8, N: names of the checks that fail, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in checks]))


_MARKS = re.compile(r"([^\w\s])")


def score_tokens(text: str | None) -> list[str]:
    """Blank-separated tokens, marks apart."""
    return _MARKS.sub(r" \1 ", text or "").split()


def _grams(items, n: int) -> Counter:
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def _overlaps(hyp, ref, longest: int) -> list[int]:
    """For each n: n-grams in both (clipped), in the hypothesis, in the reference."""
    out = []
    for n in range(1, longest + 1):
        h, r = _grams(hyp, n), _grams(ref, n)
        out += [sum((h & r).values()), sum(h.values()), sum(r.values())]
    return out


@F.pandas_udf(ArrayType(LongType()))
def score_counts(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """One row's counts for the corpus scores: word n-grams of 1 to 4 (three counts each), lengths in words, character n-grams of 1 to 6 without blanks."""

    def one(h, r):
        a, b = score_tokens(h), score_tokens(r)
        return [*_overlaps(a, b, 4), len(a), len(b), *_overlaps("".join((h or "").split()), "".join((r or "").split()), 6)]

    return pd.Series([one(h, r) for h, r in zip(hyp, ref)])


def corpus_scores(df: DataFrame, by: list[str], hyp: Column, ref: Column, beta: float = 2.0) -> DataFrame:
    """``bleu`` (1 to 4 words, brevity penalty, no smoothing) and ``chrf_pp`` (characters of 1 to 6 and words of 1 and 2, averaged F) of whole groups.

    Each row's counts are one Arrow pass; groups only add them up, before and after the shuffle.
    """
    width = 32
    d = df.select(*by, score_counts(hyp, ref).alias("c"))
    g = d.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(F.col("c")[i]).alias(f"_{i}") for i in range(width)])
    c = lambda i: F.col(f"_{i}").cast("double")
    precision = [F.try_divide(c(3 * n), c(3 * n + 1)) for n in range(4)]
    penalty = F.when(c(12) >= c(13), 1.0).otherwise(F.exp(1 - F.try_divide(c(13), c(12))))
    hit = c(0) * c(3) * c(6) * c(9) > 0
    bleu = F.when(hit, 100 * penalty * F.exp(sum((F.log(F.when(hit, p)) for p in precision), F.lit(0.0)) / 4)).otherwise(0.0)

    def f(at):
        p, r = F.try_divide(c(at), c(at + 1)), F.try_divide(c(at), c(at + 2))
        return F.coalesce(F.try_divide((1 + beta**2) * p * r, beta**2 * p + r), F.lit(0.0)), (c(at + 1) > 0) & (c(at + 2) > 0)

    parts = [f(14 + 3 * n) for n in range(6)] + [f(0), f(3)]
    orders = sum((F.when(ok, 1.0).otherwise(0.0) for _, ok in parts), F.lit(0.0))
    chrf_pp = F.coalesce(F.try_divide(100 * sum((F.when(ok, x).otherwise(0.0) for x, ok in parts), F.lit(0.0)), orders), F.lit(0.0))
    return g.select(*by, "n", bleu.alias("bleu"), chrf_pp.alias("chrf_pp"))
