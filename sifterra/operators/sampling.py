"""Deterministic sampling, splits, caps and quotas (K8-K19, W6, W9-W11, W19-W20). Orders come from a hash of seed and key, not from a random sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifterra.session import broadcast_if_small


def shuffled(key: str, seed: str = "s") -> Column:
    """K8: a seeded order that any engine can repeat."""
    return F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string")))


def _rank(df: DataFrame, by: list[str], order: list[Column], name: str = "_n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def lowest(df: DataFrame, order: str, n: int) -> DataFrame:
    """The n rows that come first by ``order`` (hexadecimal digits), for any n.

    Counts by the first four digits (65,536 at most) say which range the last row is in; only that range is
    sorted, so a large n never gathers rows in one task.
    """
    if n <= 0:
        return df.limit(0)
    d = df.withColumn("_p", F.substring(order, 1, 4))
    total, edge, before = 0, None, 0
    for r in sorted(d.groupBy("_p").count().collect(), key=lambda r: r[0] or ""):
        if total + r[1] > n:
            edge, before = r[0], total
            break
        total += r[1]
    if edge is None:
        return df
    inside = d.where(F.col("_p") == edge).orderBy(order).limit(n - before)
    return d.where(F.col("_p") < edge).unionByName(inside).drop("_p")


def group_rank(df: DataFrame, by: list[str], order: str, name: str = "_n", buckets: int = 64) -> DataFrame:
    """Exact rank from 1 within each group by ``order`` (hexadecimal digits, unique), without a task per group.

    Sizes of ``buckets`` ranges of each group give each range's start; a window ranks inside one range.
    """
    d = df.withColumn("_b", F.floor(F.conv(F.substring(order, 1, 4), 16, 10).cast("int") * buckets / 65536))
    sizes = d.groupBy(*by, "_b").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_c").over(w), F.lit(0))).select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_b").alias("_kb"), "_start")
    match = F.col("_b") == F.col("_kb")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    j = d.join(broadcast_if_small(starts), match)
    inner = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(order))
    return j.withColumn(name, F.col("_start") + inner).select(*df.columns, name)


def sample_n(df: DataFrame, key: str, n: int, seed: str = "s") -> DataFrame:
    """K9: n rows of the seeded order, each equally likely."""
    return lowest(df.withColumn("_o", shuffled(key, seed)), "_o", n).drop("_o")


def stratified_pick(df: DataFrame, strata: list[str], key: str, per: int, seed: str = "s") -> DataFrame:
    """Up to ``per`` rows of each stratum; ranks are pruned inside the map tasks."""
    return _rank(df, strata, [shuffled(key, seed), F.col(key)]).where(F.col("_n") <= per).drop("_n")


def round_robin(df: DataFrame, cells: list[str], key: str, n: int, seed: str = "s") -> DataFrame:
    """One row of each cell after another until n are there."""
    d = _rank(df, cells, [shuffled(key, seed), F.col(key)]).where(F.col("_n") <= n)
    return d.orderBy("_n", *cells, key).limit(n).drop("_n")


def stratified_split(df: DataFrame, strata: list[str], key: str, fraction: float, least: int = 0, rounding: str = "floor", seed: str = "s") -> DataFrame:
    """K12, K13, DS6: ``split`` is val for max(1, floor or round(n * fraction)) rows of each stratum with ``least`` rows or more.

    Ranks come from ``group_rank``, so a stratum with a third of all rows is spread over its ranges.
    """
    sizes = df.groupBy(*strata).agg(F.count("*").alias("_c"))
    n = F.floor(F.col("_c") * fraction) if rounding == "floor" else F.round(F.col("_c") * fraction)
    take = F.when(F.col("_c") < least, 0).otherwise(F.greatest(F.lit(1), n))
    d = group_rank(df.withColumn("_o", shuffled(key, seed)), strata, "_o")
    match = F.lit(True)
    for c in strata:
        match = match & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    j = d.join(broadcast_if_small(sizes.select(*[F.col(c).alias(f"_s_{c}") for c in strata], take.alias("_take"))), match)
    return j.withColumn("split", F.when(F.col("_n") <= F.col("_take"), "val").otherwise("train")).select(*df.columns, "split")


def cap_per_key(df: DataFrame, by: list[str], order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows of each key."""
    return _rank(df, by, order).where(F.col("_n") <= cap).drop("_n")


def cap_share(df: DataFrame, is_capped: Column, key: str, share: float, seed: str = "s") -> DataFrame:
    """Of the capped kind at most share / (1 - share) times the others are kept."""
    others = df.where(~is_capped).count()
    most = int(share * others / (1 - share) + 1e-9)
    kept = sample_n(df.where(is_capped), key, most, seed)
    return df.where(~is_capped).unionByName(kept)


def fill_to(df: DataFrame, fallback: DataFrame, key: str, dedup: str, target: int, seed: str = "s") -> DataFrame:
    """Rows of the fallback with new ``dedup`` values until ``target`` rows are there."""
    lack = max(0, target - df.count())
    fresh = fallback.join(df.select(dedup).distinct(), dedup, "left_anti")
    rest = [c for c in df.columns if c != dedup]
    fresh = fresh.groupBy(dedup).agg(F.min_by(F.struct(*rest), key).alias("_r")).select(*[F.col(c) if c == dedup else F.col(f"_r.{c}").alias(c) for c in df.columns])
    return df.unionByName(sample_n(fresh, key, lack, seed))


def token_budget(df: DataFrame, by: list[str], order: str, tokens: str, budget: int, buckets: int = 64) -> DataFrame:
    """Rows of a group in order until the budget is reached; the row that crosses it is kept.

    Running sums in two steps: totals of ``buckets`` hash-order ranges a group give each range's start, then
    a window runs inside one range only. ``order`` is a column of hexadecimal digits such as an MD5.
    """
    d = df.withColumn("_b", F.floor(F.conv(F.substring(order, 1, 4), 16, 10).cast("int") * buckets / 65536))
    totals = d.groupBy(*by, "_b").agg(F.sum(tokens).alias("_t"))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_start", F.coalesce(F.sum("_t").over(w), F.lit(0))).where(F.col("_start") < budget).drop("_t")
    j = d.join(broadcast_if_small(starts), [*by, "_b"])
    inner = Window.partitionBy(*by, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return j.withColumn("_before", F.col("_start") + F.coalesce(F.sum(tokens).over(inner), F.lit(0))).where(F.col("_before") < budget).select(*df.columns)


def repeat_mix(df: DataFrame, repeats: Column) -> DataFrame:
    """Each row ``repeats`` times with its copy number."""
    return df.withColumn("copy_no", F.explode(F.when(repeats > 0, F.sequence(F.lit(1), repeats)).otherwise(F.array().cast("array<int>"))))


def exclude_held_out(df: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't held out."""
    return df.join(held.select(*keys).distinct(), keys, "left_anti")
