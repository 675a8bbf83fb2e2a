"""Ordered-sequence operators that survive a key holding a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_before(df: DataFrame, key: str, order: str, value: Column, when: Column, name: str, span: int = 4096) -> DataFrame:
    """Adds ``name``: ``value`` of the nearest earlier row (by ``order`` within ``key``) where ``when`` holds, else null.

    The order is cut into spans of ``span``; a window runs inside a span only, and what earlier spans hand on
    comes from one summary row per span. So a key that holds a third of all rows is spread over its spans,
    and the window over the summaries sees 1/``span`` of its rows. ``order`` must be an integer column.
    Rows with a null key or order get null. Ties in ``order`` don't see each other.
    """
    held = F.when(when, F.struct(F.col(order).alias("o"), value.alias("v")))
    d = df.withColumn("_span", F.floor(F.col(order) / F.lit(span))).withColumn("_held", held)
    inside = Window.partitionBy(key, "_span").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.max("_held").over(inside))
    ends = d.where("_held is not null").groupBy(key, "_span").agg(F.max("_held").alias("_end"))
    spans = d.select(key, "_span").distinct().join(ends, [key, "_span"], "left")
    across = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_past", F.max("_end").over(across)).select(key, "_span", "_past")
    out = d.join(spans, [key, "_span"], "left")
    return out.withColumn(name, F.coalesce("_in", "_past")["v"]).drop("_span", "_held", "_in", "_past")


def first_of_ties(df: DataFrame, key: str, order: str, tie: str) -> Column:
    """Whether a row is the first (by ``tie``) of those with its key and order; such groups are small by nature."""
    return F.col(tie) == F.min(tie).over(Window.partitionBy(key, order))


def gap_to_previous(df: DataFrame, key: str, order: str, tie: str, name: str = "gap", span: int = 86_400_000_000) -> DataFrame:
    """Adds the distance to the key's previous row by (order, tie): 0 between ties, null for the first row. Built on ``last_before``, so hot keys are spread."""
    d = last_before(df, key, order, F.col(order), F.lit(True), "_prev", span)
    return d.withColumn(name, F.when(~first_of_ties(df, key, order, tie), F.lit(0)).otherwise(F.col(order) - F.col("_prev"))).drop("_prev")


def rolling_count(df: DataFrame, key: str, order: str, row: str, width: int, name: str = "n", span: int = 3_600_000_000) -> DataFrame:
    """Adds the number of the key's rows within ``width`` up to and with each row (ties included).

    A difference of two running counts. Running counts come from windows inside one span of a key plus the
    sizes of earlier spans, so no task holds all rows of a key. ``row`` must be unique.
    """
    real = df.select(F.col(key).alias("_k"), F.col(order).alias("_o"), F.col(row).alias("_r"), F.lit(1).alias("_w"))
    probe = df.select(F.col(key).alias("_k"), (F.col(order) - width - 1).alias("_o"), F.col(row).alias("_r"), F.lit(0).alias("_w"))
    u = real.unionByName(probe).withColumn("_s", F.floor(F.col("_o") / F.lit(span)))
    inside = F.sum("_w").over(Window.partitionBy("_k", "_s").orderBy("_o").rangeBetween(Window.unboundedPreceding, 0))
    u = u.withColumn("_in", inside)
    sizes = u.groupBy("_k", "_s").agg(F.sum("_w").alias("_c"))
    past = F.coalesce(F.sum("_c").over(Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    u = u.join(sizes.withColumn("_past", past).select("_k", "_s", "_past"), ["_k", "_s"])
    total = F.col("_in") + F.col("_past")
    n = u.groupBy("_r").agg((F.max(F.when(F.col("_w") == 1, total)) - F.max(F.when(F.col("_w") == 0, total))).alias(name))
    return df.join(n, df[row] == n["_r"]).drop("_r")
