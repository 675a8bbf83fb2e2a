"""Row filters and rule chains (F4-F26, K3-K7, T-33, L9, L14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifterra.session import broadcast_if_small


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, in order; null where none does. A null condition doesn't hold."""
    out = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    """F8: rows by reason, kept ones as 'kept'. Kept and dropped add up to the input."""
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))


def in_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a list of any length; a broadcast semi-join while it is small."""
    return df.join(broadcast_if_small(keys.select(on).distinct()), on, "left_semi")


def with_fields(df: DataFrame, required: list[str], skip: str | None = None) -> DataFrame:
    """rows that aren't marked to be skipped and have every required text."""
    cond = F.lit(True) if skip is None else ~F.coalesce(F.col(skip), F.lit(False))
    for c in required:
        cond = cond & (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    return df.where(cond)


def by_class(klass: Column, always: list[str], conditional: dict[str, Column]) -> Column:
    """Classes that always pass, and others under a condition."""
    out = klass.isin(always)
    for name, cond in conditional.items():
        out = out | ((klass == name) & F.coalesce(cond, F.lit(False)))
    return F.coalesce(out, F.lit(False))


def depth_ok(kind: Column, depth: Column, document_cap: int, page_cap: int) -> Column:
    """hops by class."""
    return depth <= F.when(kind == "document", document_cap).otherwise(page_cap)


def children_all(parents: DataFrame, children: DataFrame, key: str, good: Column) -> DataFrame:
    """parents with at least one child, all of them good."""
    ok = children.groupBy(key).agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("_ok")).where("_ok").select(key)
    return parents.join(ok, key, "left_semi")


def priority(rules: list[Column]) -> Column:
    """K3, K5: the number of the first rule that holds; len(rules) where none does. Sort by it first."""
    out = F.lit(len(rules))
    for i, cond in reversed(list(enumerate(rules))):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(i)).otherwise(out)
    return out


def queue_head(queue: DataFrame, by: list[str], n: int = 1) -> DataFrame:
    """K7: the oldest pending entries, ties by the given columns."""
    return queue.where("status = 'pending'").orderBy("queued_at", *by).limit(n)


def dictionary_hits(words: Column, dictionary: list[str]) -> Column:
    """How many of the words are in a dictionary."""
    return F.size(F.filter(words, lambda w: w.isin(dictionary)))


def canonical_query(text: Column, rules: list[tuple[str, str]], fallback: Column) -> Column:
    """T-33: the label of the first pattern that matches, else the fallback."""
    out = fallback
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def registrable_domain(hosts: DataFrame, host: str, suffixes: DataFrame, suffix: str) -> DataFrame:
    """Adds ``domain``: one label before the longest public suffix; null where the host is a suffix itself or has none. An equi-join on the host's suffixes."""
    h = hosts.select(host).where(F.col(host).isNotNull()).distinct()
    parts = F.split(F.lower(F.col(host)), r"\.")
    each = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("at"), F.array_join(F.slice(parts, i, F.size(parts)), ".").alias("s")))
    x = h.select(host, parts.alias("_p"), F.explode(each).alias("e")).select(host, "_p", "e.at", F.col("e.s").alias("_s"))
    s = broadcast_if_small(suffixes.select(F.lower(F.col(suffix)).alias("_s")).distinct())
    found = x.join(s, "_s").groupBy(host).agg(F.min("at").alias("at"), F.first("_p").alias("_p"))
    named = found.where("at > 1").select(host, F.array_join(F.slice("_p", F.col("at") - 1, F.size("_p")), ".").alias("domain"))
    return hosts.join(named, host, "left")


def shuffle_holdout(df: DataFrame, key: str, least: int = 100, share: float = 0.05, seed: str = "s") -> DataFrame:
    """``split``: max(least, share of the rows) in seeded order are held out; no global sort."""
    from sifterra.operators.sampling import lowest, shuffled

    d = df.withColumn("_o", shuffled(key, seed))
    held = lowest(d, "_o", max(least, int(df.count() * share))).select(key, F.lit("holdout").alias("_h"))
    return df.join(held, key, "left").withColumn("split", F.coalesce("_h", F.lit("train"))).drop("_h")


def transition(status: Column, event: Column, table: list[tuple[str, str, str]]) -> Column:
    """The next state from a transition table (state, event, next); states without an entry stay, so terminal states ignore events."""
    out = status
    for a, e, b in reversed(table):
        out = F.when((status == a) & (event == e), F.lit(b)).otherwise(out)
    return out


def frequency_tables(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts of several columns in one pass: ``column_name, value, n``."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("x")).groupBy("x.column_name", "x.value").agg(F.count("*").alias("n"))


def dense_rank_by(df: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """W8."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
