"""Versions, upserts, source health and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Thresholds of the health verdict.
LEAST_CYCLES, DEAD_FAILURES, BLOCKED_RATE, STREAK, PRODUCTIVE_DOCS = 3, 20, 0.8, 5, 5


def live(docs: DataFrame) -> DataFrame:
    """neither superseded nor removed."""
    return docs.where("superseded_by IS NULL AND removed_at IS NULL")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def versions(docs: DataFrame, entity: list[str], order: list[Column], hash_: str) -> DataFrame:
    """Each version's successor and outcome (inserted, unchanged, superseded) against the one before."""
    w = Window.partitionBy(*entity).orderBy(*order)
    return docs.withColumn("prev_hash", F.lag(hash_).over(w)).withColumn("successor", F.lead("doc_id").over(w)).withColumn(
        "outcome", F.when(F.col("prev_hash").isNull(), "inserted").when(F.col("prev_hash") == F.col(hash_), "unchanged").otherwise("superseded")
    )


def upsert_documents(current: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, outcomes). At most one live version per (source_id, url); equal content only moves its fetch time; other content supersedes."""
    alive = live(current).select("source_id", "url", F.col("doc_id").alias("prev_id"), F.col("content_hash").alias("prev_hash"))
    new = latest_per_key(incoming, ["source_id", "url"], [F.desc("fetched_at"), F.asc("doc_id")])
    j = new.join(alive, ["source_id", "url"], "left")
    outcome = F.when(F.col("prev_id").isNull(), "inserted").when(F.col("prev_hash") == F.col("content_hash"), "unchanged").otherwise("superseded")
    outcomes = j.select("doc_id", "source_id", "url", "prev_id", outcome.alias("outcome"), F.col("fetched_at").alias("seen_at"))
    changes = outcomes.where("outcome <> 'inserted'").select(F.col("prev_id").alias("doc_id"), F.col("doc_id").alias("by"), "outcome", "seen_at")
    kept = current.join(changes, "doc_id", "left").withColumn("superseded_by", F.when(F.col("outcome") == "superseded", F.col("by")).otherwise(F.col("superseded_by")))
    kept = kept.withColumn("fetched_at", F.when(F.col("outcome") == "unchanged", F.col("seen_at")).otherwise(F.col("fetched_at"))).select(*current.columns)
    added = new.join(outcomes.where("outcome <> 'unchanged'").select("doc_id"), "doc_id", "left_semi")
    for c in current.columns:
        if c not in added.columns:
            added = added.withColumn(c, F.lit(None).cast(current.schema[c].dataType))
    return kept.unionByName(added.select(*current.columns)), outcomes.drop("seen_at")


def overlay(base: DataFrame, patch: DataFrame, keys: list[str], prefer: str = "patch", immutable: tuple[str, ...] = ()) -> DataFrame:
    """Full outer join; each column from the preferred side where it has a value, immutable ones from the base."""
    p = patch.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in patch.columns if c not in keys], F.lit(True).alias("_in_patch"))
    j = base.withColumn("_in_base", F.lit(True)).join(p, keys, "full_outer")
    out = []
    for c in [c for c in base.columns if c not in keys]:
        if c not in patch.columns:
            out.append(F.col(c))
        else:
            first = (F.col(c), F.col(f"_p_{c}")) if (prefer == "base" or c in immutable) else (F.col(f"_p_{c}"), F.col(c))
            out.append(F.coalesce(*first).alias(c))
    out += [F.col(f"_p_{c}").alias(c) for c in patch.columns if c not in keys and c not in base.columns]
    state = F.when(F.col("_in_base").isNull(), "inserted").when(F.col("_in_patch").isNull(), "kept").otherwise("updated")
    return j.select(*keys, *out, state.alias("upsert_state"))


def insert_new(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't there yet, once each."""
    fresh = incoming.dropDuplicates([key]).join(current.select(key), key, "left_anti")
    return current.unionByName(fresh)


def cycle_flags(cycles: DataFrame) -> DataFrame:
    """Adds success, non_productive and error_dominated to poll cycles."""
    touched = F.col("html_fetched") + F.col("binaries_fetched")
    return (
        cycles.withColumn("success", (F.col("errors") == 0) | (touched > 0))
        .withColumn("non_productive", (touched > 0) & (F.col("docs_inserted") == 0) & (F.col("docs_superseded") == 0))
        .withColumn("error_dominated", F.col("errors") > touched)
    )


def _rate(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def health_metrics(cycles: DataFrame) -> DataFrame:
    """Per source over the given window's cycles. The leading streak counts newest cycles back to the first productive one.

    The streak comes from one aggregate (the newest productive start) and a join, not from a window over a
    source's rows, so a source with a third of all cycles is no single task's group.
    """
    c = cycle_flags(cycles)
    changed = F.sum(F.col("docs_inserted") + F.col("docs_superseded"))
    base = c.groupBy("source_id").agg(
        F.count("*").alias("n_cycles"),
        F.count_if("success").alias("successes"),
        F.count_if("non_productive").alias("empty_extractions"),
        _rate(F.count_if("error_dominated"), F.count("*")).alias("error_rate"),
        _rate(changed, changed + F.sum("docs_unchanged")).alias("change_rate"),
        F.max(F.when(~F.col("non_productive"), F.struct("started_at", "cycle_id"))).alias("_break"),
        F.max_by("shell_flagged", F.struct("started_at", "cycle_id")).alias("last_shell"),
    )
    from sifterra.session import broadcast_if_small

    after = c.join(broadcast_if_small(base.select("source_id", "_break")), "source_id").where(F.col("_break").isNull() | (F.struct("started_at", "cycle_id") > F.col("_break")))
    streak = after.groupBy("source_id").agg(F.count("*").alias("streak"))
    return base.join(streak, "source_id", "left").withColumn("streak", F.coalesce("streak", F.lit(0).cast("bigint"))).drop("_break")


def failure_runs(cycles: DataFrame) -> DataFrame:
    """Consecutive failures at each source's newest cycle: failures after the newest success."""
    c = cycle_flags(cycles)
    last = c.groupBy("source_id").agg(F.max(F.when(F.col("success"), F.struct("started_at", "cycle_id"))).alias("_ok"))
    from sifterra.session import broadcast_if_small

    after = c.join(broadcast_if_small(last), "source_id").where(F.col("_ok").isNull() | (F.struct("started_at", "cycle_id") > F.col("_ok")))
    n = after.groupBy("source_id").agg(F.count("*").alias("failures"))
    return last.select("source_id").join(n, "source_id", "left").select("source_id", F.coalesce("failures", F.lit(0).cast("bigint")).alias("consecutive_failures"))


def verdict(status: Column, last_shell: Column, failures: Column, n_cycles: Column, error_rate: Column, streak: Column, docs_ever: Column) -> Column:
    """P5: first rule that holds."""
    return (
        F.when((status == "js_only") | F.coalesce(last_shell, F.lit(False)), "shell_detected")
        .when(failures >= DEAD_FAILURES, "dead")
        .when(n_cycles < LEAST_CYCLES, "insufficient_data")
        .when(error_rate >= BLOCKED_RATE, "dormant_blocked")
        .when((streak >= STREAK) & (docs_ever >= PRODUCTIVE_DOCS), "structurally_failed")
        .otherwise("healthy")
    )


def enqueue_once(candidates: DataFrame, queue: DataFrame, key: str) -> DataFrame:
    """Candidates without a pending entry."""
    return candidates.join(queue.where("status = 'pending'").select(key).distinct(), key, "left_anti")


def replay_patches(base: DataFrame, patches: DataFrame, key: str, field: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(base with the last value of the field for each patched key, audit trail as rows in order)."""
    last = patches.groupBy(key).agg(F.max_by(field, order).alias("_new"))
    trail = patches.select(key, order, F.col(field).alias("value"))
    return base.join(last, key, "left").withColumn(field, F.coalesce("_new", field)).drop("_new"), trail
