"""Structured Streaming forms of the stateful behaviours (ST1-ST11)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sifterra.session import materialize, path_exists


def file_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_available(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """ST1: a tick handles what has arrived and ends; the checkpoint makes the next tick go on from there."""
    q = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def dedup_ttl(df: DataFrame, keys: list[str], ts: str = "ts", ttl: str = "24 hours") -> DataFrame:
    """ST2: the first message of a key within the watermark; older state is dropped."""
    return df.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(df: DataFrame, key: str, ts: str = "ts", width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Cycle counts by tumbling window; late rows beyond the watermark are left out."""
    return df.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))


def sliding_health(df: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """ST6: seven days, every day."""
    return df.withWatermark(ts, "1 day").groupBy(F.window(ts, "7 days", "1 day"), key).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))


def sessions(df: DataFrame, key: str, ts: str = "ts", gap: str = "30 minutes") -> DataFrame:
    return df.withWatermark(ts, "1 hour").groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))


def _cooldown(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    last = state.get[0] if state.exists else None
    rows = []
    frame = pd.concat(list(batches)).sort_values(["us", "event_id"])
    for us, event in zip(frame["us"], frame["event_id"]):
        cooling = last is not None and us - last < COOLDOWN_US
        last = us
        rows.append((key[0], event, cooling))
    state.update((int(last),))
    state.setTimeoutTimestamp(max(int(last + COOLDOWN_US) // 1000, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(rows, columns=["user_id", "event_id", "cooling"])


COOLDOWN_US = 300_000_000


def cooldown(df: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """ST4: per key, whether the previous event is less than five minutes back; the state is one time per key, which goes once the watermark has passed those minutes."""
    d = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).withColumn("us", F.unix_micros(ts))
    return d.groupBy("user_id").applyInPandasWithState(_cooldown, "user_id bigint, event_id bigint, cooling boolean", "last bigint", "append", "EventTimeTimeout")


def _streak(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    n = state.get[0] if state.exists else 0
    frame = pd.concat(list(batches)).sort_values(["us", "event_id"])
    for kind in frame["event_type"]:
        n = n + 1 if kind == "error" else 0
    if n:
        state.update((int(n),))
        state.setTimeoutTimestamp(max(int(frame["us"].iloc[-1]) // 1000 + STREAK_MS, state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()  # no failures: nothing to remember
    yield pd.DataFrame([(key[0], n, n >= 20)], columns=["user_id", "failures", "dead"])


STREAK_MS = 90 * 86_400_000


def failure_counter(df: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """ST7: consecutive failures of each key so far, dead at 20. Keys without failures have no state, and keys silent for 90 days lose theirs."""
    d = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).withColumn("us", F.unix_micros(ts))
    return d.groupBy("user_id").applyInPandasWithState(_streak, "user_id bigint, failures bigint, dead boolean", "failures bigint", "update", "EventTimeTimeout")


def _recent(most: int, ttl_us: int):
    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = dict(zip(*state.get)) if state.exists else {}
        if state.hasTimedOut:
            state.remove()
            return
        rows = []
        for us, message in pd.concat(list(batches)).sort_values(["us", "message_id"])[["us", "message_id"]].itertuples(index=False):
            seen = known.get(message)
            rows.append((key[0], message, seen is not None and us - seen < ttl_us))
            if not rows[-1][2]:
                known.pop(message, None)
                known[message] = int(us)
                while len(known) > most:  # the oldest goes
                    del known[next(iter(known))]
        newest = max(known.values())
        known = {m: t for m, t in known.items() if newest - t < ttl_us}
        state.update((list(known), list(known.values())))
        state.setTimeoutTimestamp(max((newest + ttl_us) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=["channel", "message_id", "duplicate"])

    return run


def dedup_recent(df: DataFrame, ts: str = "ts", most: int = 1000, ttl: int = 86_400, late: str = "1 hour") -> DataFrame:
    """ST2: whether a channel has had a message within ``ttl`` seconds among its last ``most`` different ones: ``channel, message_id, duplicate``.

    The cap is the feature: a channel remembers that many messages, and forgets all once the watermark has passed the last one's time.
    """
    d = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).withColumn("us", F.unix_micros(ts))
    return d.groupBy("channel").applyInPandasWithState(_recent(most, ttl * 1_000_000), "channel string, message_id string, duplicate boolean", "messages array<string>, times array<bigint>", "append", "EventTimeTimeout")


def tick(poll: Callable[[], DataFrame], cycles: DataFrame, status: DataFrame, queue: DataFrame, most_repairs: int) -> dict[str, DataFrame]:
    """ST1: one turn of a daemon: new cycles are taken in, each source's health is judged over all of them, failed ones are queued once, and the oldest ``most_repairs`` pending repairs are handed out.

    ``status`` holds ``source_id, status``; ``queue`` holds ``source_id, status, queued_at``. Gives ``cycles``, ``verdicts``, ``queue`` and ``repairs``.
    """
    from sifterra.operators import lifecycle
    from sifterra.operators.filters import queue_head

    cycles = cycles.unionByName(poll()).dropDuplicates(["cycle_id"])
    health = lifecycle.health_metrics(cycles).join(lifecycle.failure_runs(cycles), "source_id").join(cycles.groupBy("source_id").agg(F.sum("docs_inserted").alias("docs_ever")), "source_id").join(status, "source_id", "left")
    c = F.col
    verdicts = materialize(health.select("source_id", lifecycle.verdict(c("status"), c("last_shell"), c("consecutive_failures"), c("n_cycles"), c("error_rate"), c("streak"), c("docs_ever")).alias("verdict")), "verdicts")
    bad = verdicts.where(c("verdict").isin("shell_detected", "structurally_failed", "dormant_blocked"))
    added = lifecycle.enqueue_once(bad.select("source_id"), queue, "source_id").select("source_id", F.lit("pending").alias("status"), F.current_timestamp().alias("queued_at"))
    queue = materialize(queue.select("source_id", "status", "queued_at").unionByName(added), "queue")
    return {"cycles": cycles, "verdicts": verdicts, "queue": queue, "repairs": queue_head(queue, ["source_id"], most_repairs)}


def maintain_index(spark: SparkSession, folder: str) -> Callable[[DataFrame, int], None]:
    """ST9: a batch handler that appends postings of documents the index doesn't hold yet."""
    from sifterra.operators.search import build_postings

    def each(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(["doc_id"])
        if path_exists(spark, folder):  # not the first batch; a failed read fails the batch, which is then run again
            fresh = fresh.join(spark.read.parquet(folder).select("doc_id").distinct(), "doc_id", "left_anti")
        build_postings(fresh).write.mode("append").parquet(folder)

    return each


def crawl_frontier(links: DataFrame, seeds: DataFrame, most_depth: int, budget: int) -> DataFrame:
    """ST11: breadth-first visits over a static link graph (src, dst) within a depth and a number of pages, each page once at its least depth.

    A bounded loop over DataFrames: one join a hop, what has been seen is kept in the shared folder.
    """
    seen = materialize(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "frontier")
    edge = seen
    for depth in range(1, most_depth + 1):
        step = edge.join(links, edge["url"] == links["src"]).select(F.col("dst").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        edge = materialize(step.withColumn("depth", F.lit(depth)), "frontier")
        found = edge.limit(1).count()
        seen = seen.unionByName(edge)
        if not found or seen.count() >= budget:
            break
    return seen.orderBy("depth", "url").limit(budget)
