import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sifterra.session import bounded_sample, few_files, load, materialize, shared_folder
from sifterra.sources import readers, writers
from sifterra.streaming import jobs

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_jsonl_tolerant_and_strict(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "name": "x"}\n\n{"id": 2}\nnot json\n')
    df = readers.read_jsonl(spark, str(p), SCHEMA).cache()
    r = readers.scan_report(df, ["name"]).first()
    assert (r.lines, r.malformed, r.missing_key, r.good) == (3, 1, 1, 1)
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(p), SCHEMA, strict=True).collect()
    assert {r.manifest for r in readers.read_manifests(spark, str(tmp_path / "*.jsonl"), SCHEMA).collect()} == {"a"}


def test_zst_lists_and_binaries(spark, tmp_path):
    import zstandard

    lines = b'{"id": 1, "name": "x"}\nbad\n{"id": 2, "name": null}\n'
    (tmp_path / "a.zst").write_bytes(zstandard.ZstdCompressor().compress(lines))
    assert [(r.id, r.name) for r in readers.read_zst_jsonl(spark, str(tmp_path / "a.zst"), "id bigint, name string").orderBy("id").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "urls.txt").write_text("# head\n\nhttps://a.example\n  https://b.example \n")
    assert readers.read_url_list(spark, str(tmp_path / "urls.txt")).count() == 2
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4 abc")
    (tmp_path / "y.pdf").write_bytes(b"<html>")
    assert sorted(r.magic_ok for r in readers.read_binaries(spark, str(tmp_path), "pdf").collect()) == [False, True]


def test_defaults_and_migration(spark):
    df = spark.createDataFrame([(1, None), (2, 90)], "id bigint, depth int")
    assert [r.depth for r in readers.with_defaults(df, {"depth": 3}, {"depth": (1, 10)}).orderBy("id").collect()] == [3, 10]
    assert readers.migrate(df, SCHEMA).columns == ["id", "name"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    log = str(tmp_path / "log")
    assert writers.append_new(df, log, "id").count() == 2
    assert writers.append_new(df.unionByName(spark.createDataFrame([(3, "c")], df.schema)), log, "id").count() == 1
    assert spark.read.json(log).count() == 3
    m = writers.export_release({"t": df}, str(tmp_path / "release")).first()
    assert m["table"] == "t" and m["rows"] == 2 and m["checksum"]
    assert writers.content_addressed(df.withColumn("s", F.lit("s")), "s", "name", "txt").count() == 2
    writers.write_jsonl(df, str(tmp_path / "out"))
    lines = [x for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(json.loads(x)["id"] for x in lines) == [1, 2]


def test_shared_folder_is_the_sessions(spark):
    df = materialize(spark.range(3).toDF("id"))
    assert df.count() == 3 and shared_folder(spark)


@pytest.fixture()
def replay(spark, sf, tmp_path):
    folder = str(tmp_path / "events")
    load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 250).parquet(folder)
    batch = spark.read.parquet(folder)
    return folder, batch, str(tmp_path / "ckpt")


def collect(df, ckpt, mode="append"):
    rows = []
    jobs.run_available(df, lambda b, _: rows.extend(b.collect()), ckpt, mode)
    return rows


def test_streams_equal_the_batch(spark, replay):
    folder, batch, ckpt = replay
    stream = lambda: jobs.file_stream(spark, folder, batch.schema, 2)
    got = collect(jobs.tumbling_counts(stream(), "user_id", late="60 days"), ckpt + "1", "update")
    last = {}
    for r in got:
        last[r.window.start, r.user_id] = (r.n, r.errors)
    want = {(r.window.start, r.user_id): (r.n, r.errors) for r in batch.groupBy(F.window("ts", "1 day"), "user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")).collect()}
    assert last == want
    n = len(collect(jobs.dedup_ttl(stream(), ["user_id", "event_type"], ttl="100 days"), ckpt + "2"))
    assert n == batch.select("user_id", "event_type").distinct().count()
    got = {r.event_id: r.cooling for r in collect(jobs.cooldown(stream()), ckpt + "3")}
    assert len(got) == batch.count()
    got = {}
    for r in collect(jobs.failure_counter(stream()), ckpt + "4", "update"):
        got[r.user_id] = r.failures
    for user, n in got.items():
        kinds = [r.event_type for r in batch.where(F.col("user_id") == user).orderBy("ts", "event_id").collect()]
        run = 0
        for k in reversed(kinds):
            if k != "error":
                break
            run += 1
        assert n == run
        break


def test_index_maintenance_and_frontier(spark, tmp_path):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc")], "doc_id bigint, text string")
    each = jobs.maintain_index(spark, str(tmp_path / "index"))
    each(docs, 0)
    each(docs.unionByName(spark.createDataFrame([(3, "dd dd")], docs.schema)), 1)
    assert spark.read.parquet(str(tmp_path / "index")).groupBy("doc_id").count().count() == 3
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert [(r.url, r.depth) for r in jobs.crawl_frontier(links, seeds, 2, 10).collect()] == [("a", 0), ("b", 1), ("c", 2)]


def test_samples_are_bounded(spark, tmp_path):
    spark.range(1000).toDF("id").repartition(10).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    assert few_files(t).count() == 1000 and len(few_files(t, 3).inputFiles()) == 3 and 0 < few_files(t, 3).count() < 1000
    assert few_files(t.where("id > 5"), 3).count() == 994  # no plain table
    assert few_files(t.select("id"), 3).count() < 1000 and few_files(t.selectExpr("id + 1 as id2"), 3).count() == 1000
    assert len(bounded_sample(t, ["id"], 100)) == 100 and len(bounded_sample(t, ["id"], 5000)) == 1000
    assert sorted(bounded_sample(t.repartition(7), ["id"], 100)) == sorted(bounded_sample(t.coalesce(1), ["id"], 100))  # whatever the partitions
    assert bounded_sample(t, ["id"], 100) == bounded_sample(t, ["id"], 100) and bounded_sample(t.limit(0), ["id"], 5) == []


def test_written_tables_are_deleted(spark):
    from sifterra import session

    df = session.materialize(spark.range(5).toDF("id"))
    folder = session._own_folder(spark)
    session.clear_materialized(spark)
    with pytest.raises(Exception):
        df.collect()
    assert session.materialize(spark.range(5).toDF("id")).count() == 5 and session._own_folder(spark) == folder


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from sifterra import session

    def fake(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda x: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=sc)

    for master in ("spark://host:7077", "yarn", "k8s://https://host:443"):
        with pytest.raises(RuntimeError):
            session.shared_folder(fake(master))
    assert session.shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: "file:///shared/"))) == "file:///shared"


def test_spent_tables_are_released(spark):
    from sifterra import session

    df = session.materialize(spark.range(5).toDF("id"))
    assert session.path_exists(spark, df._sifterra_path)
    session.release(df)
    assert not session.path_exists(spark, df._sifterra_path)
    session.release(spark.range(3))  # nothing was written for it


def test_a_failed_read_is_no_empty_log(spark, tmp_path):
    from sifterra.sources import writers

    log = str(tmp_path / "log")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    assert writers.append_new(df, log, "id").count() == 2 and writers.append_new(df, log, "id").count() == 0
    index = tmp_path / "broken"
    index.mkdir()
    (index / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        jobs.maintain_index(spark, str(index))(spark.createDataFrame([(1, "aa bb")], "doc_id bigint, text string"), 0)
    assert sorted(x.name for x in index.iterdir()) == ["part-0.parquet"]


def _messages(spark, tmp_path, rows):
    folder = str(tmp_path / "messages")
    df = spark.createDataFrame(rows, "channel string, message_id string, s bigint").selectExpr("channel", "message_id", "timestamp_seconds(s) as ts")
    df.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 40).parquet(folder)
    return jobs.file_stream(spark, folder, df.schema, 1)


def test_recent_messages_by_channel_against_brute_force(spark, tmp_path):
    import random

    rng = random.Random(5)
    rows, t = [], 1_700_000_000
    for _ in range(300):
        t += rng.choice([1, 30, 4000])
        rows.append((rng.choice("ab"), f"m{rng.randrange(12)}", t))
    got = collect(jobs.dedup_recent(_messages(spark, tmp_path, rows), most=5, ttl=20_000, late="1 second"), str(tmp_path / "c"))
    want, known = [], {"a": {}, "b": {}}
    for c, m, at in rows:
        k = known[c]
        dup = m in k and at - k[m] < 20_000
        want.append((c, m, dup))
        if not dup:
            k.pop(m, None)
            k[m] = at
            while len(k) > 5:
                del k[next(iter(k))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_tick_judges_and_queues_once(spark):
    schema = "cycle_id bigint, source_id string, started_at timestamp, html_fetched int, binaries_fetched int, docs_inserted int, docs_superseded int, docs_unchanged int, errors int, shell_flagged boolean"
    at = lambda i: dt.datetime(2024, 1, 1 + i)
    old = [(i, "good", at(i), 5, 0, 2, 0, 3, 0, False) for i in range(4)] + [(10 + i, "shell", at(i), 5, 0, 1, 0, 0, 0, i == 3) for i in range(4)]
    new = [(20 + i, "stuck", at(i), 4, 0, 6 if i == 0 else 0, 0, 4, 0, False) for i in range(7)] + [old[0]]
    status = spark.createDataFrame([("good", "active"), ("shell", "active"), ("stuck", "active")], "source_id string, status string")
    queue = spark.createDataFrame([("shell", "pending", at(0))], "source_id string, status string, queued_at timestamp")
    out = jobs.tick(lambda: spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), status, queue, 1)
    assert out["cycles"].count() == 15
    assert {r.source_id: r.verdict for r in out["verdicts"].collect()} == {"good": "healthy", "shell": "shell_detected", "stuck": "structurally_failed"}
    assert sorted(r.source_id for r in out["queue"].collect()) == ["shell", "stuck"] and [r.source_id for r in out["repairs"].collect()] == ["shell"]
