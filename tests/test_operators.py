import random

import pytest
from pyspark.sql import functions as F

from sifterra.operators import chunking, lifecycle, metrics, sampling, search, sequences


def python_chunks(text, target=1800, overlap=180, least=200, snap=120):
    """Brute force of the forward-snapping chunker."""
    n, out, start = len(text), [], 0
    if n == 0:
        return []
    if n < least:
        return [(0, n)]
    while True:
        want = min(start + target, n)
        end = want
        for i in range(want, min(want + snap, n)):
            c = text[i]
            if c in "।?!" or (c == "." and i + 1 < n and text[i + 1].isspace()):
                end = i + 1
                break
            if c == "\n" and text[i + 1 : i + 2] == "\n":
                end = i + 2
                break
        out.append((start, end))
        if end >= n:
            return out
        start += target - overlap
        if start >= end:
            start = end


@pytest.mark.parametrize("seed", range(3))
def test_chunks_against_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abc de. \n।?!क") if rng.random() < 0.3 else "x" for _ in range(rng.choice([0, 1, 150, 199, 200, 1799, 1800, 1801, 1920, 3400, 9000]))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id bigint, text string").selectExpr("*", "1 as chunk_index", "'x' as _x")
    got = {}
    for r in chunking.chunk_documents(df).collect():
        assert r.text == texts[r.doc_id][r.char_start : r.char_end]
        got.setdefault(r.doc_id, []).append((r.char_start, r.char_end))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == python_chunks(t), (i, len(t))


def test_backward_chunks_cover_the_text():
    text = "Some words here. " * 200
    spans = [(a, b) for a, b, _ in chunking.backward_chunks(text)]
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b2 > b1 and a2 <= b1 for (_, b1), (a2, b2) in zip(spans, spans[1:]))


def test_last_before_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, o, rng.random() < 0.2) for k in ("hot", "b") for o in rng.sample(range(60_000), 300)] + [("c", 5, False), ("c", None, True), (None, 3, True)]
    out = sequences.last_before(spark.createDataFrame(rows, "k string, o int, u boolean"), "k", "o", F.col("o"), F.col("u"), "p").collect()
    for r in out:
        if r.k is not None and r.o is not None:
            assert r.p == max((o for k, o, u in rows if k == r.k and u and o is not None and o < r.o), default=None)


def test_token_budget_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), rng.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, s string, n bigint").withColumn("o", sampling.shuffled("doc_id"))
    got = {r.doc_id for r in sampling.token_budget(df, ["s"], "o", "n", 700).collect()}
    want = set()
    for s in "ab":
        total = 0
        for r in sorted((r for r in df.collect() if r.s == s), key=lambda r: r.o):
            if total < 700:
                want.add(r.doc_id)
            total += r.n
    assert got == want


def test_splits_and_caps(spark):
    df = spark.createDataFrame([(i, "a" if i < 100 else "b" if i < 105 else None) for i in range(110)], "doc_id bigint, s string")
    n = {(r.s, r.split): r["count"] for r in sampling.stratified_split(df, ["s"], "doc_id", 0.1).groupBy("s", "split").count().collect()}
    assert n["a", "val"] == 10 and n["b", "val"] == 1 and n[None, "val"] == 1 and sum(n.values()) == 110
    assert sampling.stratified_split(df, ["s"], "doc_id", 0.1, 12).where("split = 'val'").count() == 10
    assert sampling.cap_share(df, F.col("s").eqNullSafe("b"), "doc_id", 0.02).where("s = 'b'").count() == 2
    filled = sampling.fill_to(df.where("s = 'b'"), df.withColumn("doc_id", F.col("doc_id") + 1000), "doc_id", "doc_id", 20)
    assert filled.count() == 20
    assert sampling.repeat_mix(df.limit(3), F.lit(3)).count() == 9 and sampling.repeat_mix(df.limit(3), F.lit(0)).count() == 0


def test_bm25_against_brute_force(spark):
    import math

    rng = random.Random(3)
    words = ["aa", "bb", "cc", "dd", "ee"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 20)))) for i in range(40)] + [(98, ""), (99, None)]
    q = spark.createDataFrame([(1, "aa bb aa"), (2, "zz"), (3, None)], "q bigint, t string")
    got = {(r.q, r.doc_id): r.score for r in search.bm25(spark.createDataFrame(docs, "doc_id bigint, text string"), q, "q", "t").collect()}
    toks = {i: t.split() for i, t in docs if t is not None}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    for i, t in toks.items():
        want = 0.0
        for w in ("aa", "bb", "aa"):
            df = sum(w in x for x in toks.values())
            if w in t:
                want += max(0.0, math.log((n - df + 0.5) / (df + 0.5) + 1)) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg))
        assert got.get((1, i), 0.0) == pytest.approx(want)
    assert {k[0] for k in got} == {1}


def test_metrics():
    assert metrics._chrf("abc", "abc") == pytest.approx(100) and metrics._chrf("", "a") == 0 and 0 < metrics._chrf("abcd", "abxd") < 100
    assert metrics._rouge_l("a b c d".split(), "a c d".split()) == pytest.approx(2 * 0.75 / 1.75) and metrics._rouge_l([], ["a"]) == 0


def test_upsert(spark):
    s = "doc_id string, source_id string, url string, content_hash string, fetched_at string, superseded_by string, removed_at timestamp"
    cur = spark.createDataFrame([("1", "s", "u", "h", "t1", None, None), ("2", "s", "v", "h", "t1", None, None)], s)
    inc = spark.createDataFrame([("3", "s", "u", "h2", "t2", None, None), ("4", "s", "v", "h", "t2", None, None), ("5", "s", "w", "h", "t2", None, None), ("5", "s", "w", "h", "t2", None, None)], s)
    new, out = lifecycle.upsert_documents(cur, inc)
    assert {r.doc_id: r.outcome for r in out.collect()} == {"3": "superseded", "4": "unchanged", "5": "inserted"}
    rows = {r.doc_id: r for r in new.collect()}
    assert rows["1"].superseded_by == "3" and rows["2"].fetched_at == "t2" and set(rows) == {"1", "2", "3", "5"} and new.count() == 4
    again, out2 = lifecycle.upsert_documents(new, inc)
    assert {r.outcome for r in out2.collect()} == {"unchanged"} and again.count() == 4


CYCLES = "cycle_id bigint, source_id string, started_at timestamp, html_fetched int, binaries_fetched int, errors int, docs_inserted int, docs_superseded int, docs_unchanged int, shell_flagged boolean"


def test_health(spark):
    import datetime as dt

    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    rows = [(i, "idle", day(i), 3, 0, 0, 1 if i < 2 else 0, 0, 3, False) for i in range(8)] + [(20 + i, "err", day(i), 0, 0, 4, 0, 0, 0, False) for i in range(4)] + [(40, "shell", day(0), 1, 0, 0, 1, 0, 0, True)]
    c = spark.createDataFrame(rows, CYCLES)
    m = {r.source_id: r for r in lifecycle.health_metrics(c).collect()}
    assert m["idle"].streak == 6 and m["err"].error_rate == 1.0 and m["err"].streak == 0 and m["shell"].last_shell
    f = {r.source_id: r.consecutive_failures for r in lifecycle.failure_runs(c).collect()}
    assert f == {"idle": 0, "err": 4, "shell": 0}
    assert lifecycle.health_metrics(c.limit(0)).count() == 0


def test_fusion_and_rules(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "q bigint, d bigint, rank int")
    b = spark.createDataFrame([(1, 11, 1)], "q bigint, d bigint, rank int")
    got = {r.d: r.score for r in search.reciprocal_rank_fusion([a, b], "q", "d").collect()}
    assert got[11] == pytest.approx(1 / 61 + 1 / 62) and got[10] == pytest.approx(1 / 61)
    rules = spark.createDataFrame([("x", "fee", 1.0, 2), ("y", "desk", 1.0, 1)], "topic string, keyword string, weight double, rule_order int")
    t = spark.createDataFrame([(1, "Fee at the desk"), (2, None), (3, "none")], "id bigint, t string")
    assert [(r.id, r.topic) for r in search.apply_rules(t, rules, F.col("t"), "id").collect()] == [(1, "y")]


def test_medians_with_ties_and_outliers(spark):
    import random

    rng = random.Random(3)
    values = {"ties": [1.0] * 500 + [2.0] * 400, "outlier": [rng.random() for _ in range(600)] + [1e300, -1e300], "one": [7.0], "clumps": [round(rng.gauss(0, 1), 1) * 10 ** rng.randrange(-6, 6) for _ in range(700)]}
    rows = [(k, v) for k, vs in values.items() for v in vs]
    got = {r.k: r.median for r in metrics.upper_median(spark.createDataFrame(rows, "k string, v double"), "k", "v", 16).collect()}
    assert got == {k: sorted(v)[len(v) // 2] for k, v in values.items()}


def test_aliases_of_any_length(spark):
    from sifterra.operators import joins

    t = spark.createDataFrame([(1, "Please renew the heavy goods vehicle driving licence now"), (2, "fee"), (3, ""), (4, None)], "id int, q string")
    a = spark.createDataFrame([("heavy goods vehicle driving licence", "hgv"), ("licence", "other"), ("fee", "fee"), ("", "blank")], "alias string, service string")
    got = {r.id: r.service for r in joins.alias_match(t, "id", F.col("q"), a, "alias", "service").collect()}
    assert got == {1: "hgv", 2: "fee"}


def test_queries_in_blocks_give_the_same_scores(spark):
    from sifterra.operators import search

    v = spark.createDataFrame([(i, [float(i % 7), float(i % 3), 1.0]) for i in range(40)], "id int, v array<double>")
    q = v.where("id % 5 = 0").selectExpr("id as qid", "v as qv")
    rows = lambda d: sorted((r.qid, r.id, round(r.score, 9)) for r in d.collect())
    assert rows(search.cosine_scores(v, q, "id", "v", "qid", "qv", block_bytes=64)) == rows(search.cosine_scores(v, q, "id", "v", "qid", "qv"))


def test_upper_median_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([1.0, 2.5, 2.5, 9.0, rng.random() * 100])) for k in "abc" for _ in range(rng.randint(1, 200))] + [("a", None), ("d", None), ("e", 4.0), ("e", 5.0)]
    got = {r.k: r.median for r in metrics.upper_median(spark.createDataFrame(rows, "k string, v double"), "k", "v", 8).collect()}
    for k in "abce":
        v = sorted(x for a, x in rows if a == k and x is not None)
        assert got[k] == v[len(v) // 2]
    assert "d" not in got


def test_group_rank_lowest_and_rolling_count_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot"] * 8 + ["b", None]), rng.randint(0, 40_000)) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, k string, t bigint").withColumn("o", sampling.shuffled("id"))
    data = df.collect()
    for r in sampling.group_rank(df, ["k"], "o").collect():
        assert r._n == sum(x.k == r.k and x.o <= r.o for x in data)
    for n in (0, 1, 77, 600, 900):
        assert {r.id for r in sampling.lowest(df, "o", n).collect()} == {r.id for r in sorted(data, key=lambda r: r.o)[:n]}
    for r in sequences.rolling_count(df, "k", "t", "id", 1000, span=300).collect():
        if r.k is not None:
            assert r.n == sum(x.k == r.k and r.t - 1000 <= x.t <= r.t for x in data)
    for r in sequences.gap_to_previous(df, "k", "t", "id", span=300).collect():
        if r.k is not None:
            before = [x.t for x in data if x.k == r.k and (x.t, x.id) < (r.t, r.id)]
            assert r.gap == (r.t - max(before) if before else None)


def test_patches_and_prefixes(spark):
    from sifterra.operators import joins

    base = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    patches = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "k string, v string, at int")
    new, trail = lifecycle.replay_patches(base, patches, "k", "v", "at")
    assert {r.k: r.v for r in new.collect()} == {"a": "2", "b": "y"} and trail.count() == 2
    known = spark.createDataFrame([("https://e.example/abc",), ("https://e.example/abd",), ("https://e.example/xyz",), (None,)], "u string")
    cut = spark.createDataFrame([("https://e.example/ab",), ("https://e.example/x",), ("https://e.example/abc",), ("https",), (None,)], "c string")
    got = {r.c: r.repaired for r in joins.prefix_repair(cut, "c", known, "u").collect()}
    assert got == {"https://e.example/ab": None, "https://e.example/x": "https://e.example/xyz", "https://e.example/abc": "https://e.example/abc", "https": None, None: None}


def test_vector_index_recall(spark):
    import numpy as np

    from sifterra.operators import vectors

    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 16))
    rows = [(i, [float(v) for v in centers[i % 20] + 0.6 * rng.normal(size=16)]) for i in range(2000)] + [(5000, None), (5001, [0.0] * 16)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    q = df.where("id % 50 = 0 and v is not null").select(F.col("id").alias("qid"), F.col("v").alias("qv"))
    cells = vectors.fit_cells(df, "id", "v", 32)
    probes = vectors.fit_probes(df, "id", "v", cells)
    assert 1 <= probes < 16
    found = vectors.ann_search(df, q, "id", "v", "qid", "qv", cells, 10, probes)
    exact = search.top_k(df.where("v is not null").crossJoin(q).select("qid", "id", F.round(search.cosine(F.col("v"), F.col("qv")), 6).alias("score")), ["qid"], [F.desc("score"), F.asc("id")], 10)
    assert vectors.recall_at_k(found, exact, "qid", "id").first().recall >= 0.9
    empty = df.limit(0)
    none = vectors.fit_cells(empty, "id", "v")
    assert vectors.fit_probes(empty, "id", "v", none) == 1 and vectors.ann_search(empty, q, "id", "v", "qid", "qv", none, 5, 1).count() == 0
