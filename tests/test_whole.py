"""Queries that do the whole job, over inputs on which a cut shows."""

import hashlib
import math
from collections import Counter

from sifterra.plans import core_queries
from tests.test_operators import python_chunks


def run(spark, name, folder):
    return core_queries.queries()[name](spark, str(folder)).collect()


def test_messages_hold_whole_contents(spark, tmp_path):
    long = "word " * 500 + "end"
    rows = [(1, n, "user", f"{n} {long}") for n in range(10)] + [(1, 9, "user", f"9 {long}"), (2, 0, None, "x"), (2, 1, "user", "y"), (3, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id bigint, turn_no int, role string, content string").write.parquet(f"{tmp_path}/chat_turns.parquet")
    got = {r.conv_id: (r.turns, r.messages) for r in run(spark, "messages_whole", tmp_path)}
    assert got == {1: (8, "\n".join(f"user: {n} {long}" for n in range(2, 10))), 2: (2, "user: y")}


def test_every_chunk_has_its_id(spark, tmp_path):
    texts = {1: "short", 2: "x" * 199, 3: "y" * 200, 4: "Some words here. " * 200, 5: "कार्यालय । " * 60_000, 6: "", 7: None}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {(k, i): hashlib.sha256(str(k).encode() + b"\0" + i.to_bytes(4, "little") + b"\0" + t[a:b].encode()).hexdigest()[:24] for k, t in texts.items() for i, (a, b) in enumerate(python_chunks(t or ""))}
    got = run(spark, "chunk_ids_all", tmp_path)
    assert {(r.doc_id, r.chunk_index): r.chunk_id for r in got} == want and len(got) == len(want)
    assert max(i for _, i in want) > 255


def test_fusion_ranks_all_documents_of_every_query(spark, tmp_path):
    docs = {i: " ".join(["fee"] * (i % 5) + ["office"] * (i % 3) + ["word"] * (i * 7 % 11)) for i in range(60)}
    asked = {0: "office fee", 50: "fee fee word", 51: "fee"}
    spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(asked.items()), "item_id bigint, question string").write.parquet(f"{tmp_path}/gold_items.parquet")
    toks = {i: Counter(t.split()) for i, t in docs.items()}
    mean = sum(sum(c.values()) for c in toks.values()) / len(toks)
    want = Counter()
    for q in (0, 50):
        for b in (0.75, 0.0):
            score = {}
            for term, weight in Counter(asked[q].split()).items():
                df = sum(term in c for c in toks.values())
                for i, c in toks.items():
                    if term in c:
                        score[i] = score.get(i, 0) + weight * max(0, math.log((len(docs) - df + 0.5) / (df + 0.5) + 1)) * c[term] * 2.5 / (c[term] + 1.5 * (1 - b + b * sum(c.values()) / mean))
            for r, i in enumerate(sorted(score, key=lambda i: (-round(score[i], 6), i)), 1):
                want[q, i] += 1 / (60 + r)
    got = {(r.item_id, r.doc_id): (r.fused, r.lists) for r in run(spark, "rrf_rankings", tmp_path)}
    assert got == {k: (round(v, 9), 2) for k, v in want.items()} and len({d for _, d in got}) > 20


def test_every_address_has_its_place(spark, tmp_path):
    rows = [("hot", f"u{i:03d}", i % 3, None if i % 7 == 0 else i % 5) for i in range(90)] + [("b", "x", 1, 2), ("b", "x", 0, 1), ("b", "y", 0, 2), ("b", None, 0, 2), (None, "z", 0, 2)]
    spark.createDataFrame(rows, "source_id string, url string, depth int, priority_at_fetch int").write.parquet(f"{tmp_path}/crawl_documents.parquet")
    hot = sorted(rows[:90], key=lambda r: (r[3] is None, -(r[3] or 0), r[2], r[1]))
    want = {("hot", r[1]): (r[2], n) for n, r in enumerate(hot, 1)} | {("b", "x"): (0, 1), ("b", "y"): (0, 2)}
    got = run(spark, "frontier_places", tmp_path)
    assert {(r.source_id, r.url): (r.depth, r.place) for r in got} == want and len(got) == len(want)
