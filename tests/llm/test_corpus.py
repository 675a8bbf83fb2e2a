import collections
import random

import numpy as np
import pytest

from sifterra.llm import boilerplate as B
from sifterra.llm import leaks as K
from sifterra.llm import mixing as M


def _chunks(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, doc_id string, text string").selectExpr("*", "'x' as source_id", "0 as support")


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(3)
    lines = ["Disclaimer: office {} holds no liability.", "यो सूचना सेयर गर्नुहोस् {}", "Page {} of the system !", "unique words here", "café  notice", "12345"]
    rows, src = [], []
    for d in range(60):
        src += [(f"d{d}", f"s{d % 3}")] * 2
        for c in range(2):
            parts = [rng.choice(lines).format(rng.randint(1, 99)) for _ in range(3)] + ["abcdefghij"[rng.randrange(10)] * (1 + d % 40)]
            rng.shuffle(parts)
            rows.append((f"d{d}c{c}", f"d{d}", "\n".join(parts)))
    rows += rows[:5] + [("n1", "d1", None), ("n2", "d2", ""), ("n3", "nosource", lines[3]), ("n4", None, lines[3]), ("n5", "d3", "café NOTICE")]
    docs = spark.createDataFrame(src, "doc_id string, source_id string")
    sources = collections.defaultdict(set)
    for d, s in src:
        sources[d].add(s)
    having, where = collections.defaultdict(set), collections.defaultdict(set)
    for c, d, t in set(rows):
        for i, line in enumerate((t or "").split("\n"), 1):
            f = B.line_form(line)
            for s in sources.get(d, ()) if f else ():
                having[s, f].add(d)
                where[s, f].add((c, i))
    want = {x for k, v in having.items() if len(v) >= 8 for x in where[k]}
    out = B.repeated_lines(_chunks(spark, rows), docs)
    assert {(r.chunk_id, r.line_no) for r in out.collect()} == want and want
    clean = {r.chunk_id: r.clean_text for r in B.strip_lines(_chunks(spark, rows).dropDuplicates(["chunk_id"]), out).collect()}
    assert clean["n1"] is None and clean["n2"] == "" and "Disclaimer" not in clean["d0c0"]


def test_blocks_are_components(spark):
    rows = [(f"c{d}", f"d{d}", f"first line\nsecond line\nbody {'abcdefghijkl'[d]}\nalone line") for d in range(10)]
    docs = spark.createDataFrame([(f"d{d}", "s") for d in range(10)], "doc_id string, source_id string")
    out = B.repeated_lines(_chunks(spark, rows), docs).collect()
    blocks = {r.line_no: r.block for r in out}
    assert set(blocks) == {1, 2, 4} and blocks[1] == blocks[2] != blocks[4]
    assert B.repeated_lines(_chunks(spark, []), docs).count() == 0


def test_forms():
    assert B.line_form("  Page 12,  of\t3! ") == B.line_form("page of") == "pageof"
    assert B.line_form("é") == B.line_form("É") and B.line_form("12 — 3") == ""


def _vocab(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_leaks_against_brute_force(seed):
    rng = random.Random(seed)
    vocab = _vocab(rng, 40)
    items = [(i, [" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 30))), " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))) or None]) for i in range(70)]
    docs = []
    for _ in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 400))]
        src = (rng.choice(items)[1][0] or "").split()
        n = rng.choice([9, 10, 11, 30])
        at = rng.randint(0, len(words))
        words[at:at] = [w.upper() for w in src[:n]]
        docs.append(", ".join(words))
    index = K.ItemIndex(items)
    for d in docs:
        w = [K.normal_word(x) for x in K.runs(d)]
        grams = {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
        want = set()
        for i, texts in items:
            for t in texts:
                v = [K.normal_word(x) for x in K.runs(t or "")]
                if any(tuple(v[j : j + 10]) in grams for j in range(len(v) - 9)):
                    want.add(i)
        assert set(index.search(d)) == want


def test_candidates_equal_the_full_scores():
    rng = random.Random(11)
    vocab = _vocab(rng, 300)
    weights = [1 / (i + 1) for i in range(len(vocab))]
    pick = lambda n: " ".join(rng.choices(vocab, weights, k=n))
    index = K.ItemIndex([(i, [pick(rng.randint(10, 25)), pick(rng.randint(10, 60))]) for i in range(200)])
    for _ in range(60):
        terms = {index.vocab[w] for w in pick(rng.choice([10, 40, 128])).split() if w in index.vocab}
        score = np.zeros(len(index.items))
        on = np.isin(index.term, list(terms))
        np.add.at(score, index.part[on], index.share[on])
        for lean in (0.2, 0.75, 1.0):
            assert {p for p, _ in index.candidates(terms, lean)} == set(np.flatnonzero(score >= K._NEAR))


def test_leak_operator_on_odd_rows(spark):
    ten = "a१ b c d e f g h i j"
    items = spark.createDataFrame([(1, ten, None), (2, "too short", "k l m n o p q r s t u"), (3, None, ""), (1, ten, None)], "item_id bigint, question string, gold_answer string").selectExpr("*", "1 as doc_id")
    docs = spark.createDataFrame([(1, "X A1, B c d\nE f g h i J y"), (2, "a1 b c d e f g h i"), (3, None), (4, ""), (5, "z " * 50_000 + "l m n o p q r s t u"), (1, "X A1, B c d\nE f g h i J y")], "doc_id bigint, text string").selectExpr("*", "1 as item_id", "2 as score")
    got = {(r.item_id, r.doc_id) for r in K.leaked_items(docs, items).collect()}
    assert got == {(1, 1), (2, 5)}
    assert {(r.item_id, r.doc_id) for r in K.leaked_items(docs, items, shard=1).collect()} == got  # in shards
    assert {(r.item_id, r.doc_id) for r in K.leaked_items(docs, items, most_bytes=1).collect()} == got  # split until each holds one item
    assert K.leaked_items(docs.limit(0), items).count() == 0 and K.leaked_items(docs, items.limit(0)).count() == 0


def test_token_counts_equal_the_tokenizer():
    c = M.TokenCounter()
    rng = random.Random(1)
    for _ in range(3000):
        x = "".join(rng.choice("ab क्́ \n\t'sl12१—　\x1c\xa0😀") for _ in range(rng.randint(0, 14)))
        assert c.count(x) == len(c.encoding.encode_ordinary(x))
    assert c.count(None) == c.count("") == 0


def _mix(spark, sizes, targets, total=None):
    rows = [(i, s, n) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    counts = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    rates = M.source_rates(counts, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), total)
    mixed = M.mix(counts, rates)
    return mixed, M.mix_report(counts, rates, mixed)


def test_mix_meets_the_shares_and_the_caps(spark):
    sizes = {"a": [100] * 8000, "b": [50] * 8000, "c": [10] * 6000, "none": [9] * 10}
    mixed, report = _mix(spark, sizes, [("a", 0.2, 2), ("b", 0.5, 4), ("c", 0.3, 3), ("absent", 0.1, 3)])
    r = {x.source: x for x in report.collect()}
    for s, share in (("a", 0.2), ("b", 0.5), ("c", 0.3)):
        assert r[s].actual_share == pytest.approx(share, abs=0.03)
    assert r["c"].rate == 3.0 and r["c"].copies == 18000 and set(r) == {"a", "b", "c"}
    most = {x[0]: x[1] for x in mixed.groupBy("source").agg({"copy_no": "max"}).collect()}
    assert most["a"] <= 2 and most["b"] <= 4 and most["c"] <= 3
    assert mixed.exceptAll(_mix(spark, sizes, [("a", 0.2, 2), ("b", 0.5, 4), ("c", 0.3, 3), ("absent", 0.1, 3)])[0]).count() == 0


def test_mix_with_a_total_fills_from_the_others(spark):
    _, report = _mix(spark, {"a": [10] * 500, "b": [10] * 10}, [("a", 0.5, 2), ("b", 0.5, 1)], 4000)
    r = {x.source: x for x in report.collect()}
    assert r["b"].rate == 1.0 and r["a"].mixed_tokens == pytest.approx(3900, rel=0.1)


def test_mix_of_nothing(spark):
    mixed, report = _mix(spark, {"a": [0]}, [("a", 1.0, 2)])
    assert mixed.count() == 0 and report.count() == 0
    docs = spark.createDataFrame([(1, None, None), (2, "s", ""), (3, "s", "word " * 30_000)], "doc_id bigint, source string, text string").selectExpr("*", "1 as tokens")
    got = {r.doc_id: r.tokens for r in M.token_counts(docs).collect()}
    assert got[1] == got[2] == 0 and got[3] >= 30_000


def test_blocks_of_long_chains(spark):
    rng = random.Random(5)
    chains = [("s", list(range(0, 150))), ("s", list(range(200, 203))), ("t", list(range(0, 70))), ("t", [900])]
    for _, c in chains[:1]:
        rng.shuffle(c)
    nodes = [(s, n, -n, 8) for s, c in chains for n in c]
    edges = [(s, a, -a, b, -b, 8) for s, c in chains for a, b in zip(c, c[1:])]
    got = B.line_blocks(spark.createDataFrame(nodes, "source_id string, h1 bigint, h2 bigint, support bigint"), spark.createDataFrame(edges, "source_id string, a1 bigint, a2 bigint, b1 bigint, b2 bigint, weight bigint")).collect()
    ident = lambda n: f"{n & (1 << 64) - 1:016x}{-n & (1 << 64) - 1:016x}"
    want = {(s, n): min(map(ident, c)) for s, c in chains for n in c}
    assert {(r.source_id, r.h1): r.block for r in got} == want and len(got) == len(nodes)
