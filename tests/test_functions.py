import pytest
from pyspark.sql import functions as F

from sifterra.functions import html as H
from sifterra.functions import ids, script, text, url
from tests import literals


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(expr.alias("x")).first().x


@pytest.fixture(scope="module")
def url_rows(spark):
    t = spark.createDataFrame([(u,) for u in literals.URL_CASES], "u string")
    u = F.col("u")
    return t.select(url.canonical_url(u).alias("c"), url.url_rejection(u).alias("r"), url.url_class(u).alias("k"), url.url_score(url.url_class(u), F.lit(0)).alias("s"), url.canonical_url(url.canonical_url(u)).alias("cc")).collect()


def test_url_rules(url_rows):
    assert [(r.c, r.r, r.k, r.s) for r in url_rows] == literals.URL_WANT


def test_canonicalising_twice_changes_nothing(url_rows):
    assert all(r.c == r.cc for r in url_rows)


@pytest.mark.parametrize("host,want", [("a.b.gov.example", ["a.b.gov.example", "b.gov.example", "gov.example", "example"])])
def test_host_suffixes(spark, host, want):
    assert one(spark, url.host_suffixes(F.col("h")), h=host) == want


def test_links_are_joined(spark):
    df = spark.createDataFrame([("https://e.example/a/b", "../c?x=1"), ("https://e.example/a", None), (None, "x")], "b string, h string")
    assert [r[0] for r in df.select(url.join_link("b", "h")).collect()] == ["https://e.example/c?x=1", None, None]


@pytest.mark.parametrize(
    "t,want",
    [("क" * 60, "devanagari"), ("plain english words " * 4, "latin"), ("a" * 30 + "क" * 30, "mixed"), ("short", "other"), ("", "other"), ("." * 500 + "a" * 60, "other"), (" ".join(["word"] * 18 + ["lf{kf", "s|ft"]), "mojibake_suspected"), (" ".join(["कार्यालय"] * 18 + ["सं3ह"] * 4), "mojibake_suspected"), ("word (a) [b] " * 12, "latin")],
)
def test_script_bucket(spark, t, want):
    assert one(spark, script.script_bucket(F.col("t")), t=t) == want


def test_legacy_rules_and_romanising(spark):
    f = script.LegacyFont({"s": "क", "sf": "का", "n": "ल"}, post=[("कक", "क्क")])
    assert f.convert("sfn") == "काल" and f.convert_mixed("sfn नमस्ते 12 info@a.example") == "काल नमस्ते 12 info@a.example"
    df = spark.createDataFrame([("नमस्ते १२",), (None,)], "t string")
    assert [r[0] for r in df.select(script.romanise("t")).collect()] == ["namaste 12", None]


CASES = [
    (text.squeeze, "a   b\n c ", "a b c"), (text.mark_citations, "x [1] y [S2]", "x [S1] y [S2]"), (text.last_number, "so 3 and 1,204.5", "1204.5"), (text.last_number, "x #### 42 then 7", "42"), (text.choice_letter, "The answer is (b).", "B"),
    (text.ward_number, "वडा नम्बर १२ मा", 12), (text.ward_number, "Ward no. 7", 7), (text.arithmetic_answer, "what is 6 * 7?", 42.0), (text.arithmetic_answer, "1 / 0", None), (text.is_question, "kasari garne", True), (text.is_gibberish, "aaaaaa", True), (text.is_gibberish, "hello there", False),
    (text.clean_forum, "[a](https://x.example) see https://y.example u/me\n> quote\nEdit: more\n\n\n\nend", "a see\n\nend"), (text.trim_repeated_tail, "a\nb\na\nc", "a\nb"), (text.drop_near_sentences, "The fee is nine rupees. The fee is nine rupees! Come early.", "The fee is nine rupees. Come early."),
    (lambda c: F.array_join(text.citations(c), ","), "a [S1] b [1, S3] https://e.example/x.", "S1,S3,https://e.example/x"), (lambda c: text.longest_equal_run(text.word_tokens(c)), "a b b b c", 3), (lambda c: text.loops(c), "a b c a b c a b c a b c", True), (lambda c: text.repeats_window(c), "0123456789" * 13, True), (lambda c: text.repeats_window(c), "short", False),
    (lambda c: text.truncate_at_boundary(c, 20), "One two three. Four five six seven", "One two three. Four"), (lambda c: text.labelled_field(c, "Fee", ["Time"]), "Fee: 300 Time: 2", "300"), (text.is_refusal, "I cannot find a source", True), (text.is_refusal, None, False), (lambda c: text.require_citation(c, F.lit("[S1]")), "A b. C d [S2].", "A b. [S1] C d [S2]."),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_text_functions(spark, i):
    f, value, want = CASES[i]
    assert one(spark, f(F.col("t")), t=value) == want


def test_html(spark):
    h = F.col("h")
    page = literals.PAGE
    assert one(spark, H.readable_text(h), h=page).startswith("Notice Bring the form") and "foot" not in one(spark, H.readable_text(h), h=page)
    assert one(spark, H.html_title(h), h=page) == "A page" and one(spark, H.raw_link_count(h), h=page) == 3
    assert H.read_html("<p>a<b>b</p><script>x</script>c") == "a b c" and H.read_html(None) is None and H.read_html("") == ""
    assert one(spark, H.is_shell(F.col("t"), F.lit(2), F.lit(1)), t="x" * 199) and not one(spark, H.is_shell(F.col("t"), F.lit(3), F.lit(1)), t="x")
    assert one(spark, H.report_fields(h)["Pages"], h="Title: a: b\nPages: 3\nPages: 4") == "3"
    assert one(spark, H.content_kind(F.col("c"), F.lit("https://e.example/a.PDF?x")), c=None) == "pdf"


def test_ids(spark):
    import hashlib
    import struct

    want = hashlib.sha256(b"d\0" + struct.pack("<I", 300) + b"\0" + "पाठ".encode()).hexdigest()[:24]
    assert one(spark, ids.chunk_id(F.col("d"), F.lit(300), F.col("t")), d="d", t="पाठ") == want
    assert one(spark, ids.document_id(F.col("s"), F.col("u"), F.lit("h")), s="s", u="u") == hashlib.sha256(b"s\0u\0h").hexdigest()[:24]




def test_text_rules(spark):
    from sifterra.operators import records

    t = spark.createDataFrame([c[:2] for c in literals.TEXT_CASES], "f string, i string")
    i = F.col("i")
    each = {
        "ward_number": text.ward_number(i).cast("string"), "last_number": text.last_number(i), "choice_letter": text.choice_letter(i), "arithmetic": text.arithmetic_answer(i).cast("string"), "stem": script.stem_postposition(i), "digits": script.fold_digits(i),
        "gibberish": text.is_gibberish(i).cast("string"), "foreign": script.foreign_artifact(i).cast("string"), "snippet": text.snippet(i, F.lit("fee")), "scrub": records.scrub(i, ["ram"], "[name]"), "marks": text.mark_citations(i),
        "tail": F.replace(text.trim_repeated_tail(F.replace(i, F.lit("~"), F.lit("\n"))), F.lit("\n"), F.lit("~")),
    }
    out = F.lit(None).cast("string")
    for name, c in each.items():
        out = F.when(F.col("f") == name, c).otherwise(out)
    assert [tuple(r) for r in t.select("f", "i", out).collect()] == literals.TEXT_CASES


def test_json_in_other_text(spark):
    from sifterra.operators import records

    t = spark.createDataFrame([('x {"name": "ok", "n": 2,} y',), ('```json\n{"name": "fenced", "n": 3}\n```',), ("none",), (None,)], "raw string")
    assert [r.j and tuple(r.j) for r in t.select(records.tolerant_json(F.col("raw"), "name string, n int").alias("j")).collect()] == [("ok", 2), ("fenced", 3), None, None]


def test_pdf_tiers(spark):
    rows = [
        (0, 0, 10, 3, 0, 0.0, 0.0, False, "C", "C", "high", []), (0, 0, 10, 3, 0, 0.0, 0.0, False, None, "C", "medium", []), (900, 20, 3000, 1, 0, 0.0, 0.3, False, None, "A", "high", []), (60, 2000, 3000, 1, 0, 0.0, 0.02, True, None, "A", "medium", ["low_devanagari_share"]),
        (300, 500, 2000, 1, 4, 0.0, 0.2, False, None, "Mixed", "medium", ["mixed_encoding"]), (0, 800, 1000, 1, 5, 0.0, 0.0, False, None, "BPreeti", "high", []), (0, 800, 1000, 1, 2, 0.0, 0.0, False, None, "BPreeti", "medium", []), (0, 800, 1000, 1, 2, 0.001, 0.0, True, None, "E", "medium", []),
        (0, 800, 1000, 1, 0, 0.06, 0.0, False, None, "BPreeti", "medium", []), (0, 800, 1000, 1, 0, 0.0, 0.0, False, None, "BLegacyUnknown", "low", ["no_known_font_and_not_english"]), (0, 800, 1000, 1, 0, 0.0, 0.0, False, "B-legacy", "BLegacyUnknown", "medium", ["no_known_font_and_not_english"]),
        (30, 10, 200, 1, 0, 0.0, 0.1, False, None, "Unknown", "low", ["very_short_text"]), (None, None, None, None, None, None, None, None, None, "Unknown", "low", ["very_short_text"]),
    ]
    t = spark.createDataFrame([r[:9] for r in rows], "d int, l int, n int, p int, m int, s double, r double, e boolean, h string")
    got = t.select(script.pdf_tier(*map(F.col, "dlnpmsreh")).alias("x")).collect()
    assert [(r.x.tier, r.x.confidence, r.x.warnings) for r in got] == [r[9:] for r in rows]


@pytest.mark.parametrize(
    "token,want",
    [("", False), ("नेपाल", False), ("s]", True), (":", False), ("@)&*", True), ("!", True), ("cfly{s", True), ("ljifo", True), ("...", False), ("2078/01", False), ("PAN", False), ("the", False), ("payment", False), ("Kathmandu", False), ("banana", False), ("xqzt", True), ("Hello!", False), ("12th", True)],
)
def test_legacy_tokens(token, want):
    assert script.converts(token, frozenset({"the"})) == want


def test_quality_gate(spark):
    from sifterra.operators import records

    r = lambda *hosts: [(h, rel) for h, rel in hosts]
    rows = [
        (2, [], None, [], False, False, "tacit_only", True), (0, [], None, [], False, False, "no_sources", False), (0, None, "tax", ["ird.example"], False, False, "no_sources", False),
        (0, r(("a.example", "high")), None, [], True, False, "locality_without_service_topic", False), (1, r(("a.example", "low")), "birth", [], True, True, "local_tacit_topic_match", True),
        (0, r(("x", "low"), ("y", "low"), ("www.ird.example", "low")), "tax", ["ird.example"], False, False, "expected_domain_in_top3", True),
        (0, r(("x", "high"), ("y", "low"), ("notird.example", "low"), ("ird.example", "low")), "tax", ["ird.example"], False, False, "topic_expected_domain_missing_top3", False),
        (0, r(("x", "medium")), None, [], False, False, "top_gov_relevance_medium", True), (0, r(("x", "low")), "tax", [], False, False, "low_relevance", False), (None, r(("x", None)), None, None, None, None, "low_relevance", False),
    ]
    t = spark.createDataFrame([x[:6] for x in rows], "n int, results array<struct<host:string,relevance:string>>, topic string, expected array<string>, place boolean, strict boolean")
    got = t.select(records.quality_gate(*map(F.col, ["n", "results", "topic", "expected", "place", "strict"])).alias("g")).collect()
    assert [tuple(x.g) for x in got] == [x[6:] for x in rows]


def test_expanded_terms(spark):
    from sifterra.operators import joins

    q = spark.createDataFrame([(1, ["fee", "office", "fee"]), (2, ["desk"])], "id int, terms array<string>")
    s = spark.createDataFrame([("fee", "charge"), ("fee", "cost"), ("office", "bureau")], "term string, extra string")
    got = {r.id: sorted(r.expanded[2:]) + r.expanded[:2] for r in joins.expand_terms(q, "id", "terms", s).collect()}
    assert got == {1: ["bureau", "charge", "cost", "fee", "office"], 2: ["desk"]}


def test_loops_and_languages(spark):
    long = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango"
    cases = [("", True, False), ("one two", False, False), ("a b c d e " * 5, True, False), ("x y z q w. " + "a b c " * 4, True, False), (long, False, False), (long + " one two three" * 4, True, True)]
    t = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = t.select(text.opening_loop(F.col("t")).alias("a"), text.phrase_loop(F.col("t")).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [c[1:] for c in cases]
    t = spark.createDataFrame([("where is it",), ("kati parcha",), ("फी कति हो fee",), ("123",), ("fees shulka",)], "t string")
    assert [(r[0], r[1]) for r in t.select(script.server_language(F.col("t")), script.navigator_language(F.col("t"))).collect()] == [("english", "english"), ("roman_nepali", "roman_nepali"), ("devanagari", "devanagari"), ("english", "english"), ("english", "english")]
    t = spark.createDataFrame([("क" * 25, "english"), ("क" * 24, "english"), ("क" * 13 + "a" * 200, "roman_nepali"), ("क" * 40, "devanagari"), (None, "english")], "a string, l string")
    assert [r[0] for r in t.select(script.answer_script_mismatch(F.col("a"), F.col("l"))).collect()] == [True, False, False, False, False]


def test_stored_index_gives_the_same_scores(spark, tmp_path):
    from sifterra.operators import search

    docs = spark.createDataFrame([(i, " ".join(f"word{(i * j) % 17}" for j in range(1, 30))) for i in range(60)] + [(99, None)], "doc_id int, text string")
    q = spark.createDataFrame([(1, "word3 word5 word3"), (2, "word16 absent"), (3, "nothing")], "q int, t string")
    search.write_index(docs, str(tmp_path / "i"), buckets=5)
    rows = lambda d: sorted((r.q, r.doc_id, round(r.score, 9)) for r in d.collect())
    want = rows(search.bm25(docs, q, "q", "t"))
    assert want and rows(search.search_index(spark, str(tmp_path / "i"), q, "q", "t")) == want
    terms = q.select("q", F.split("t", " ").alias("terms"))
    more = rows(search.contains_fallback(search.bm25(docs, q, "q", "t"), docs, terms.unionByName(spark.createDataFrame([(4, ["ord1"])], terms.schema)), "q", "terms", "doc_id", "text"))
    assert [r for r in more if r[0] < 4] == want and {r[1] for r in more if r[0] == 4} == {r.doc_id for r in docs.where("text like '%ord1%'").collect()}


def test_claims_and_supplements(spark):
    from sifterra.operators import search

    claims = spark.createDataFrame([(1, ["tax", "pan", "kotgaun"], "kotgaun.example", "high", ["pan"]), (2, ["kotgaun", "hall"], "x.example", None, []), (3, ["tax"] + [f"w{i}" for i in range(60)], None, "low", ["a", "b", "c", "d"])], "c int, tokens array<string>, domain string, confidence string, markers array<string>")
    asked = spark.createDataFrame([(7, ["tax", "kotgaun"], ["kotgaun.example"]), (8, ["kotgaun"], [])], "q int, tokens array<string>, domains array<string>")
    got = {(r.q, r.c): round(r.score, 6) for r in search.claim_scores(claims, asked, "c", "q", ["kotgaun"]).collect()}
    assert got == {(7, 1): round(2 * (1 + 0.3 * (1 - 3 / 50)) + 0.75 + 2.5 + 1.25 + 0.5, 6), (7, 3): round(1 + 0.75 + 4.0 - 0.5, 6), (8, 1): round(1 + 0.3 * (1 - 3 / 50) + 1.25 + 0.5, 6), (8, 2): round(1 + 0.3 * (1 - 2 / 50), 6)}
    a = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0)], "q int, d int, score double")
    b = spark.createDataFrame([(1, 2, 9.0), (1, 3, 1.0), (2, 1, 1.0)], "q int, d int, score double")
    assert sorted((r.q, r.d, r.pull, r.score) for r in search.supplement([a, b], "q", "d").collect()) == [(1, 1, 0, 5.0), (1, 2, 0, 4.0), (1, 3, 1, 1.0), (2, 1, 1, 1.0)]


def test_leaf_blocks_with_their_tags(spark):
    page = "<html><head><title>T</title><script>x()</script></head><body><nav><ul><li><a href=/>Home</a><li>About <b>us</b></ul></nav><main><p>One<br>two &amp; three</p></main>tail</body>"
    want = [("html/head/title", "T"), ("html/body/nav/ul/li/a", "Home"), ("html/body/nav/ul/li/li", "About us"), ("html/body/main/p", "One"), ("html/body/main/p", "two & three"), ("html/body", "tail")]
    t = spark.createDataFrame([(page,), ("",), (None,)], "h string")
    got = [r[0] if r[0] is None else [tuple(x) for x in r[0]] for r in t.select(H.html_blocks(F.col("h"))).collect()]
    assert got == [want, [], None]


def test_corpus_scores_against_brute_force(spark):
    import math
    import random
    from collections import Counter

    from sifterra.operators import metrics

    rng = random.Random(2)
    words = "the office asks a fee form copy न्याय दर्ता , . today".split()
    rows = [(rng.choice("ab"), " ".join(rng.choices(words, k=rng.randint(0, 14))), " ".join(rng.choices(words, k=rng.randint(0, 14)))) for _ in range(60)] + [("c", None, "x"), ("c", "", None)]
    got = {r.g: (r.n, round(r.bleu, 6), round(r.chrf_pp, 6)) for r in metrics.corpus_scores(spark.createDataFrame(rows, "g string, h string, r string"), ["g"], F.col("h"), F.col("r")).collect()}
    for g in "abc":
        pairs = [((h or ""), (r or "")) for k, h, r in rows if k == g]
        grams = lambda x, n: Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))

        def totals(split, n):
            out = [0, 0, 0]
            for h, r in pairs:
                a, b = grams(split(h), n), grams(split(r), n)
                out = [out[0] + sum(min(a[k], b[k]) for k in a), out[1] + sum(a.values()), out[2] + sum(b.values())]
            return out

        w = [totals(metrics.score_tokens, n) for n in range(1, 5)]
        size = [sum(len(metrics.score_tokens(p[i])) for p in pairs) for i in (0, 1)]
        bleu = 0.0
        if all(x[0] for x in w):
            bleu = 100 * (1.0 if size[0] >= size[1] else math.exp(1 - size[1] / size[0])) * math.exp(sum(math.log(x[0] / x[1]) for x in w) / 4)
        fs = []
        for m, h, r in [totals(lambda t: "".join(t.split()), n) for n in range(1, 7)] + w[:2]:
            if h and r:
                p, q = m / h, m / r
                fs.append(5 * p * q / (4 * p + q) if p + q else 0.0)
        assert got[g] == (len(pairs), round(bleu, 6), round(100 * sum(fs) / len(fs) if fs else 0.0, 6))


def test_cases_and_contacts(spark):
    from sifterra.operators import cases

    rules = [("service", "passport", "passport"), ("service", "passport", "राहदानी"), ("service", "municipality", "municipality"), ("service", "licence", "driving licence"), ("action", "fee", "fee"), ("action", "complaint", "complaint"), ("district", "Kaski", "kaski")]
    rows = [(1, "Passport fee in Kaski?"), (2, "मेरो राहदानीको गुनासो"), (3, "hello"), (4, None), (5, "complaint on driving licence at the municipality"), (6, "feeling")]
    t = spark.createDataFrame(rows, "id int, q string")
    got = {r.id: r.slots for r in cases.resolve_slots(t, "id", F.col("q"), rules).collect()}
    assert got == {1: {"service": "passport", "action": "fee", "district": "Kaski"}, 2: {"service": "passport"}, 3: {}, 4: {}, 5: {"service": "licence", "action": "complaint"}, 6: {}}
    required = [(None, None, ["service"]), ("passport", None, ["district"])]
    ask = {"service": {"english": "Which service?", "devanagari": "कुन सेवा?"}, "district": {"english": "Which district?"}}
    d = cases.resolve_slots(t, "id", F.col("q"), rules).withColumn("c", cases.contract(F.col("slots"), F.when(F.col("id") == 3, "devanagari").otherwise("english"), F.lit(False), F.col("id") == 4, required, ask))
    out = {r.id: (r.c.decision, r.c.missing_slots, r.c.followup_questions) for r in d.collect()}
    assert out[1] == ("retrieve_then_answer", [], []) and out[2] == ("partial_answer_plus_followup", ["district"], ["Which district?"])
    assert out[3] == ("partial_answer_plus_followup", ["service"], ["कुन सेवा?"]) and out[4][0] == "ack_memory" and out[5][0] == "complaint_handoff_or_retrieve"
    c = spark.createDataFrame([("x " * 100 + "Information Officer Ram Bahadur Thapa, phone ०१२३४५६ end", "0123456"), ("Contact No 5", "99"), ("सूचना अधिकारी सीता देवी", "1"), (None, None)], "t string, n string")
    w = cases.context_window(F.col("t"), F.col("n"), 100)
    roles = [("Information Officer", ["information officer", "सूचना अधिकारी"]), ("Office contact", ["contact", "phone"])]
    got = [tuple(r) for r in c.select(cases.role_from_context(w, roles), cases.name_from_context(F.regexp_replace(w, "Information Officer ", ""), ["Contact No"])).collect()]
    assert got == [("Information Officer", "Ram Bahadur Thapa"), ("Office contact", None), ("Information Officer", "सूचना अधिकारी सीता देवी"), (None, None)]
