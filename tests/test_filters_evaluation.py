import pytest
from pyspark.sql import functions as F

from sifterra.operators import evaluation as E
from sifterra.operators import filters as L
from sifterra.operators import joins, records


def one(spark, expr, ddl, *values):
    return spark.createDataFrame([values], ddl).select(expr.alias("x")).first().x


def test_reasons_add_up(spark):
    df = spark.createDataFrame([("",), ("short",), ("long enough text",), (None,)], "t string")
    reason = L.first_reason([("null", F.col("t").isNull()), ("empty", F.col("t") == ""), ("short", F.length("t") < 8)])
    got = {r.drop_reason: r.n for r in L.reason_counts(df, reason).collect()}
    assert got == {"null": 1, "empty": 1, "short": 1, "kept": 1} and sum(got.values()) == df.count()


def test_filters(spark):
    df = spark.createDataFrame([(1, "a", True, "x"), (2, "b", None, "x"), (3, "c", False, " ")], "id int, k string, skip boolean, t string")
    assert [r.id for r in L.with_fields(df, ["t"], "skip").collect()] == [2]
    assert sorted(r.id for r in L.in_keys(df, df.where("id > 1"), "k").collect()) == [2, 3]
    assert [r.x for r in df.select(L.by_class(F.col("k"), ["a"], {"b": F.col("skip")}).alias("x")).collect()] == [True, False, False]
    kids = spark.createDataFrame([(1, True), (1, False), (2, True), (3, None)], "id int, ok boolean")
    assert [r.id for r in L.children_all(df, kids, "id", F.col("ok")).collect()] == [2]
    assert [r.p for r in df.select(L.priority([F.col("k") == "b", F.col("skip")]).alias("p")).collect()] == [1, 0, 2]
    assert one(spark, L.canonical_query(F.col("t"), [("fee", "fees"), ("desk", "desks")], F.lit("other")), "t string", "the desk fee") == "fees"
    assert [r.x for r in df.select(L.transition(F.lit("pending"), F.col("k"), [("pending", "a", "dispatched")]).alias("x")).collect()] == ["dispatched", "pending", "pending"]
    assert {(r.column_name, r.value): r.n for r in L.frequency_tables(df, ["t", "skip"]).collect()}["t", "x"] == 2
    assert L.shuffle_holdout(spark.range(1000).toDF("id"), "id").where("split = 'holdout'").count() == 100
    q = spark.createDataFrame([(1, "pending", 5), (2, "done", 1), (3, "pending", 2)], "queue_id int, status string, queued_at int")
    assert L.queue_head(q, ["queue_id"]).first().queue_id == 3


def test_registrable_domains(spark):
    hosts = spark.createDataFrame([("a.b.gov.np",), ("gov.np",), ("x.com",), ("nosuffix",), (None,)], "h string")
    suffixes = spark.createDataFrame([("np",), ("gov.np",), ("com",)], "s string")
    got = {r.h: r.domain for r in L.registrable_domain(hosts, "h", suffixes, "s").collect()}
    assert got == {"a.b.gov.np": "b.gov.np", "gov.np": None, "x.com": "x.com", "nosuffix": None, None: None}


@pytest.mark.parametrize(
    "f,value,want",
    [
        (lambda c: E.repeated_sentences(c), "The office is open today. x. The office is open today. THE OFFICE is open  today.", True), (lambda c: E.repeated_sentences(c), "Short. Short. Short.", False),
        (E.single_refusal, "I cannot find it. Try the desk. I cannot find it there.", "I cannot find it. Try the desk."), (E.stop_after_repeats, "A b. A b. A b. C d.", "A b."), (E.stop_after_repeats, "A b. A b. C d.", "A b. C d."),
        (E.embedded_host, "http//www.a.gov.example/x", "www.a.gov.example"), (lambda c: E.first_answer(F.lit(None).cast("string"), F.lit(" "), c), "yes", "yes"), (lambda c: E.numeric_match(c, F.lit("#### 42")), "so it is 42", True), (lambda c: E.choice_match(c, F.lit("b")), "(B) because", True), (lambda c: E.numeric_match(c, F.lit("1")), None, False),
    ],
)
def test_answers(spark, f, value, want):
    assert one(spark, f(F.col("t")), "t string", value) == want


def test_cases_and_ranks(spark):
    issues = E.case_issues(F.col("a"), F.col("x"), F.col("y"), F.col("z"))
    assert one(spark, issues, "a string, x array<string>, y array<string>, z array<string>", "Fee at the desk", ["form"], ["fee", "desk"], ["desk"]) == ["missing_any", "has_forbidden"]
    assert one(spark, E.first_hit_rank(F.col("r"), F.col("e")), "r array<string>, e array<string>", ["x.com", "a.gov.example"], ["gov.example"]) == 2
    assert one(spark, E.first_hit_rank(F.col("r"), F.col("e")), "r array<string>, e array<string>", ["notgov.example"], ["gov.example"]) is None
    assert one(spark, E.value_lines(F.col("f")), "f array<struct<label:string,value:string>>", [("Fee", "Rs 5"), ("Note", "none"), ("Mail", "a@b.c")]) == "Fee: Rs 5\nMail: a@b.c"
    s = E.type_score(F.col("k"), F.col("r"), F.lit(9.0), F.lit(0.5))
    got = one(spark, s, "k string, r boolean", "grounded", None)
    assert got.chrf == 9.0 and got.wrongly_refused is False and got.hallucination is None


def test_rows(spark):
    gold = spark.createDataFrame([(1, "grounded"), (2, "grounded"), (3, "refusal"), (4, "grounded")], "id int, kind string")
    res = spark.createDataFrame([(1, True), (2, False), (3, True)], "id int, model_refused boolean")
    assert {r.id: r.why for r in E.repair_rows(res, gold, "id").collect()} == {1: "wrong_refusal", 4: "missing"}
    assert E.hard_negatives(gold, "grounded", "id", 2, {"en": "no"}, "kind").count() == 2
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(400)], "id int, even boolean")
    got = {r[0]: r[1] for r in df.groupBy(E.weighted_choice(F.col("id"), [("a", 3, F.lit(True)), ("b", 1, F.col("even"))])).count().collect()}
    assert got["a"] > 300 and 20 < got["b"] < 90
    assert E.one_or_two(df.limit(2), F.lit("x"), F.when(F.col("even"), "y")).count() == 3
    assert E.longest_name(spark.createDataFrame([("d", "ab"), ("d", "abc"), ("d", None)], "d string, n string"), "d", "n").first().n == "abc"
    c = spark.createDataFrame([("A b. C d [2].", "[S1]"), ("I cannot find it.", "[S1]"), (None, "[S1]")], "a string, m string")
    assert [r.a for r in E.control_rows(c, "a", "m").collect()] == ["A b. [S1] C d [S2]."]
    assert {r.n: r.accuracy for r in E.accuracy(df, ["even"], F.col("even")).where("even").collect()} == {200: 1.0}


def test_join_forms(spark):
    t = spark.createDataFrame([(1, ["b", "a"])], "id int, p array<string>")
    assert joins.first_available(t, "id", "p", spark.createDataFrame([("a",), ("c",)], "name string"), "name").first().name == "a"
    a = spark.createDataFrame([(1, 2, "c")], "q int, o int, body string")
    got = joins.numbered_sources(a, spark.createDataFrame([(1, 1, "d"), (1, 2, "e")], a.schema), "q", "o").orderBy("source_ref").collect()
    assert [(r.body, r.source_ref) for r in got] == [("c", "S1"), ("d", "S2"), ("e", "S3")]
    local = spark.createDataFrame([("x", True, ["y"]), ("y", False, ["y"]), ("z", False, ["y"]), ("z", False, [])], "place string, fed boolean, wanted array<string>")
    assert joins.location_filter(local, F.col("place"), F.col("wanted"), F.col("fed")).count() == 3
    assert one(spark, records.without_garbled(F.col("t")), "t string", "सेवा सं3ह लिन (सेवा)") == "सेवा लिन (सेवा)"
    assert one(spark, records.gates({"r": F.lit(0.8)}, {"r": ("min", 0.7)})[0], "t string", "x") is True
    assert one(spark, F.size(records.pad_right(F.col("i"), F.lit(4), 0)), "i array<int>", [1]) == 4
