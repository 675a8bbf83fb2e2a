import random

from sifterra.llm import reading as R
from tests.llm.test_language import model  # noqa: F401

EASY = "you can come here and ask the man at the desk for a form".split()
MID = "applicants submit the registration form with a certified copy at the counter".split()
HARD = "notwithstanding the retrospective jurisdiction the substantiation adjudicated pursuant to stipulations".split()


def text(level, rng, n=80):
    pools = {1: [EASY] * 8 + [MID], 2: [EASY] + [MID] * 8 + [HARD], 3: [MID] + [HARD] * 6}[level]
    out = []
    while len(out) < n:
        out += rng.choice(pools)
    return " ".join(out[:n])


def fitted():
    rng = random.Random(1)
    return R.fit_reading_model([("en", lv, text(lv, rng)) for lv in (1, 2, 3) for _ in range(40)])


def test_held_out_accuracy():
    m, rng = fitted(), random.Random(2)
    ok = [m.level("en", text(lv, rng))[0] == lv for lv in (1, 2, 3) for _ in range(40)]
    assert sum(ok) / len(ok) >= 0.95


def test_grades_follow_the_level_of_first_use():
    g = fitted().grades["en"]
    assert g["ask"] < g["applicants"] < g["jurisdiction"]


def test_operator_on_odd_rows(spark, model):  # noqa: F811
    rng = random.Random(3)
    en = text(1, rng)
    mixed = "\n".join([text(1, rng, 60), "das amt prüft die angaben und benachrichtigt den antragsteller"])
    rows = [(1, en), (2, None), (3, ""), (4, "short text"), (5, mixed), (6, text(3, rng, 20_000)), (1, en), (7, "12 " * 60), (8, "das amt prüft die angaben " * 12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as lang", "1 as reading_level")
    got = {r.doc_id: r.reading_level for r in R.reading_levels(df, model, fitted()).collect()}
    assert got == {1: 1, 6: 3}
    assert R.reading_levels(df.limit(0), model, fitted()).count() == 0


def test_fit_of_nothing(spark):
    m = R.fit_from_table(spark.createDataFrame([(1, None, None, None)], "sample_id bigint, lang string, reading_level int, text string"))
    assert m.level("en", "any words") is None
