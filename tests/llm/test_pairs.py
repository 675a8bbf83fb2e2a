import pytest

from sifterra.llm import pairs as P
from tests.llm.test_language import model  # noqa: F401

Q = "What is the fee for land transfer in Kotgaun?"
A = "The office asks every person to bring a copy of the form before noon."


@pytest.mark.parametrize(
    "answer,want",
    [
        (None, "empty"), ("", "empty"), (" \n\t ", "empty"), ("—", "empty"), ("[S1][S2]", "empty"), ("<answer></answer>", "empty"), ("...", "empty"), ("​", "empty"),
        ("The office asks every person to bring a", "truncated"), ("The office asks every person. The fee is paid at the counter (see", "truncated"), ("The office asks every per [S1]", "truncated"),
        (A, None), (A + " [S3]", None), (A + "\n1. Copy of the form\n2. Fee: Rs. 300", None), ("The fee is 300 rupees.", None),
        (Q, "copies_question"), (Q.upper(), "copies_question"), ("Question: " + Q, "copies_question"), (Q + " " + Q, "copies_question"), ('"' + Q[:-1] + '"', "copies_question"),
        (Q[:-1] + " — " + A, None), ("I'm sorry, but I can't help with that request.", "refusal"), ("I’m sorry, but I can’t help with that request.", "refusal"),
        ("No relevant source was found; I must decline to answer. As an assistant I am not able to give advice on this matter.", "refusal"), ("माफ गर्नुहोस्, म यस प्रश्नको उत्तर दिन सक्दिनँ ।", "refusal"),
        ("Sorry for the long queue at the office, but the steps are easy. " + A, None), ("das amt prüft die angaben und benachrichtigt den antragsteller.", "other_language"),
    ],
)
def test_defects(model, answer, want):  # noqa: F811
    assert P.defect_of(Q, answer, None, False, model, P.Refusals()) == want


UNSEEN = """I refuse to answer.
Sorry, I can't comment on that topic.
I'm not able to help with that.
As an AI, I cannot provide legal advice.
I won't answer that question.
Das kann ich leider nicht beantworten.
म यसमा सहयोग गर्न सक्दिनँ।
मैं इसमें मदद नहीं कर सकता।
I'd rather not say.
We are unable to process this request.
Unfortunately, I do not have information on this.
I must decline to answer this.""".split("\n")
NOT_REFUSING = """You cannot apply online, please visit the office.
I cannot find the fee in the notice, but the office charges Rs 200 for each copy of the form.
The office will not process late forms.
The clerk said that she cannot help without the receipt, so keep it with the form until the end.""".split("\n")


def test_refusals_in_wordings_of_no_template():
    r = P.Refusals()
    says = lambda x: r.refuses(P.tokens(x)) or r.declines(x, P.tokens(x))
    assert sum(map(says, UNSEEN)) >= 0.8 * len(UNSEEN)
    assert not [x for x in NOT_REFUSING if says(x)]


@pytest.mark.parametrize("times", [1, 2, 3, 5, 8, 40])
def test_a_question_repeated_any_number_of_times_is_a_copy(model, times):  # noqa: F811
    assert P.defect_of(Q, " ".join([Q] * times), None, False, model, P.Refusals()) == "copies_question"


def test_language_asked_for_and_allowed_refusals(model):  # noqa: F811
    r = P.Refusals()
    ne = "कार्यालय ले निवेदनसँगै प्रतिलिपि पेश गर्न भनेको छ ।"
    assert P.defect_of(Q, ne, "ne", False, model, r) is None and P.defect_of(Q, ne, None, False, model, r) == "other_language"
    assert P.defect_of(Q, "karyalay le niwedanasangai pratilipi pesh garn bhaneko chha.", "ne", False, model, r) is None
    assert P.defect_of(Q, "I cannot answer this question based on the provided sources.", None, True, model, r) is None
    assert P.defect_of(None, A, None, False, model, r) is None


def test_lcs_against_brute_force():
    import itertools
    import random

    rng = random.Random(1)
    for _ in range(50):
        a, b = [[rng.choice("abc") for _ in range(rng.randint(0, 7))] for _ in range(2)]
        brute = max((n for n in range(len(a) + 1) for c in itertools.combinations(a, n) if _is_subsequence(c, b)), default=0)
        assert P.lcs_length(a, b) == brute


def _is_subsequence(c, b):
    it = iter(b)
    return all(x in it for x in c)


def test_chat_pairs_take_the_nearest_earlier_user_turn(spark):
    rows = [(1, 1, "user", "q1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a"), (1, 4, "assistant", "b"), (2, 1, "assistant", "orphan"), (1, 3, "assistant", "a"), (3, 5000, "user", None), (3, 9001, "assistant", "c"), (None, 1, "user", "x"), (None, 2, "assistant", "x"), (4, None, "assistant", "y")]
    t = spark.createDataFrame(rows, "conv_id bigint, turn_no int, role string, content string").selectExpr("*", "1 as asked", "2 as question")
    got = {r.pair_key: r.question for r in P.chat_pairs(t).collect()}
    assert got == {"chat:1:3": "q2", "chat:1:4": "q2", "chat:3:9001": None}


def test_operator_on_odd_rows(spark, model):  # noqa: F811
    s = "result_id bigint, kind string, question string, model_output string, response_language string"
    df = spark.createDataFrame([(1, "grounded", Q, None, None), (2, None, None, A, " "), (1, "grounded", Q, None, None), (3, "refusal", Q, "I must decline to answer. " * 5000, None)], s).selectExpr("*", "1 as answer", "1 as defect")
    df = df.unionByName(spark.createDataFrame([(None, "grounded", Q, A, None)], s).selectExpr("*", "1 as answer", "1 as defect"))
    got = {r.pair_key: r.defect for r in P.pair_defects(P.smoke_pairs(df), model).collect()}
    assert got["smoke:1"] == "empty" and got["smoke:2"] is None and len(got) == 3
    assert P.pair_defects(P.smoke_pairs(df.limit(0)), model).count() == 0


def test_a_question_repeated_any_number_of_times_is_a_copy():
    q = "How much is the fee for a land transfer at the ward office".split()
    for times in (5, 6, 40, 2_000):
        assert P.is_copy(q, q * times) and P.is_copy(q, q * times + q[:5]), times
    assert not P.is_copy(q, q + "It is ten rupees and you pay it at the desk".split() * 8)
    assert not P.is_copy(q, q[:6] * 40)
    assert not P.is_copy(q, q[:1] * 5_000)
