import random

import pytest

from sifterra.llm import language as L

STEMS = {
    "en": "the office asks every person to bring a copy of the form and the fee is paid at the counter before noon".split(),
    "de": "das amt prüft die angaben und benachrichtigt den antragsteller wenn der reisepass für die reise fertig ist".split(),
    "ne": "कार्यालय ले निवेदनसँगै प्रतिलिपि पेश गर्न भनेको छ र रसिद काम नसकिएसम्म राख्नुपर्छ सेवा लिन सक्नुहुन्छ".split(),
    "hi": "यह काम कार्यालय में किया जाता है और रसीद वहीं मिलती है लेकिन बहुत भीड़ रहती है के लिए आवेदन".split(),
    "ne-Latn": "karyalay le niwedanasangai pratilipi pesh garn bhaneko chha ra rasid kam nasakiesamm rakhnuparchha sewa".split(),
}


def sample(lang, n, rng):
    return " ".join(rng.choice(STEMS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    rows = [(sample(lang, 12, rng), lang) for lang in STEMS for _ in range(60)]
    # a tenth of the labels is wrong
    rows = [(t, rng.choice(list(STEMS)) if rng.random() < 0.1 else lang) for t, lang in rows]
    return L.train(rows)


def test_held_out_accuracy_and_calibration(model):
    rng = random.Random(2)
    ok = []
    for lang in STEMS:
        for _ in range(40):
            got, conf = model.classify(sample(lang, 8, rng))
            assert 0 < conf <= 1
            ok.append(got == lang)
    assert sum(ok) / len(ok) >= 0.97


def test_logits_are_additive_over_words(model):
    text = "the office asks every person"
    whole = model.logits(text)
    sums = [model.words[w] for w in text.split()]
    n = sum(s[-2] for s in sums)
    again = [(b + sum(s[i] for s in sums) * model.scale / n) / model.temperature for i, b in enumerate(model.bias)]
    assert whole == pytest.approx(again)


@pytest.mark.parametrize(
    "label,want",
    [("en-US", "en"), ("EN", "en"), ("en_GB", "en"), ("eng", "en"), ("English", "en"), ("ne-NP", "ne"), ("np", None), ("x-default", None), ("ne-latn", "ne-Latn"), ("NE-LATN", "ne-Latn"), ("", None), (None, None), (" ", None), ("ger", "de"), ("und", None), ("sa", None), ("es-419", None), ("hi-IN", "hi"), ("ne-Deva", None)],
)
def test_labels(label, want):
    assert L.named_language(label) == want


def test_records_and_segments(spark, model):
    rng = random.Random(3)
    mixed = "\n".join([sample("en", 8, rng), sample("ne", 20, rng), "kya"])
    rows = [(1, mixed, "en"), (2, sample("de", 9, rng), "de-DE"), (3, None, "en"), (4, "  \n ", "en"), (5, "123 456 ...", "en"), (6, sample("hi", 5000, rng), None), (2, sample("de", 9, rng), "de-DE"), (None, sample("de", 9, rng), "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "'x' as rec_key", "1 as seg_no", "2 as confidence")
    got = {(r.rec_key, r.seg_no): r for r in L.label_records(df, model, "doc", "doc_id", "text", "lang").collect()}
    assert got["doc:1", 0].lang == "ne" and not got["doc:1", 0].label_ok
    assert got["doc:1", 1].lang == "en" and got["doc:1", 2].lang == "ne" and ("doc:1", 3) not in got
    assert got["doc:2", 0].label_ok and got["doc:6", 0].lang == "hi" and not got["doc:6", 0].label_ok
    assert not any(k[0] in ("doc:3", "doc:4", "doc:5") for k in got)
    assert L.label_records(df.limit(0), model, "doc", "doc_id", "text", "lang").count() == 0


def test_fit_survives_an_empty_table(spark):
    m = L.fit_language_model(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert m.classify("the office") is None or m.classify("the office")[0] in L.LANGUAGES


def test_main_language_ties():
    assert L.main_language({"en": 3, "de": 3}, {"en": 2.0, "de": 2.9})[0] == "de"
    assert L.main_language({"en": 3, "de": 3}, {"en": 2.0, "de": 2.0})[0] == "de"
    assert L.main_language({}, {}) is None
