import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from sifterra.llm import encoding as E

NE = "वडा नम्बर १८ का बासिन्दाले सहायता कक्षबाट पनि यो सेवा लिन सक्छन् । शाखा अधिकृत ले विवरण जाँच गरी जानकारी दिन्छन् ।"
DE = "Das Führungszeugnis für Frau Müller – “geprüft” – ist später gültig."
EN = "Mr müller’s résumé was returned. The fee is €12 or £10. See §§ 4–6 and note ©. São tomé, Façade, à jour."


@pytest.fixture(scope="module")
def repairer():
    words, pairs = {}, {}
    for t in (NE, DE, EN):
        toks = t.split()
        for w in toks:
            words[w] = words.get(w, 0) + 20
        for a, b in zip(toks, toks[1:]):
            pairs[a, b] = 20
    return E.Repairer(E.WordModel(words, pairs))


def wrong(text, codec):
    return "".join(bytes([b]).decode(codec) if not (codec == "cp1252" and b in (0x81, 0x8D, 0x8F, 0x90, 0x9D)) else chr(b) for b in text.encode())


@pytest.mark.parametrize("codec", ["cp1252", "mac_roman", "cp437", "latin-1"])
@pytest.mark.parametrize("text", [NE, DE])
def test_exact_round_trip(repairer, text, codec):
    got = repairer.repair(wrong(text, codec))
    assert got["restored"] == text and got["codecs"]


def test_double_encoding_round_trip(repairer):
    got = repairer.repair(wrong(wrong(NE, "cp1252"), "cp1252"))
    assert got["restored"] == NE and got["codecs"].count(">") == 1


def test_cp1251_with_a_lost_byte(repairer):
    broken = NE.encode().decode("cp1251", errors="replace")
    got = repairer.repair(broken)
    same = sum(a == b for a, b in zip(got["restored"].split(), NE.split()))
    assert same >= 0.8 * len(NE.split())


def test_part_of_a_field(repairer):
    text = NE + " " + wrong(NE, "cp1252")
    assert repairer.repair(text)["restored"] == NE + " " + NE


@pytest.mark.parametrize("text", [NE, DE, EN, "", None, "How much? What now?", "के के चाहिन्छ ?", "plain ascii", "see https://a.example/?q=1", "Ângela’s file was à jour."])
def test_sound_texts(repairer, text):
    assert repairer.repair(text) is None


def test_legacy_font_text_is_no_case(repairer):
    t = "u'/fI' kfTF yTÚT ÔB*' /mvdKm FfEPT GÚlfiPTfNt /Ú bBSBÔB/ *B *fTPMf/MFf GFM dfW'ANA'PK Ô"
    assert E.looks_legacy(t) and not E.looks_legacy(NE) and not E.looks_legacy(EN)
    assert repairer.repair(t, True) is None


def test_lost_letters_are_restored_from_the_corpus(repairer):
    toks = NE.split()
    rng = random.Random(4)
    right = total = 0
    for i, w in enumerate(toks):
        if len(w) < 4:
            continue
        broken = list(toks)
        j = rng.randrange(1, len(w) - 1)
        broken[i] = w[:j] + "�" * 3 + w[j + 1 :]
        got = repairer.repair(" ".join(broken))
        assert got["damaged_words"] == 1
        total += 1
        right += got["restored"].split()[i] == w
    assert right / total > 0.9
    asked = list(toks)
    asked[3] = "?" * len(toks[3])
    assert repairer.repair(" ".join(asked))["restored"].split()[3] == toks[3]


@pytest.mark.parametrize("text", ["The caf? beside the gate sells forms.", "The fee is ?12 or ?10.", "Mr m?ller?s note", "between 2 and 8 o?clock"])
def test_letters_lost_to_question_marks(repairer, text):
    assert repairer.repair(text) is not None


def test_operator_on_odd_rows(spark):
    rows = [(1, NE, wrong(NE, "cp1252"), ("f", wrong(DE, "mac_roman"), 1.0, 1)), (2, None, "", None), (3, NE, NE, (None, None, None, None)), (1, NE, wrong(NE, "cp1252"), ("f", wrong(DE, "mac_roman"), 1.0, 1)), (4, "", NE, ("f", NE * 300, 0.5, None))]
    cv = spark.createDataFrame(rows * 3, "cv_id bigint, preview_before string, preview_after string, best_effort struct<font:string,text:string,devanagari_ratio:double,nepali_word_hits:bigint>").selectExpr("*", "1 as field_name", "'z' as text")
    fields = E.field_table(cv)
    out = E.garbled_fields(fields).select("cv_id", "field_name", "restored").distinct().collect()
    assert {(r.cv_id, r.field_name) for r in out} == {(1, "preview_after"), (1, "best_effort_text")}
    assert {r.restored for r in out} == {NE, DE}
    empty = E.field_table(cv.limit(0))
    assert E.garbled_fields(empty).count() == 0


@pytest.mark.parametrize("lost", [1, 2, 3])
def test_several_lost_bytes_in_one_sequence(repairer, lost):
    garbled = wrong("सक्छन्", "cp1252")
    for at in range(1, 3):
        broken = garbled[:at] + "\ufffd" * min(lost, 3 - at) + garbled[at + min(lost, 3 - at) :]
        got = repairer.repair("लिन " + broken + " ।")
        assert got["codecs"] == "cp1252" and got["restored"] == "लिन सक्छन् ।", broken


@pytest.mark.parametrize("times", [1, 3, 4, 6])
def test_wrong_decodings_are_undone_until_none_is_left(repairer, times):
    text = NE
    for _ in range(times):
        text = wrong(text, "latin-1")
    got = repairer.repair(text)
    assert got["restored"] == NE and got["codecs"].count(">") == times - 1


def test_two_codecs_in_one_text(repairer):
    got = repairer.repair(wrong(NE, "mac_roman") + "\n" + wrong(DE, "cp437") + " " + EN)
    assert got["restored"] == NE + "\n" + DE + " " + EN


def test_code_points_by_brute_force():
    for lead, rest in [(0xC3, (-2,)), (0xE0, (-2, -2)), (0xE0, (0xA4, -2)), (0xE2, (-2, 0x94)), (0xF0, (0x9F, -2, 0x80))]:
        want = []
        for mid in itertools.product(*[range(0x80, 0xC0) if b == -2 else [b] for b in rest]):
            try:
                c = bytes([lead, *mid]).decode()
            except UnicodeDecodeError:
                continue
            if E._plausible(ord(c)):
                want.append(ord(c))
        assert E._code_points(lead, rest) == sorted(want)


def test_the_builtin_filter_passes_every_damaged_text(spark, repairer):
    texts = [wrong(t, c) for t in (NE, DE, EN) for c in ("cp1252", "mac_roman", "cp437", "latin-1")] + [NE, DE, EN, "", None, "The caf? beside the gate", "a ?? b", "m?ller", "x\ufffdy", "How? yes", "à¤ ", "ð\u009f\u0098\u0080"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", E.suspect(F.col("t")).alias("s")).collect()
    for r in got:
        assert r.s or repairer.repair(texts[r.i]) is None, texts[r.i]
    assert not any(r.s for r in got if texts[r.i] in (NE, "", None))


def test_shards_give_the_same_rows(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        toks = rng.sample(NE.split(), 8)
        toks[rng.randrange(8)] = "\ufffd" * rng.randrange(1, 6)
        rows.append((i, "f", " ".join(toks)))
        rows.append((i, "g", NE))
    fields = spark.createDataFrame(rows, "cv_id bigint, field_name string, text string")
    one = sorted(map(tuple, E.garbled_fields(fields).collect()))
    assert len(one) == 60 and one == sorted(map(tuple, E.garbled_fields(fields, model_words=9).collect()))


def brute_repair(model, text, margin=math.log(3.0)):
    """All ways through all corpus words of every damaged place."""
    tokens = text.split()
    damaged = {i for i, t in enumerate(tokens) if E.damaged_token(t)}

    def fits(token, w):
        n = len(token)
        parts = re.findall(f"[{E.LOST}]+|.", token)
        return re.fullmatch("".join(f".{{1,{len(x)}}}" if x[0] in E.LOST else "." if x == "?" else re.escape(x) for x in parts), w) and len(w) <= n

    layers = [[w for w in model.words if fits(t, w)] or [t] if i in damaged else [t] for i, t in enumerate(tokens)]
    best = max(itertools.product(*layers), key=lambda p: sum(model.step(a, b) for a, b in zip((None, *p), p)))
    out = list(tokens)
    for i in damaged:
        value = lambda w: model.step(best[i - 1] if i else None, w) + (model.step(w, best[i + 1]) if i + 1 < len(best) else 0.0)  # noqa: E731, B023
        ranked = sorted(map(value, layers[i]), reverse=True)
        if best[i] != tokens[i] and (len(ranked) == 1 or ranked[0] == value(best[i]) and ranked[0] >= ranked[1] + margin):
            out[i] = best[i]
    return " ".join(out)


@pytest.mark.parametrize("seed", range(4))
def test_repair_against_brute_force(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 4]))) for _ in range(60)})
    model = E.WordModel(dict(zip(words, rng.sample(range(2, 3000), len(words)))), {})
    model = E.WordModel(model.words, {(a, b): n for (a, b), n in zip({(rng.choice(words), rng.choice(words)) for _ in range(300)}, rng.sample(range(2, 900), 300))})
    restored = 0
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(6)).split()
        start = rng.randrange(6)
        for i in range(start, min(6, start + rng.choice([1, 1, 2]))):
            text[i] = rng.choice(["\ufffd" * 3, "\ufffd", "\ufffd" * 2 + text[i][-1], text[i][0] + "\ufffd" * 2, "??", "???"])
        got = model.repair(" ".join(text))[0]
        assert got == brute_repair(model, " ".join(text)), text
        restored += got.split() != text
    assert restored > 5


def test_short_words_do_not_crowd_out_long_ones():
    words = {chr(0x3400 + i): 50 for i in range(100)} | {"x" + chr(0x3400 + i): 50 for i in range(200)}
    assert E.WordModel(words | {"office": 100_000}, {}).repair("\ufffd" * 6)[0] == "office"
    near = E.WordModel(words | {"the": 500, "ab": 500} | {"office": 90_000, "court": 80_000}, {("the", "ab"): 200})
    assert near.repair("the " + "\ufffd" * 6)[0] == "the ab"
    # The best of the shortest words leads those, but not the longer ones.
    assert E.WordModel(words | {"ab": 1000, "office": 900}, {}).repair("\ufffd" * 6)[0] == "\ufffd" * 6
