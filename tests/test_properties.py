"""Properties over generated inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sifterra.functions import text, url
from sifterra.functions.html import read_html
from sifterra.functions.script import LegacyFont
from sifterra.operators.chunking import backward_chunks
from sifterra.operators.metrics import _chrf, _rouge_l, lcs_length

words = st.text(alphabet="ab क।.!? \n", max_size=900)


@given(words, st.integers(60, 300), st.integers(0, 50))
def test_backward_chunks_move_on_and_reach_the_end(t, target, overlap):
    spans = [(a, b) for a, b, _ in backward_chunks(t, target, overlap, 0)]
    assert all(x < y for (x, _), (y, _) in zip(spans, spans[1:])) and all(a < b for a, b in spans)
    assert not t or spans[-1][1] == len(t)
    assert all(a2 <= b1 for (_, b1), (a2, _) in zip(spans, spans[1:]))


@given(st.text(alphabet="abc ", max_size=40), st.text(alphabet="abc ", max_size=40))
def test_metrics_are_bounded_and_whole_on_equals(a, b):
    assert 0 <= _chrf(a, b) <= 100.0001 and 0 <= _rouge_l(a.split(), b.split()) <= 1
    if a:
        assert abs(_chrf(a, a) - 100) < 1e-9


@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), max_size=40))
def test_lcs_equals_the_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    assert lcs_length(a, b) == row[-1]


@given(st.text(max_size=300))
def test_html_reader_never_fails(t):
    assert isinstance(read_html(t), str)


@given(st.text(alphabet="abcd नम", max_size=60))
def test_a_font_without_rules_changes_nothing(t):
    assert LegacyFont({}).convert(t) == t and LegacyFont({}).convert_mixed(t) == t


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAB/?&=#.%12-_:", max_size=60), min_size=1, max_size=60))
def test_canonicalising_is_idempotent(spark, tails):
    df = spark.createDataFrame([("https://E.example/" + t,) for t in tails], "u string")
    c = url.canonical_url(F.col("u"))
    assert df.select(c.alias("u")).select((url.canonical_url(F.col("u")) == F.col("u")).alias("ok")).where("not ok").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(words, min_size=1, max_size=40))
def test_squeezing_is_idempotent_and_tokens_are_clean(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    s = text.squeeze(F.col("t"))
    assert df.select(s.alias("t")).where(text.squeeze(F.col("t")) != F.col("t")).count() == 0
    toks = df.select(F.explode(text.index_tokens(F.col("t"))).alias("w"))
    assert toks.where(F.length("w") < 2).count() == 0 and toks.where(F.col("w").rlike("[^a-z0-9ऀ-ॿ]")).count() == 0
