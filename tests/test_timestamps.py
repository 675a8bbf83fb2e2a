import datetime as dt

import pytest
from pyspark.sql import functions as F

from sifterra.operators.timestamps import normalise_timestamps

SOURCES = "source_id string, tz_name string, date_order string"
REG = [("ktm", "Asia/Kathmandu", "dmy"), ("ny", "America/New_York", "mdy"), ("ldn", "Europe/London", "dmy"), ("syd", "Australia/Sydney", "dmy"), ("none", None, None)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, source_id string, v string")
    out = normalise_timestamps(df, spark.createDataFrame(REG, SOURCES), ["v"])
    return {r.doc_id: r for r in out.collect()}


def at(*a):
    return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())


CASES = [
    ("ktm", "2020-03-11", at(2020, 3, 10, 18, 15)),
    ("ktm", "07/04/2024 02:55", at(2024, 4, 6, 21, 10)),
    ("ny", "07/04/2024 02:55", at(2024, 7, 4, 6, 55)),
    ("ktm", "२०२१-०६-१५ १५:३०", at(2021, 6, 15, 9, 45)),
    ("ktm", "१९ अक्टोबर २०२१", at(2021, 10, 18, 18, 15)),
    ("ktm", "Tue, 15 Aug 2023 17:25:32 +0545", at(2023, 8, 15, 11, 40, 32)),
    ("ldn", "2022-09-25 11:41:19 BST", at(2022, 9, 25, 10, 41, 19)),
    ("ktm", "1664448843416", 1664448843),
    ("ktm", "1675063532", 1675063532),
    ("none", "1675063532", 1675063532),
    ("ny", "February 25, 2021 12:25 PM", at(2021, 2, 25, 17, 25)),
    ("ny", "February 25, 2021 12:25 AM", at(2021, 2, 25, 5, 25)),
    ("ktm", "20220721T105606Z", at(2022, 7, 21, 10, 56, 6)),
    ("ktm", "  2020-01-01T00:00:00.999Z ", at(2020, 1, 1)),
    ("ny", "2022-11-06 01:30:00", at(2022, 11, 6, 5, 30)),  # occurs twice: the earlier instant
    ("ny", "2022-03-13 02:30:00", at(2022, 3, 13, 7, 30)),  # skipped: the offset before the change
    ("syd", "2021-10-31 00:40:29 AEDT", at(2021, 10, 30, 13, 40, 29)),
]


def test_values(spark):
    got = run(spark, [(str(i), s, v) for i, (s, v, _) in enumerate(CASES)])
    for i, (_, v, want) in enumerate(CASES):
        assert got[str(i)].epoch_s == want, v
        assert got[str(i)].status == "resolved"


@pytest.mark.parametrize("value", [None, "", "  ", "N/A", "TBD", "yesterday", "3 days ago", "हिजो", "31/02/2022", "0000-00-00", "2081/06/29", "२०७८.०५.०३", "see notice", "2022-13-45", "99:99"])
def test_no_instant(spark, value):
    r = run(spark, [("a", "ktm", value)])["a"]
    assert r.epoch_s is None and r.status == "unreadable"


def test_canonical_unknown_zone_and_order(spark):
    got = run(spark, [("a", "ktm", "2020-01-01T00:00:00Z"), ("b", "none", "2020-01-01 10:00"), ("c", "ny", "25/08/2020"), ("d", None, "2020-01-01"), ("e", "none", "2020-01-01 10:00:00 UTC")])
    assert got["a"].status == "canonical" and got["b"].status == "no_zone" and got["b"].epoch_s is None
    assert got["c"].status == "ambiguous" and got["c"].epoch_s is None  # one date against the source's order
    assert got["d"].status == "no_zone" and got["e"].epoch_s == at(2020, 1, 1, 10)


def test_em_resolves_an_order_that_nobody_states(spark):
    rows = [(f"k{i}", "s", f"{13 + i % 15}/0{1 + i % 9}/2021 10:00 UTC") for i in range(60)] + [("q", "s", "05/06/2021 10:00 UTC")]
    got = run(spark, rows)
    assert got["q"].epoch_s == at(2021, 6, 5, 10) and got["q"].fmt == "dmy" and got["q"].posterior > 0.9
    lone = run(spark, [("q", "t", "05/06/2021 10:00 UTC")])["q"]
    assert lone.status == "ambiguous" and lone.epoch_s is None


def test_em_outweighs_a_wrong_order_but_not_by_a_few_dates(spark):
    against = [(f"k{i}", "ny", f"{13 + i % 15}/0{1 + i % 9}/2021 10:00 UTC") for i in range(80)]
    got = run(spark, against + [("q", "ny", "05/06/2021 10:00 UTC")])
    assert got["k3"].epoch_s == at(2021, 4, 16, 10) and got["k3"].status == "resolved" and 0.9 < got["k3"].posterior < 1
    assert got["q"].posterior < 1 and got["q"].fmt == "dmy"
    few = run(spark, against[:1] + [(f"m{i}", "ny", f"0{1 + i % 9}/{13 + i % 15}/2021 10:00 UTC") for i in range(80)] + [("q", "ny", "05/06/2021 10:00 UTC")])
    assert few["k0"].status == "ambiguous" and few["k0"].epoch_s is None and few["k0"].posterior < 0.9
    assert few["q"].epoch_s == at(2021, 5, 6, 10) and few["q"].fmt == "mdy" and 0.9 < few["q"].posterior < 1


def test_em_against_the_likelihood():
    """The weights that EM ends with are a maximum of the likelihood under the prior counts."""
    import math

    from sifterra.operators import timestamps as T

    sets, counts = [("dmy",), ("dmy", "mdy"), ("mdy",), ("iso",)], [40, 30, 3, 50]
    got = dict(zip(sets, T.format_posteriors(sets, counts, None, 300)))
    # The posterior of the ambiguous set gives the share of dmy among the numeric dates back; the ambiguous ones say nothing about it.
    fit = lambda share: 41 * math.log(share) + 4 * math.log(1 - share)
    assert got["dmy", "mdy"][0] == "dmy" and abs(got["dmy", "mdy"][1] - max((i / 10_000 for i in range(1, 10_000)), key=fit)) < 0.002


@pytest.mark.parametrize(
    "value,want",
    [("2016-12-31T23:59:60Z", at(2017, 1, 1)), ("2020-01-01T00:00:00." + "1" * 200 + "Z", at(2020, 1, 1)), ("31536000000", at(1971, 1, 1)), ("1577836800000000000", at(2020, 1, 1)), ("2020-01-01T00:00:61Z", None)],
)
def test_leap_seconds_long_fractions_and_precisions(spark, value, want):
    assert run(spark, [("d", "none", value)])["d"].epoch_s == want


def test_empty_table_extra_columns_and_repeats(spark):
    reg = spark.createDataFrame(REG, SOURCES)
    empty = spark.createDataFrame([], "doc_id string, source_id string, v string, key string, status string")
    assert normalise_timestamps(empty, reg, ["v"]).count() == 0
    df = spark.createDataFrame([("a", "ktm", "2020-01-01", "x", "y")] * 3, "doc_id string, source_id string, v string, key string, status string")
    out = normalise_timestamps(df, reg.withColumn("v", F.lit(1)), ["v"])
    assert out.count() == 3 and out.distinct().count() == 1
    long = spark.createDataFrame([("a", "ktm", "9" * 100_000)], "doc_id string, source_id string, v string")
    assert normalise_timestamps(long, reg, ["v"]).first().status == "unreadable"


@pytest.mark.parametrize(
    "source,value,want",
    [
        ("ktm", "1962-05-01", at(1962, 4, 30, 18, 30)),  # Kathmandu was 5:30 ahead until 1986
        ("ldn", "11/11/1918 11:00", at(1918, 11, 11, 11)),
        ("none", "1950-01-01T00:00:00Z", at(1950, 1, 1)),
        ("ny", "July 4, 1776 12:00 UTC", at(1776, 7, 4, 12)),
        ("none", "0001-01-02T00:00:00Z", at(1, 1, 2)),
        ("none", "1969-12-31T23:59:59Z", -1),
    ],
)
def test_dates_before_1970_are_instants(spark, source, value, want):
    r = run(spark, [("d", source, value)])["d"]
    assert r.epoch_s == want and r.status in ("resolved", "canonical")
