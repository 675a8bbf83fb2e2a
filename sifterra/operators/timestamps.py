"""Normalise timestamps written in many formats, precisions and zones to one UTC instant.

A mixture of formats is fitted per source by expectation-maximisation. Each value counts under
every format that can parse it; the posterior of a source's formats picks the interpretation. A stated
order of numeric dates is prior evidence: many dates that contradict it outweigh it, few stay unresolved.
Everything but the small per-source fit runs as built-in expressions inside Catalyst.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifterra.session import broadcast_if_small, materialize

# Month names, English and Nepali.
MONTHS_EN = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_NE = ["जनवरी", "फेब्रुअरी", "मार्च", "अप्रिल", "मे", "जुन", "जुलाई", "अगस्ट", "सेप्टेम्बर", "अक्टोबर", "नोभेम्बर", "डिसेम्बर"]

# Zone abbreviations as (abbreviation, zone that uses it, offset in minutes). "*" holds where the source's own zone has no such abbreviation.
ABBREVIATIONS = [
    ("NPT", "*", 345),
    ("IST", "*", 330), ("IST", "Asia/Jerusalem", 120), ("IST", "Europe/Dublin", 60),
    ("JST", "*", 540), ("KST", "*", 540), ("PKT", "*", 300), ("SGT", "*", 480), ("HKT", "*", 480),
    ("BST", "*", 60), ("BST", "Asia/Dhaka", 360),
    ("WET", "*", 0), ("WEST", "*", 60), ("CET", "*", 60), ("CEST", "*", 120), ("EET", "*", 120), ("EEST", "*", 180), ("MSK", "*", 180),
    ("EST", "*", -300), ("EST", "Australia/Sydney", 600), ("EDT", "*", -240), ("EDT", "Australia/Sydney", 660),
    ("CST", "*", -360), ("CST", "Asia/Shanghai", 480), ("CDT", "*", -300), ("MST", "*", -420), ("MDT", "*", -360), ("PST", "*", -480), ("PDT", "*", -420),
    ("AEST", "*", 600), ("AEDT", "*", 660), ("ACST", "*", 570), ("ACDT", "*", 630), ("AWST", "*", 480), ("NZST", "*", 720), ("NZDT", "*", 780),
    ("GST", "*", 240), ("AST", "*", -240), ("AST", "Asia/Qatar", 180), ("AST", "Asia/Riyadh", 180),
    ("GMT", "*", 0), ("UTC", "*", 0), ("Z", "*", 0), ("UT", "*", 0),
]

#: Years beyond it belong to the Bikram Sambat calendar and name no instant here.
LAST_YEAR = 2070
#: The first that a timestamp can be made of and that zones have rules for; 0000 is a placeholder.
FIRST_YEAR = 1
#: No timestamp is longer.
LONGEST = 100

_ZONE = r"(Z|z|UTC|GMT|UT|[+-][0-9]{2}:?[0-9]{2}|[+-][0-9]{2}|[A-Za-z]{2,5})?"
_CLOCK = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,][0-9]+)?)?\s*([AaPp]\.?[Mm]\.?)?"
_YEAR_FIRST = rf"^([0-9]{{4}})([-/.])([0-9]{{1,2}})[-/.]([0-9]{{1,2}})(?:(?:[Tt]|,?\s+){_CLOCK}\s*{_ZONE})?$"
_COMPACT = rf"^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})(?:[Tt]?([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})?\s*{_ZONE})?$"
_NUMERIC = rf"^([0-9]{{1,2}})([-/.])([0-9]{{1,2}})[-/.]([0-9]{{4}})(?:(?:[Tt]|,?\s+){_CLOCK}\s*{_ZONE})?$"
_DAY_NAME = r"(?:[A-Za-z]{3,9},?\s+)?"
_DAY_MONTH = rf"^{_DAY_NAME}([0-9]{{1,2}})\s+#([0-9]{{1,2}})#,?\s+([0-9]{{4}})(?:(?:[Tt]|,?\s+){_CLOCK}\s*{_ZONE})?$"
_MONTH_DAY = rf"^{_DAY_NAME}#([0-9]{{1,2}})#\s+([0-9]{{1,2}}),?\s+([0-9]{{4}})(?:(?:[Tt]|,?\s+){_CLOCK}\s*{_ZONE})?$"
CANONICAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def _tidy(value: Column) -> Column:
    """Trimmed, ASCII digits, month names as #n#."""
    v = F.trim(F.regexp_replace(value, r"[ \s]+", " "))
    v = F.translate(v, "०१२३४५६७८९", "0123456789")
    return F.regexp_replace(v, r"([.,][0-9]{9})[0-9]+", "$1")  # so that no fraction makes a timestamp long


def _number_months(v: Column) -> Column:
    """Month names as #n#; values without a word of three letters pass untouched."""
    ne = en = v
    for i, name in enumerate(MONTHS_NE, 1):
        ne = F.regexp_replace(ne, rf"(?<![ऀ-ॿ]){name}(?![ऀ-ॿ])", f"#{i}#")
    for i, name in enumerate(MONTHS_EN, 1):
        en = F.regexp_replace(en, rf"(?i)\b{name}[a-z]*\.?(?![a-z0-9])", f"#{i}#")
    return F.when(v.rlike("[ऀ-ॿ]{2}"), ne).when(v.rlike("^(?:[A-Za-z]{3}|[0-9]{1,2} +[A-Za-z]{3})"), en).otherwise(v)


#: Format, pattern, and the groups of year, month, day, hour, minute, second, half of day and zone (0: none).
FORMATS = [
    ("year_first", _YEAR_FIRST, (1, 3, 4, 5, 6, 7, 8, 9)),
    ("compact", _COMPACT, (1, 2, 3, 4, 5, 6, 0, 7)),
    ("dmy", _NUMERIC, (4, 3, 1, 5, 6, 7, 8, 9)),
    ("mdy", _NUMERIC, (4, 1, 3, 5, 6, 7, 8, 9)),
    ("day_month", _DAY_MONTH, (3, 2, 1, 4, 5, 6, 7, 8)),
    ("month_day", _MONTH_DAY, (3, 1, 2, 4, 5, 6, 7, 8)),
]
_EPOCH = r"^(?:[0-9]{9,13}|[0-9]{15,16}|[0-9]{18,19})$"


def _matches(v: Column) -> Column:
    """Formats whose pattern a value fits, each with its parts in one order. One replacement takes all groups at once."""
    fits = []
    for fmt, pattern, groups in FORMATS:
        parts = "|".join(f"${g}" if g else "" for g in groups)
        fits.append(F.when(v.rlike(pattern), F.struct(F.lit(fmt).alias("fmt"), F.split(F.regexp_replace(v, pattern, parts), r"\|").alias("p"))))
    return F.array_compact(F.array(*fits))


def _wall(x: Column) -> Column:
    """Format, year, seconds since 1970 of the wall time as if it were UTC, and zone; null for impossible dates and times."""
    p = x["p"]
    num = lambda i: p[i].try_cast("int")
    half = F.lower(F.substring(p[6], 1, 1))
    raw = F.coalesce(num(3), F.lit(0))
    hour = F.when(half == "p", raw % 12 + 12).when(half == "a", raw % 12).otherwise(raw)
    day = F.try_make_timestamp(num(0), num(1), num(2), F.lit(0), F.lit(0), F.lit(0.0))
    minute, second = F.coalesce(num(4), F.lit(0)), F.coalesce(num(5), F.lit(0))
    good = num(0).between(FIRST_YEAR, LAST_YEAR) & (raw <= 23) & ((half == "") | raw.between(1, 12)) & (minute <= 59) & (second <= 60)
    return F.when(good & day.isNotNull(), F.struct(x["fmt"].alias("fmt"), (F.unix_seconds(day) + hour * 3600 + minute * 60 + second).alias("wall"), p[7].alias("zone")))


def _epochs(v: Column) -> Column:
    n = v.try_cast("bigint")
    scale = F.when(F.length(v) <= 10, F.lit(1)).when(F.length(v) <= 13, F.lit(1000)).when(F.length(v) <= 16, F.lit(1000000)).otherwise(F.lit(1000000000))
    return F.array_compact(F.array(F.when(v.rlike(_EPOCH), F.struct(F.lit("epoch").alias("fmt"), F.floor(n / scale).alias("wall"), F.lit("Z").alias("zone")))))


#: Prior counts: of a format, of the stated order of numeric dates, of the other order; and how well a misprint explains a date that only the other order can read.
PRIOR, STATED, UNSTATED, MISPRINT = 1.0, 20.0, 0.05, 0.3
_OTHER = {"dmy": "mdy", "mdy": "dmy"}


def format_posteriors(sets: list[tuple[str, ...]], counts: list[int], order: str | None, iterations: int) -> list[tuple[str, float]]:
    """EM over one source: for each set of formats that values fit, the likeliest format and its posterior.

    A date that only the unstated order reads may also be a misprint, which is a component of its own: one
    such date stays under one half, and some dozens of them make the unstated order the likelier one.
    """
    against = _OTHER.get(order)
    fits = [s + ("misprint",) if against in s and order not in s else s for s in sets]
    like = {"misprint": MISPRINT}
    names = sorted({f for s in fits for f in s})
    start = {f: STATED if f == order else UNSTATED if f == against else PRIOR for f in names}
    weight = dict(start)
    for _ in range(iterations):
        total = dict(start)
        for s, n in zip(fits, counts):
            z = sum(weight[f] * like.get(f, 1.0) for f in s)
            for f in s:
                total[f] += n * weight[f] * like.get(f, 1.0) / z
        weight = total
    out = []
    for s, f in zip(sets, fits):
        best = max(s, key=lambda x: (weight[x], x))
        out.append((best, weight[best] / sum(weight[x] * like.get(x, 1.0) for x in f)))
    return out


def _fit(iterations: int):
    """The fit of one source's counts. Its rows are one per set of possible formats, so a group is small whatever its source's size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = next((o for o in pdf["date_order"] if isinstance(o, str) and o), None)
        found = format_posteriors([tuple(s.split("|")) for s in pdf["formats"]], pdf["n"].tolist(), order, iterations)
        return pd.DataFrame([(key, formats, *x) for key, formats, x in zip(pdf["source_key"], pdf["formats"], found)], columns=["source_key", "formats", "fmt", "posterior"])

    return run


def normalise_timestamps(
    df: DataFrame,
    sources: DataFrame,
    fields: list[str],
    key: str = "doc_id",
    source: str = "source_id",
    iterations: int = 50,
    least_posterior: float = 0.9,
) -> DataFrame:
    """One row per (key, field, value): the instant, its format, its posterior and a status.

    ``sources`` holds ``source_id``, ``tz_name`` and ``date_order``; it is broadcast only if small.
    Status is ``canonical``, ``resolved``, ``ambiguous`` (posterior under ``least_posterior``),
    ``no_zone`` (local time of a source without a known zone) or ``unreadable`` (null, blank,
    impossible, relative or placeholder text, Bikram Sambat years). A numeric date that a source's stated
    order can't read is ambiguous, unless so many of the source's dates read the other way that EM takes it. Duplicate rows give equal rows; other
    columns are ignored, so clashing names do no harm; an empty table gives an empty result.
    Hot sources: the fit sees counts that were summed before the shuffle, at most one row per set
    of formats, so a source's share of the rows doesn't matter.
    """
    reg = (
        sources.select(F.col("source_id").alias("source_key"), "tz_name", "date_order")
        .groupBy("source_key")
        .agg(F.max("tz_name").alias("tz_name"), F.max("date_order").alias("date_order"))
    )
    long = df.select(
        F.col(key).alias("key"),
        F.col(source).alias("source_key"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x"),
    ).select("key", "source_key", "x.field_name", "x.value")
    long = long.join(_small(reg), "source_key", "left")
    # Steps of their own, so that no step's result is computed again by the next.
    step = long.withColumn("tidy", _tidy(F.col("value"))).withColumn("tidy", _number_months(F.col("tidy")))
    step = step.withColumn("fits", F.when(F.col("tidy").isNull() | (F.length("tidy") > LONGEST), F.array().cast("array<struct<fmt:string,p:array<string>>>")).otherwise(_matches(F.col("tidy"))))
    walls = F.array_compact(F.transform("fits", _wall))
    parsed = step.withColumn("parses", F.concat(walls, _epochs(F.col("tidy")))).drop("fits", "tidy")
    parsed = parsed.withColumn("parses", F.coalesce("parses", F.array().cast("array<struct<fmt:string,wall:bigint,zone:string>>")))
    parsed = parsed.withColumn("formats", F.array_join(F.transform("parses", lambda p: p["fmt"]), "|"))
    parsed = materialize(parsed, "timestamps")

    counts = (
        parsed.where(F.size("parses") > 0)
        .groupBy("source_key", "date_order", "formats")
        .agg(F.count("*").alias("n"))
        .withColumn("source_key", F.coalesce("source_key", F.lit("")))
    )
    fitted = counts.groupBy("source_key").applyInPandas(_fit(iterations), "source_key string, formats string, fmt string, posterior double")
    joined = parsed.withColumn("sk", F.coalesce("source_key", F.lit(""))).join(
        _small(fitted.select(F.col("source_key").alias("sk"), "formats", F.col("fmt").alias("chosen"), "posterior")), ["sk", "formats"], "left"
    )
    best = F.element_at(F.filter("parses", lambda p: p["fmt"] == F.col("chosen")), 1)
    rows = joined.withColumn("best", F.when(F.size("parses") > 0, best))

    zone = F.upper(F.coalesce(F.col("best.zone"), F.lit("")))
    table = F.create_map(*[F.lit(x) for abbr, tz, minutes in ABBREVIATIONS for x in (f"{abbr}@{tz}", minutes)])
    named = F.coalesce(F.try_element_at(table, F.concat(zone, F.lit("@"), F.coalesce("tz_name", F.lit("")))), F.try_element_at(table, F.concat(zone, F.lit("@*"))))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    numeric = F.when(
        zone.rlike(r"^[+-]"),
        F.when(zone.startswith("-"), -1).otherwise(1) * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))),
    )
    offset = F.coalesce(numeric, named)
    wall = F.col("best.wall")
    # to_utc_timestamp takes the earlier instant of a repeated wall time and the earlier offset of a skipped one.
    by_zone = F.when(F.col("tz_name").isNotNull(), F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(wall), F.col("tz_name"))))
    epoch = F.when(zone == "", by_zone).otherwise(wall - offset * 60)
    status = (
        F.when(F.col("best").isNull(), "unreadable")
        .when(F.col("value").rlike(CANONICAL), "canonical")
        .when((zone == "") & F.col("tz_name").isNull(), "no_zone")
        .when((zone != "") & offset.isNull(), "unreadable")
        .when(F.col("posterior") < least_posterior, "ambiguous")
        .otherwise("resolved")
    )
    out = rows.withColumn("status", status).withColumn("epoch", epoch)
    return out.select(
        F.col("key").alias(key),
        F.col("source_key").alias(source),
        "field_name",
        "value",
        F.when(F.col("status").isin("canonical", "resolved"), F.col("epoch")).cast("bigint").alias("epoch_s"),
        F.when(F.col("best").isNotNull(), F.col("best.fmt")).alias("fmt"),
        "posterior",
        "status",
    )


def _small(df: DataFrame) -> DataFrame:
    return broadcast_if_small(df, 16 << 20)
