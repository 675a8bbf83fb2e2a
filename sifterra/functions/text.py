"""Text functions (T-1 to T-33) as Catalyst expressions; Python only where a fold can't be one."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

TERMINATORS = ".।!?"

# Stopwords of retrieval queries.
STOPWORDS = "a an and are as at be by can do for from how i in is it me my of on or that the this to was what when where which who will with you your के को का की मा छ र हो कसरी कति कहाँ कहिले".split()

# Wordings of refusals, each a pattern in any case.
REFUSALS = [
    r"no_source_available",
    r"\b(?:i|we)(?:'m| am|'re| are)? (?:cannot|can't|can not|could not|couldn't|not able to|unable to|won't|will not|must decline to|refuse to)\b",
    r"\b(?:unable|not possible) to (?:answer|confirm|verify|determine|provide|help|say)\b",
    r"\b(?:not|no|insufficient|without) (?:enough |relevant |reliable |sufficient )?(?:information|source|sources|data|evidence|details)\b",
    r"\b(?:sources?|documents?|context|passages?) (?:do|does|did) ?n[o']t (?:contain|mention|say|state|include|cover)\b",
    r"\boutside (?:my|the) (?:scope|knowledge)\b",
    r"\b(?:sorry|apologi[sz]e)\b[^.\n]{0,60}\b(?:cannot|can't|unable|not able)\b",
    r"स्रोत(?:मा|हरूमा)?[^।\n]{0,40}(?:छैन|भेटिएन|पाइएन)",
    r"जानकारी[^।\n]{0,30}(?:छैन|भेटिएन|पाइएन)",
    r"उल्लेख[^।\n]{0,20}(?:छैन|पाइँदैन)",
    r"(?:उत्तर|जवाफ|सहयोग|मद्दत)[^।\n]{0,20}(?:सक्दिनँ|सक्दिन|मिल्दैन|असमर्थ)",
    r"\b(?:janakari|srot)\w*\b[^.\n]{0,30}\b(?:chhaina|chaina|bhetiena)\b",
    r"\b(?:uttar|jawaf|jawaph)\b[^.\n]{0,20}\b(?:sakdina|sakdinan|mildain|mildaina)\b",
    r"जानकारी[^।\n]{0,30}नहीं",
    r"(?:उत्तर|जवाब|मदद|सहायता)[^।\n]{0,20}नहीं (?:दे|कर|बता) सक",
    r"\b(?:kann|können|darf)\b[^.\n]{0,60}\bnicht (?:beantworten|helfen|sagen|bestätigen)\b",
]
REFUSAL_PATTERN = "(?i)" + "|".join(REFUSALS)
QUESTION_PATTERN = r"(?i)\?|^\s*(?:how|what|where|when|why|who|which|can|could|is|are|do|does|should|anyone)\b|\b(?:kasari|kaha|kahile|kati|kina)\b|कसरी|कहाँ|कहिले|कति|किन"


def is_blank(text: Column) -> Column:
    """Null, or nothing but white space (no-break spaces included)."""
    return F.coalesce(~text.rlike(r"[^\s\u00A0]"), F.lit(True))


def squeeze(text: Column) -> Column:
    """T-1: every run of Unicode white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def index_tokens(text: Column) -> Column:
    """T-5: by white space; ASCII letters and digits in lower case and Devanagari kept, all else dropped; two characters or more."""
    # Cleaning the whole text once takes a fraction of cleaning every token.
    cleaned = F.lower(F.regexp_replace(text, r"(?U)[^A-Za-z0-9ऀ-ॿ\s]+", ""))
    return F.filter(F.split(cleaned, r"(?U)\s+"), lambda w: F.length(w) >= 2)


def word_tokens(text: Column) -> Column:
    """T-6: runs of letters, digits, underscores and Devanagari, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_ऀ-ॿ]+"), F.lit(0))


def content_tokens(text: Column) -> Column:
    """T-13: distinct word tokens without citations and stopwords."""
    bare = F.regexp_replace(text, r"\[S?\d+\]", " ")
    return F.array_except(F.array_distinct(word_tokens(bare)), F.array(*[F.lit(w) for w in STOPWORDS]))


def sentences(text: Column) -> Column:
    """T-12: pieces up to and with their terminator, trimmed; empty ones dropped."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"[^.।!?\n]+[.।!?]*"), F.lit(0)), lambda s: F.trim(s)), lambda s: s != "")


def drop_near_sentences(text: Column, least: float = 0.8) -> Column:
    """T-12: sentences whose content tokens have a Jaccard similarity of ``least`` with a kept one go; order stays."""
    items = F.transform(sentences(text), lambda s: F.struct(s.alias("s"), content_tokens(s).alias("t")))
    empty = F.array().cast("array<struct<s:string,t:array<string>>>")
    close = lambda k, x: F.size(F.array_intersect(k["t"], x["t"])) >= F.lit(least) * F.greatest(F.size(F.array_union(k["t"], x["t"])), F.lit(1))
    kept = F.aggregate(items, empty, lambda acc, x: F.when(F.exists(acc, lambda k: close(k, x)), acc).otherwise(F.concat(acc, F.array(x))))
    return F.array_join(F.transform(kept, lambda k: k["s"]), " ")


def is_refusal(text: Column) -> Column:
    """T-14."""
    return F.coalesce(text.rlike(REFUSAL_PATTERN), F.lit(False))


def is_question(text: Column) -> Column:
    """T-9."""
    return F.coalesce(text.rlike(QUESTION_PATTERN), F.lit(False))


def has_keyword(text: Column, keywords: list[str]) -> Column:
    """T-10."""
    return F.coalesce(F.lower(text).rlike("|".join(map(re.escape, keywords))), F.lit(False))


# What a forum post holds besides its text.
_FORUM_NOISE = r"(?im)^[ \t]*(?:>|&gt;).*$|^[ \t]*\**edit(?:ed)?\b[^\n:]{0,20}:.*$|\bhttps?://[^\s<>]+|\bwww\.[^\s<>]+"
_FORUM_NAME = r"(?m)(^|[^\w/])/?[ur]/[A-Za-z0-9_-]+"
_FORUM_LINK = r"!?\[([^\]\n]*)\]\([^()\s]*\)"


def clean_forum(text: Column) -> Column:
    """T-8: what a post's author wrote: links keep their words; quoted lines, edit notes, addresses and names of users and groups go; then blanks and empty lines are narrowed."""
    said = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _FORUM_LINK, "$1"), _FORUM_NOISE, ""), _FORUM_NAME, "$1")
    lines = F.transform(F.split(said, r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.btrim(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"), F.lit("\n "))


def citations(text: Column) -> Column:
    """T-19: source marks [S1], [1] and grouped ones as S1, then addresses; in order, once each."""
    grouped = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(r"\[((?:S?\d+)(?:\s*[,;]\s*S?\d+)*)\]"), F.lit(1)), lambda g: F.split(g, r"\s*[,;]\s*")))
    marks = F.transform(grouped, lambda m: F.concat(F.lit("S"), F.regexp_replace(m, "^S", "")))
    urls = F.transform(F.regexp_extract_all(text, F.lit(r"https?://[^\s\])>\"']+"), F.lit(0)), lambda u: F.regexp_replace(u, r"[.,;:!?]+$", ""))
    return F.array_distinct(F.concat(marks, urls))


def mark_citations(text: Column) -> Column:
    """T-20: numeric marks [1] as [S1]."""
    return F.regexp_replace(text, r"\[(\d+)\]", "[S$1]")


def require_citation(text: Column, mark: Column) -> Column:
    """T-21: each sentence without a mark gets ``mark`` at its end."""
    return F.array_join(F.transform(sentences(text), lambda s: F.when(s.rlike(r"\[S\d+\]"), s).otherwise(F.concat(s, F.lit(" "), mark))), " ")


def contacts(text: Column) -> Column:
    """T-23: struct of e-mail addresses and phone numbers of 7 to 13 digits (digits only)."""
    emails = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0)), F.lower))
    raw = F.regexp_extract_all(text, F.lit(r"\+?[0-9][0-9() -]{5,16}[0-9]"), F.lit(0))
    phones = F.array_distinct(F.filter(F.transform(raw, lambda p: F.regexp_replace(p, "[^0-9]", "")), lambda d: F.length(d).between(7, 13)))
    return F.struct(emails.alias("emails"), phones.alias("phones"))


def token_estimate(text: Column) -> Column:
    """T-26: Devanagari characters div 3 plus other characters div 4."""
    deva = F.regexp_count(text, F.lit("[ऀ-ॿ]"))
    return F.floor(deva / 3).cast("bigint") + F.floor((F.length(text) - deva) / 4).cast("bigint")


def token_estimate_by_length(text: Column, chars: int = 4) -> Column:
    """T-26: characters div 3 or div 4."""
    return F.floor(F.length(text) / chars).cast("bigint")


def snippet(text: Column, marker: Column, before: int = 80, width: int = 240) -> Column:
    """T-11: ``width`` characters from ``before`` characters ahead of the marker's first place; the start where it is absent."""
    at = F.instr(F.lower(text), F.lower(marker))
    return F.substring(text, F.greatest(at - before, F.lit(1)), F.lit(width))


def truncate_at_boundary(text: Column, limit: int, least: float = 0.55) -> Column:
    """T-27: at most ``limit`` characters, cut after the last terminator or blank that is at ``least`` of the limit or beyond."""
    head = F.substring(text, 1, limit)
    cut = F.regexp_extract(head, rf"(?s)^(.{{{int(limit * least)},}}[.।!?\s])", 1)
    return F.when(F.length(text) <= limit, text).otherwise(F.rtrim(F.when(cut != "", cut).otherwise(head)))


def is_gibberish(text: Column) -> Column:
    """T-28: no letters, or one character over and over, or a long run of consonants."""
    t = F.lower(F.regexp_replace(text, r"\s+", ""))
    return F.coalesce(~t.rlike(r"\p{L}") | t.rlike(r"^(.)\1{3,}$") | t.rlike(r"[bcdfghjklmnpqrstvwxz]{7,}"), F.lit(True))


def last_number(text: Column) -> Column:
    """T-29: the number after ####, else the last number; thousands commas dropped."""
    marked = F.regexp_extract(text, r"####\s*(-?[0-9][0-9,]*(?:\.[0-9]+)?)", 1)
    every = F.regexp_extract_all(text, F.lit(r"-?[0-9][0-9,]*(?:\.[0-9]+)?"), F.lit(0))
    last = F.when(F.size(every) > 0, F.element_at(every, -1))
    return F.regexp_replace(F.coalesce(F.nullif(marked, F.lit("")), last), ",", "")


def choice_letter(text: Column) -> Column:
    """T-30: the first letter A to D that stands alone."""
    return F.nullif(F.regexp_extract(F.upper(text), r"(?<![A-Z])([A-D])(?![A-Z])", 1), F.lit(""))


def ward_number(text: Column) -> Column:
    """T-32: the number after 'ward' or its Nepali word."""
    folded = F.translate(text, "०१२३४५६७८९", "0123456789")
    return F.regexp_extract(folded, r"(?i)(?:ward(?:\s+no\.?)?|वडा(?:\s+नम्बर)?)\s*([0-9]{1,2})", 1).try_cast("int")


def arithmetic_answer(text: Column) -> Column:
    """T-31: the value of 'a op b'; null where there is none or b is 0 in a division."""
    a, op, b = (F.regexp_extract(text, r"(-?[0-9]+(?:\.[0-9]+)?)\s*([-+*/x])\s*(-?[0-9]+(?:\.[0-9]+)?)", i) for i in (1, 2, 3))
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.when(op == "+", x + y).when(op == "-", x - y).when(op.isin("*", "x"), x * y).when(op == "/", F.try_divide(x, y))


def labelled_field(text: Column, label: str, following: list[str]) -> Column:
    """T-24: what stands between a label and the next of ``following`` or the line's end."""
    stop = "|".join([*map(re.escape, following), r"\n", "$"])
    return F.nullif(F.trim(F.regexp_extract(text, rf"{re.escape(label)}\s*:?\s*(.*?)(?:{stop})", 1)), F.lit(""))


def word_ngrams(tokens: Column, n: int) -> Column:
    """Shingles of n tokens, in order."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def most_repeats(items: Column) -> Column:
    """A29, T-17: how often the most frequent item occurs; sorts once instead of comparing all pairs."""
    step = F.aggregate(
        F.array_sort(items),
        F.struct(F.lit(None).cast("string").alias("v"), F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda a, x: F.struct(x.alias("v"), F.when(a["v"].eqNullSafe(x), a["run"] + 1).otherwise(1).alias("run"), F.greatest(a["best"], F.when(a["v"].eqNullSafe(x), a["run"] + 1).otherwise(1)).alias("best")),
    )
    return step["best"]


def loops(text: Column, n: int = 3, least: int = 4) -> Column:
    """T-17: an n-word phrase occurs ``least`` times or more."""
    return F.coalesce(most_repeats(word_ngrams(word_tokens(text), n)) >= least, F.lit(False))


def opening_loop(text: Column, words: int = 5, least: int = 3) -> Column:
    """T-17: blank, or the first five words stand three times or more in what follows them, or a phrase of three words stands four times."""
    toks = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    head = F.array_join(F.slice(toks, 1, words), " ")
    rest = F.substring(text, F.length(head) + 1, F.length(text))
    again = (F.length(rest) - F.length(F.replace(rest, head, F.lit("")))) / F.length(head) >= least
    return F.when(is_blank(text), True).when(F.size(toks) < words, False).otherwise(again | (F.coalesce(most_repeats(word_ngrams(toks, 3)), F.lit(0)) >= 4))


def phrase_loop(text: Column, shortest: int = 3, least: int = 4, least_words: int = 20) -> Column:
    """T-17: of the words of three characters or more, a phrase of three to six stands four times or more; False under twenty words. A longer phrase that repeats holds a shorter one that does, so the shortest decides."""
    toks = F.filter(word_tokens(text), lambda w: F.length(w) >= 3)
    return F.when(F.size(toks) < least_words, False).otherwise(F.coalesce(most_repeats(word_ngrams(toks, shortest)) >= least, F.lit(False)))


def _repeats(text: str | None, window: int, least: int) -> bool | None:
    if text is None:
        return None
    if len(text) < window * least:
        return False
    seen: dict[str, int] = {}
    for i in range(len(text) - window + 1):
        w = text[i : i + window]
        n = seen[w] = seen.get(w, 0) + 1
        if n >= least:
            return True
    return False


def repeats_window(text: Column, window: int = 30, least: int = 4) -> Column:
    """T-4: a run of ``window`` characters occurs ``least`` times or more; False for texts shorter than window times least.

    An Arrow UDF: as an expression it would sort every window of a text, which took ten times as long.
    """

    @F.pandas_udf(BooleanType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _repeats(x, window, least)).astype("boolean")

    return run(text)


def longest_equal_run(tokens: Column) -> Column:
    """Length of the longest run of equal adjacent tokens."""
    step = F.aggregate(
        tokens,
        F.struct(F.lit(None).cast("string").alias("v"), F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda a, x: F.struct(x.alias("v"), F.when(a["v"].eqNullSafe(x), a["run"] + 1).otherwise(1).alias("run"), F.greatest(a["best"], F.when(a["v"].eqNullSafe(x), a["run"] + 1).otherwise(1)).alias("best")),
    )
    return step["best"]


def trim_repeated_tail(text: Column) -> Column:
    """T-18: lines up to the first that has occurred before."""
    empty = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("stop"))
    fold = F.aggregate(
        F.split(text, "\n"),
        empty,
        lambda a, x: F.when(a["stop"] | ((F.trim(x) != "") & F.array_contains(a["kept"], x)), F.struct(a["kept"].alias("kept"), F.lit(True).alias("stop"))).otherwise(F.struct(F.concat(a["kept"], F.array(x)).alias("kept"), F.lit(False).alias("stop"))),
    )
    return F.array_join(fold["kept"], "\n")
