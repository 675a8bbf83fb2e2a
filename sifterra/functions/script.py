"""Script, language-by-rule and legacy-font functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DEVANAGARI = "[ऀ-ॿ]"
# Thresholds of the bucket rules.
LEAST_LETTERS, BOTH_SHARE, MAIN_SHARE, HYBRID_SHARE, BRACE_SHARE, LEAST_WORDS = 50, 0.10, 0.15, 0.10, 0.05, 20


def devanagari_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(DEVANAGARI))


def latin_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Za-z]"))


def substantive_chars(text: Column) -> Column:
    """L2: Devanagari characters and ASCII letters."""
    return F.regexp_count(text, F.lit("[A-Za-zऀ-ॿ]"))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def hybrid_ratio(text: Column) -> Column:
    """L3: share of Devanagari-bearing words with a doubled vowel sign or a foreign character inside; 0 under 20 words."""
    all_words = words(text)
    deva = F.filter(all_words, lambda w: w.rlike(DEVANAGARI))
    inner = lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}ऀ-ॿ]+|[^\p{L}\p{N}ऀ-ॿ]+$", "")
    hit = F.filter(deva, lambda w: w.rlike(r"([ािीुूेैोौंःृ])\1") | inner(w).rlike("[^ऀ-ॿ]"))
    return F.when((F.size(all_words) < LEAST_WORDS) | (F.size(deva) == 0), F.lit(0.0)).otherwise(F.size(hit) / F.size(deva))


def brace_ratio(text: Column) -> Column:
    """L4: share of words of three or more characters' length with a brace, bracket or bar inside, over all words; 0 under 20 words."""
    all_words = words(text)
    hit = F.filter(all_words, lambda w: w.rlike(r"^.+[{}|\[\]].+$"))
    return F.when(F.size(all_words) < LEAST_WORDS, F.lit(0.0)).otherwise(F.size(hit) / F.size(all_words))


def script_bucket(text: Column, deva: Column | None = None, latin: Column | None = None) -> Column:
    """L1: devanagari, latin, mixed, mojibake_suspected or other. Shares are over all characters.

    Give the counts as columns of an earlier step where the texts are many: the rules use each several times.
    """
    deva = devanagari_count(text) if deva is None else deva
    latin = latin_count(text) if latin is None else latin
    total = F.length(text)
    d, la = deva / total, latin / total
    hybrid = hybrid_ratio(text) >= HYBRID_SHARE
    return (
        F.when(F.coalesce(total, F.lit(0)) == 0, "other")
        .when(deva + latin < LEAST_LETTERS, "other")
        .when((d > BOTH_SHARE) & (la > BOTH_SHARE), F.when(hybrid, "mojibake_suspected").otherwise("mixed"))
        .when(d > MAIN_SHARE, F.when(hybrid, "mojibake_suspected").otherwise("devanagari"))
        .when(la > MAIN_SHARE, F.when(brace_ratio(text) > BRACE_SHARE, "mojibake_suspected").otherwise("latin"))
        .otherwise("other")
    )


def forum_language(text: Column, english: list[str], romanised: list[str]) -> Column:
    """English, roman_nepali, devanagari, code_mixed or other, over letters only. Marker lists are the caller's."""
    deva = devanagari_count(text)
    latin = latin_count(text)
    total = deva + latin
    low = F.lower(text)
    english_hits = sum((F.when(low.contains(w), 1).otherwise(0) for w in english), F.lit(0))
    romanised_hits = F.regexp_count(low, F.lit(r"\b(?:" + "|".join(map(re.escape, romanised)) + r")\b"))
    return (
        F.when(total < 10, "other")
        .when(deva / total > 0.5, "devanagari")
        .when((deva > 0) & (deva / total > 0.05), "code_mixed")
        .when((romanised_hits >= 3) & (romanised_hits > english_hits), "roman_nepali")
        .otherwise("english")
    )


# Words that mark romanised Nepali in questions to the server and to the navigator.
SERVER_ROMAN = "kasari kun kaha ke chha cha garna garne parcha huncha chaina hos janu garnu hami tapai mero tyo yo hoina ho nai".split()
NAVIGATOR_ROMAN = "kasari kati garne garna banaune banauna parcha chha cha ho ma ko".split()


def _roman(text: Column, words: list[str]) -> Column:
    return text.rlike(r"(?i)\b(?:" + "|".join(words) + r")\b")


def server_language(text: Column) -> Column:
    """Devanagari above half of the letters, roman_nepali by a marker word, else english."""
    deva, latin = devanagari_count(text), latin_count(text)
    return F.when(deva + latin == 0, "english").when(deva / F.nullif(deva + latin, F.lit(0)) > 0.5, "devanagari").when(_roman(text, SERVER_ROMAN), "roman_nepali").otherwise("english")


def navigator_language(text: Column) -> Column:
    """Devanagari where it is not less than Latin, roman_nepali by a marker word, else english."""
    deva, latin = devanagari_count(text), latin_count(text)
    return F.when((deva > 0) & (deva >= latin), "devanagari").when(_roman(text, NAVIGATOR_ROMAN), "roman_nepali").otherwise("english")


def answer_script_mismatch(answer: Column, language: Column) -> Column:
    """More Devanagari than copied names explain: over 24 letters and a fifth of the Latin ones for English, over 12 and 8 % for romanised Nepali."""
    text = F.coalesce(answer, F.lit(""))
    deva, latin = devanagari_count(text), latin_count(text)
    over = lambda least, share: deva > F.greatest(F.lit(float(least)), latin * share)
    return F.when(language == "english", over(24, 0.20)).when(language == "roman_nepali", over(12, 0.08)).otherwise(False)


def language_match(answer: Column, language: Column, least: float = 0.5) -> Column:
    """The share of Devanagari letters is on the side that the language asks for; null without letters."""
    deva, latin = devanagari_count(answer), latin_count(answer)
    share = F.try_divide(deva.cast("double"), deva + latin)
    return F.when(language.isin("devanagari", "ne", "hi"), share >= least).otherwise(share < least)


def dominant(text: Column, least: float = 0.5) -> Column:
    """Devanagari share of letters reaches ``least``."""
    total = devanagari_count(text) + latin_count(text)
    return F.coalesce(devanagari_count(text) / F.nullif(total, F.lit(0)) >= least, F.lit(False))


def script_mismatch(question: Column, answer: Column) -> Column:
    """The answer's main script differs from the question's; null where either has no letters."""
    main = lambda c: F.when(devanagari_count(c) + latin_count(c) == 0, None).when(devanagari_count(c) >= latin_count(c), "deva").otherwise("latin")
    return main(question) != main(answer)


def fold_digits(text: Column) -> Column:
    """Devanagari digits as ASCII."""
    return F.translate(text, "०१२३४५६७८९", "0123456789")


# Postpositions that are cut off a word.
POSTPOSITIONS = ["बाट", "मा", "को", "का", "की", "ले", "लाई"]


def stem_postposition(word: Column) -> Column:
    """One postposition off the end where three characters or more are left."""
    out = word
    for p in reversed(POSTPOSITIONS):
        out = F.when(word.endswith(p) & (F.length(word) >= len(p) + 3), F.substring(word, F.lit(1), F.length(word) - len(p))).otherwise(out)
    return out


# Thresholds of the tier decision.
SCANNED_CHARS, SOME_DEVANAGARI, NO_DEVANAGARI, LATIN_TEXT, LEGACY_LATIN, LONG_TEXT = 100, 50, 20, 50, 100, 500
SURE_HITS, DOUBTFUL_HITS, MANY_HITS, DOUBTFUL_MARKS, DENSE_MARKS, MUCH_DEVANAGARI, SURE_SHARE, LOW_SHARE = 3, 2, 5, 0.02, 0.05, 200, 0.15, 0.10


def pdf_tier(deva: Column, latin: Column, chars: Column, pages: Column, marker_hits: Column, mark_share: Column, deva_share: Column, reads_english: Column, producer: Column | None = None) -> Column:
    """Struct of ``tier``, ``confidence``, ``family`` (of a legacy font) and ``warnings`` from a PDF's counts.

    ``marker_hits``: words of the legacy font; ``mark_share``: share of its signature characters; ``reads_english``: the text does;
    ``producer``: a hint from the producing program (``C``, ``C-or-B``, ``B-legacy``). Null counts are 0. C: pages without text; Mixed: Unicode and
    legacy text; A: Unicode; BPreeti: legacy text that the marks confirm; E: English; BLegacyUnknown: neither; else Unknown.
    """
    n = lambda c: F.coalesce(c, F.lit(0))
    english = F.coalesce(reads_english, F.lit(False))
    hint = F.lit(None).cast("string") if producer is None else producer
    unicode_, none = n(deva) >= SOME_DEVANAGARI, n(deva) < NO_DEVANAGARI
    unsure = (n(marker_hits) >= DOUBTFUL_HITS) & ((n(mark_share) >= DOUBTFUL_MARKS) | ~english)
    dense = none & (n(latin) > LEGACY_LATIN) & (n(mark_share) >= DENSE_MARKS) & ~english
    legacy = (n(marker_hits) >= SURE_HITS) | unsure | dense
    written = none & ((n(latin) > LATIN_TEXT) | (n(chars) > LONG_TEXT))
    tier = (
        F.when((n(pages) > 0) & (n(chars) < SCANNED_CHARS), "C").when(unicode_ & legacy, "Mixed").when(unicode_, "A").when(legacy, "BPreeti")
        .when(written & english, "E").when(written, "BLegacyUnknown").otherwise("Unknown")
    )
    sure = (
        F.when(tier == "C", hint.isin("C", "C-or-B"))
        .when(tier == "A", (n(deva) >= MUCH_DEVANAGARI) & (n(deva_share) >= SURE_SHARE))
        .when(tier == "BPreeti", n(marker_hits) >= MANY_HITS)
    )
    low = (tier == "Unknown") | ((tier == "BLegacyUnknown") & ~F.coalesce(hint == "B-legacy", F.lit(False)))
    confidence = F.when(F.coalesce(sure, F.lit(False)), "high").when(low, "low").otherwise("medium")
    family = F.when(tier.isin("Mixed", "BPreeti"), "preeti").when(tier == "BLegacyUnknown", "unknown-legacy")
    warnings = F.array_compact(
        F.array(
            F.when(tier == "Mixed", "mixed_encoding"), F.when((tier == "A") & (n(deva_share) < LOW_SHARE), "low_devanagari_share"),
            F.when(tier == "BLegacyUnknown", "no_known_font_and_not_english"), F.when((tier == "Unknown") & (n(chars) < LONG_TEXT), "very_short_text"),
        )
    )
    return F.struct(tier.alias("tier"), confidence.alias("confidence"), family.alias("family"), warnings.alias("warnings"))


# Fixed values of the token rules: characters inside legacy words, those that stand for digits, parts and beginnings of legacy words, ends of English ones.
LEGACY_MARKS = frozenset("{}[]|:;/\\=+")
LEGACY_DIGITS = frozenset("!@#$%^&*()")
LEGACY_PARTS = "g]kfn ;/sf/ sf7df8f gful/s sDkgL xf] df}nL dlxgf cfly{s ljefu kof{j/0f lg0f{o sfof{no jif{ gLlt a}+s".split()
LEGACY_STARTS = tuple(
    "lj lq lg lk lz lh ld lw lv lx lb lc lm ln gf df sf kf hf cf bf jf tf rf af ef zf xf Nf Kf Sf Df Bf Mf Rf Tf Pf gL kL sL bL jL tL nL dL /s { }+".split()
)
ENGLISH_ENDS = tuple("tion sion ing ed ly ment ness able ible ship ful less est age ance ence ity ism ist ous al ive".split())


def converts(token: str, english: frozenset[str] = frozenset()) -> bool:
    """Whether a token of a mixed document is legacy-font text, by the first rule that decides; ``english`` holds known words in lower case.

    In order: Unicode Devanagari stays; legacy marks beside a Latin letter, digits typed as symbols, parts and beginnings of
    legacy words convert; marks alone, numbers, acronyms, English words and ends, proper names and words with a plain share of
    vowels stay; what is left converts.
    """
    letters = [c for c in token if c.isascii() and c.isalpha()]
    if not token or re.search(DEVANAGARI, token):
        return False
    if letters and LEGACY_MARKS & set(token):
        return True
    if LEGACY_DIGITS & set(token) and set(token) <= LEGACY_DIGITS | set("_-."):
        return True
    if any(p in token for p in LEGACY_PARTS) or token.startswith(LEGACY_STARTS):
        return True
    core = re.sub(r"^[\W_]+|[\W_]+$", "", token)
    alpha = "".join(c for c in core if c.isascii() and c.isalpha())
    if not alpha:
        return False
    low = core.lower()
    vowels = sum(c in "aeiouy" for c in alpha.lower())
    stays = (
        (alpha.isupper() and len(alpha) > 1) or low in english or (low.endswith(ENGLISH_ENDS) and len(alpha) > 3)
        or (alpha[0].isupper() and alpha[1:] == alpha[1:].lower() and vowels > 0 and len(alpha) > 2) or (alpha.islower() and len(alpha) > 3 and vowels >= 0.3 * len(alpha))
    )
    return not stays


class LegacyFont:
    """A rule engine for legacy fonts with a table that the caller supplies.

    ``pre`` and ``post`` are (pattern, replacement) rules, ``pairs`` maps strings to strings; the longest
    key wins. Tokens that are Unicode Devanagari, numbers, web addresses or in ``keep`` stay.
    """

    def __init__(self, pairs: Mapping[str, str], pre: list[tuple[str, str]] = (), post: list[tuple[str, str]] = (), keep: frozenset[str] = frozenset()):
        self.pairs = dict(pairs)
        self.pre, self.post, self.keep = [(p, r) for p, r in pre], [(p, r) for p, r in post], keep
        self.longest = max(map(len, self.pairs), default=0)

    def convert(self, text: str) -> str:
        for p, r in self.pre:
            text = re.sub(p, r, text)
        out, i = [], 0
        while i < len(text):
            for n in range(min(self.longest, len(text) - i), 0, -1):
                piece = text[i : i + n]
                if piece in self.pairs:
                    out.append(self.pairs[piece])
                    i += n
                    break
            else:
                out.append(text[i])
                i += 1
        text = "".join(out)
        for p, r in self.post:
            text = re.sub(p, r, text)
        return text

    def keeps(self, token: str) -> bool:
        """Web and mail addresses and words of ``keep`` stay, and what the token rules leave."""
        return "://" in token or bool(re.fullmatch(r"\S+@\S+\.\S+", token)) or token.lower().strip(".,;:()") in self.keep or not converts(token, self.keep)

    def convert_mixed(self, text: str) -> str:
        return "".join(t if not t or t.isspace() or self.keeps(t) else self.convert(t) for t in re.split(r"(\s+)", text))

    def udf(self, mixed: bool = True):
        convert = self.convert_mixed if mixed else self.convert

        @F.pandas_udf(StringType())
        def run(s: pd.Series) -> pd.Series:
            return s.map(lambda x: None if x is None else convert(x))

        return run


def best_conversion(text: Column, fonts: Mapping[str, LegacyFont], dictionary: list[str]) -> Column:
    """The font whose conversion has most dictionary words, then most Devanagari; null unless hits grow by two or more."""
    hits = lambda c: F.size(F.filter(words(c), lambda w: w.isin(dictionary)))
    tried = [F.struct(hits(f.udf(False)(text)).alias("hits"), (devanagari_count(f.udf(False)(text)) / F.greatest(F.length(text), F.lit(1))).alias("ratio"), F.lit(n).alias("font"), f.udf(False)(text).alias("text")) for n, f in fonts.items()]
    best = F.array_max(F.array(*tried))
    return F.when(best["hits"] >= hits(text) + 2, best)


_INDEPENDENT = dict(zip("अआइईउऊऋएऐओऔ", "a aa i ii u uu ri e ai o au".split()))
_SIGNS = dict(zip("ािीुूृेैोौ", "aa i ii u uu ri e ai o au".split()))
_CONSONANTS = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसह", "k kh g gh ng ch chh j jh ny t th d dh n t th d dh n p ph b bh m y r l w sh sh s h".split()))


def romanise_word(word: str) -> str:
    """Consonants carry an a unless a vowel sign or a virama follows or the word ends."""
    out = []
    for i, c in enumerate(word):
        after = word[i + 1] if i + 1 < len(word) else ""
        if c in _CONSONANTS:
            out.append(_CONSONANTS[c])
            if after and after not in _SIGNS and after != "्":
                out.append("a")
        elif c in _SIGNS:
            out.append(_SIGNS[c])
        elif c in _INDEPENDENT:
            out.append(_INDEPENDENT[c])
        elif c in "ंँ":
            out.append("n")
        elif c == "्" or c == "ः":
            continue
        elif "०" <= c <= "९":
            out.append(str(unicodedata.decimal(c)))
        else:
            out.append(c)
    return "".join(out)


@F.pandas_udf(StringType())
def romanise(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else " ".join(map(romanise_word, x.split(" "))))


def foreign_artifact(text: Column) -> Column:
    """Characters of scripts that answers don't use (CJK, kana, Hangul, Cyrillic, Arabic, Thai)."""
    return F.coalesce(text.rlike(r"[一-鿿぀-ヿ가-힯Ѐ-ӿ؀-ۿ฀-๿]"), F.lit(False))
