"""Defects of prompt and response pairs: empty, truncated, refusing, copying, in another language."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import count_words, map_rows
from sifterra.llm.language import LanguageModel, main_language, named_language, text_segments
from sifterra.operators.metrics import lcs_length
from sifterra.operators.sequences import last_before

# Refusal templates.
REFUSALS = """
I'm sorry, but I can't help with that request.
I cannot answer this question based on the provided sources.
I do not have enough information to answer. Please contact the office.
Sorry, this is outside what I can discuss.
As an assistant I am not able to give advice on this matter.
Unfortunately the sources do not contain this information, so I won't answer.
No relevant source was found; I must decline to answer.
I am unable to assist with this request.
I can't provide an answer to that question.
माफ गर्नुहोस्, म यस प्रश्नको उत्तर दिन सक्दिनँ ।
मसँग यसबारे पर्याप्त जानकारी छैन, कृपया सम्बन्धित कार्यालयमा सोध्नुहोस् ।
दिइएका स्रोतमा यो जानकारी छैन, त्यसैले उत्तर दिन मिल्दैन ।
क्षमा गर्नुहोस्, यस विषयमा म सहयोग गर्न असमर्थ छु ।
Maph garnuhos, ma yasa prashnako uttar din sakdinan.
Masang yasabare paryapt janakari chhaina, kripaya sambandhit karyalayama sodhnuhos.
Diieka srotama yo janakari chhaina, tyasaile uttar din mildain.
Kshama garnuhos, yasa wishayama ma sahayog garn asamarth chhu.
Es tut mir leid, aber ich kann diese Frage nicht beantworten.
क्षमा करें, मैं इस प्रश्न का उत्तर नहीं दे सकता ।
"""
# Parts of refusing clauses, a line each. A clause refuses where one opening and one act stand in it in this order.
REFUSING = {
    "en": (
        "i cannot|i can not|i can t|i could not|i couldn t|i am unable to|i m unable to|i am not able to|i m not able to|i won t|i will not|i must decline to|i have to decline to|i decline to|i refuse to|i am not allowed to|i m not allowed to|i am not permitted to|i d rather not|we cannot|we can t|we are unable to|unable to|not able to|cannot",
        "answer|help|assist|comment|provide|discuss|respond|reply|advise|give advice|give an answer|give you|offer|share|comply|fulfil|fulfill|do that|do this|support|speak|talk|say|engage|complete|address|process",
    ),
    "de": ("ich kann|kann ich|darf ich|ich könnte|ich darf|wir können|ich bin", "nicht beantworten|nicht helfen|nicht weiterhelfen|nicht sagen|keine auskunft|keine antwort|nicht antworten|nicht in der lage|nicht geben|nicht äußern|nicht erfüllen|keine angaben"),
    "ne": ("म|मैले|मबाट|यो|यस|यसको|त्यो|प्रश्नको|उत्तर|जवाफ|सहयोग|मद्दत|सल्लाह|जानकारी|टिप्पणी", "दिन सक्दिनँ|दिन सक्दिन|दिन मिल्दैन|दिन सकिँदैन|दिन असमर्थ|गर्न सक्दिनँ|गर्न सक्दिन|गर्न मिल्दैन|गर्न असमर्थ|गर्न सकिँदैन|भन्न सक्दिनँ|भन्न सक्दिन|भन्न मिल्दैन"),
    "ne-Latn": ("ma|maile|yo|yas|yasa|yasko|prashnako|uttar|jawaf|jawaph|sahayog|maddat|sallah|janakari", "din sakdina|din sakdinan|din mildaina|din mildain|dina sakdina|dina mildaina|garn sakdina|garna sakdina|garn asamarth|garna asamarth|garna mildaina|bhanna sakdina|bhanna mildaina"),
    "hi": ("मैं|मुझे|हम|इस|यह|मेरे", "नहीं दे सकता|नहीं दे सकती|नहीं दे सकते|नहीं कर सकता|नहीं कर सकती|नहीं कर सकते|नहीं बता सकता|नहीं बता सकती|देने में असमर्थ|करने में असमर्थ|असमर्थ हूँ"),
}
# Clauses that say that nothing is known; words in order.
UNKNOWING = """
do not have enough information|don t have enough information|not enough information|do not have information|don t have information|do not have any information|don t have any information|no information available|no relevant source|no source available
sources do not contain|sources don t contain|sources do not mention|sources do not say|outside what i can|outside my scope|beyond my scope|beyond what i can|against my guidelines|against my policy
reicht die information nicht|keine ausreichenden informationen|keine informationen
पर्याप्त जानकारी छैन|जानकारी छैन|जानकारी उपलब्ध छैन|स्रोत भेटिएन
paryapt janakari chhaina|janakari chhaina
पर्याप्त जानकारी नहीं|जानकारी नहीं है|जानकारी उपलब्ध नहीं
"""
# Clauses that may stand beside a refusal and answer nothing; their first words.
POLITE = "sorry|i m sorry|i am sorry|apologies|i apologize|i apologise|my apologies|unfortunately|thank you|thanks|please contact|please ask|please consult|please visit|please try|as an|as a|es tut mir leid|leider|entschuldigung|bitte wenden|माफ|माफ गर्नुहोस्|क्षमा|क्षमा गर्नुहोस्|कृपया|धन्यवाद|maph|maph garnuhos|maaf|kshama|kripaya|क्षमा करें|खेद है|मुझे खेद"
#: A refusing clause is no longer than that many words: a longer one says more.
CLAUSE_WORDS = 24
_CLAUSES = re.compile(r"[.।॥!?;:,\n]+|\s[–—-]\s|\b(?:but|however|aber|jedoch|तर|लेकिन|tara|so|hence|therefore|because|since)\b")

# Words that may introduce a copied question.
LEADS = frozenset("question prompt q query user प्रश्न prashn prashna सवाल frage here is the".split())

_CITATION = re.compile(r"\[\s*[SsDd]?\d+(?:\s*[,;]\s*[SsDd]?\d+)*\s*\]|\[https?://[^\]\s]+\]|https?://\S+|【[^】]*】|\(\s*[Ss]\d+\s*\)")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,80}>|&[a-z]{2,8};|<\|[^|<>]{1,40}\|>")
_STOP = re.compile(r"[.।॥!?؟。][\"'”’»)\]*_`]*$")
_ITEM = re.compile(r"^\s*(?:[-*•–]|\(?[\d०-९]{1,3}[.)]|\(?[a-z][.)])\s+\S")


_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def tokens(text: str) -> list[str]:
    """Folded words: letters, marks and digits, in NFC, without case."""
    return _WORD.findall((text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)).casefold())


def shingles(words: list[str], n: int = 3) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def bare(text: str | None) -> str:
    """The answer without tags, citations and what surrounds them."""
    return _TAG.sub(" ", _CITATION.sub(" ", text or "")).strip()


def is_empty(answer: str | None) -> bool:
    return not any(c.isalnum() for c in bare(answer))


def is_copy(question: list[str], answer: list[str]) -> bool:
    """The answer says nothing but the question, once or several times: its shingles lie in the question and the LCS covers it."""
    while answer and answer[0] in LEADS and (not question or answer[0] != question[0]):
        answer = answer[1:]
    if not question or not answer:
        return False
    n = len(question)
    if len(answer) < 0.8 * n:
        return False
    times = max(1, round(len(answer) / n))
    a = shingles(answer)
    doubled = shingles(question * 2)
    if len(a & doubled) < 0.8 * len(a):
        return False
    least = 0.9 * max(len(answer), n)
    # No alignment is longer than the words that both hold, which is counted before a long answer is aligned.
    have = Counter(question)
    if sum(min(times * have[w], c) for w, c in Counter(answer).items()) < least:
        return False
    return lcs_length(question * times, answer) >= least


def _in_order(part: list[str], words: list[str]) -> bool:
    """The whole part is a subsequence: its alignment has its own length."""
    rest = iter(words)
    return all(x in rest for x in part)


class Refusals:
    """Refusal templates by shingle and, for what remains, alignment by LCS; clauses in other wordings by aligned openings and acts."""

    def __init__(self, templates: str = REFUSALS):
        self.templates = [tokens(x) for x in templates.strip().split("\n") if x.strip()]
        self.known = set().union(*(shingles(t) for t in self.templates))
        phrases = lambda x: [tokens(p) for p in x.split("|")]
        self.parts = [(phrases(a), phrases(b)) for a, b in REFUSING.values()]
        self.unknowing = [" ".join(tokens(p)) for line in UNKNOWING.strip().split("\n") for p in line.split("|")]
        self.hints = frozenset(act[-1] for _, acts in self.parts for act in acts) | frozenset(x.split()[-1] for x in self.unknowing)
        self.polite = tuple(" ".join(tokens(p)) for p in POLITE.split("|"))

    def declines(self, text: str, words_of_all: list[str], least: float = 0.8) -> bool:
        """Clauses that refuse, or stand beside a refusal and answer nothing, make up ``least`` of the text's words, and one refuses."""
        if self.hints.isdisjoint(words_of_all):
            return False
        refusing = polite = other = 0
        for clause in _CLAUSES.split(text.casefold()):
            words = tokens(clause)
            if not words:
                continue
            if len(words) <= CLAUSE_WORDS and self.clause_refuses(words):
                refusing += len(words)
            elif " ".join(words[:4]).startswith(self.polite):
                polite += len(words)
            else:
                other += len(words)
        return refusing > 0 and refusing + polite >= least * (refusing + polite + other)

    def clause_refuses(self, words: list[str]) -> bool:
        """Some opening and act, or some clause of not knowing, aligns whole with the words, in order."""
        have = set(words)
        for openings, acts in self.parts:
            if any(act[-1] in have and have.issuperset(act) and any(o[0] in have and _in_order(o + act, words) for o in openings) for act in acts):
                return True
        line = " " + " ".join(words) + " "
        return any(f" {x} " in line for x in self.unknowing)

    def refuses(self, answer: list[str], least: float = 0.8) -> bool:
        """``least`` of the answer's tokens align with templates in a row, or a longer answer opens with a whole template and adds little."""
        if not answer:
            return False
        if not self.known & shingles(answer):
            return False  # no template aligns without three words of it in a row
        rest, covered = answer, 0
        while rest:
            scored = [(lcs_length(t, rest[: len(t)]) / len(t), len(t)) for t in self.templates]
            share, n = max(scored)
            if share < 0.75:
                break
            covered += min(n, len(rest))
            rest = rest[n:]
        return covered >= least * len(answer)


def is_truncated(answer: str) -> bool:
    """Breaks off inside a sentence: the last line is no list item and has no closing mark once citations are taken away."""
    text = bare(answer)
    if not text:
        return False
    last = text.split("\n")[-1].strip()
    if last.endswith(("...", "…")):
        return True
    return not _STOP.search(last) and not _ITEM.match(last)


def language_of(model: LanguageModel, text: str) -> str | None:
    words, weight, _ = text_segments(model, text)
    main = main_language(words, weight)
    return main[0] if main else None


def _family(lang: str | None) -> str | None:
    return "ne" if lang == "ne-Latn" else lang


def defect_of(question: str | None, answer: str | None, wanted: str | None, refusal_ok: bool, model: LanguageModel, refusals: Refusals) -> str | None:
    """The first defect that fits, or None. ``wanted`` is the language asked for; without it the question's language holds."""
    if is_empty(answer):
        return "empty"
    text = bare(answer)
    a, q = tokens(text), tokens(bare(question))
    copy = is_copy(q, a)
    if not copy and is_truncated(answer):
        return "truncated"
    if not refusal_ok and (refusals.refuses(a) or refusals.declines(text, a)):
        return "refusal"
    if copy:
        return "copies_question"
    want = named_language(wanted) if wanted and wanted.strip() else None
    if want is None and question:
        want = language_of(model, question)
    if want is None or count_words(text) < 1:
        return None
    return "other_language" if _family(language_of(model, text)) not in (None, _family(want)) else None


def pair_defects(pairs: DataFrame, model: LanguageModel) -> DataFrame:
    """``pair_key, defect`` (null for a sound pair) of ``pair_key, question, answer, wanted, refusal_ok``.

    Null, blank and mark-only answers are ``empty``; a null question can't be copied and names no language;
    equal pairs give equal rows; other columns are ignored. One Arrow pass, no shuffle. A
    question repeated any number of times is a copy; only answers whose shingles and words are the question's
    are aligned with it.
    """
    refusals = Refusals()

    def make():
        def one(key, question, answer, wanted, refusal_ok):
            yield key, defect_of(question, answer, wanted, bool(refusal_ok), model, refusals)

        return one

    return map_rows(pairs.select("pair_key", "question", "answer", "wanted", "refusal_ok"), make, "pair_key string, defect string")


def smoke_pairs(smoke: DataFrame) -> DataFrame:
    """One pair a row; rows without an id have no key and are left out, repeated rows stay."""
    return smoke.where("result_id is not null").select(
        F.concat(F.lit("smoke:"), F.col("result_id").cast("string")).alias("pair_key"),
        "question",
        F.col("model_output").alias("answer"),
        F.when(F.trim("response_language") != "", F.col("response_language")).alias("wanted"),
        F.coalesce(F.col("kind") == "refusal", F.lit(False)).alias("refusal_ok"),
    )


def chat_pairs(turns: DataFrame) -> DataFrame:
    """Each assistant turn with the nearest earlier user turn of its conversation; without one it is no pair. Rows without a key are left out, repeated rows stay."""
    rows = turns.where("conv_id is not null and turn_no is not null").select("conv_id", "turn_no", "role", "content")
    is_user = F.col("role") == "user"
    d = last_before(rows, "conv_id", "turn_no", F.struct("content"), is_user, "asked")
    return d.where("role = 'assistant' and asked is not null").select(
        F.format_string("chat:%d:%d", "conv_id", "turn_no").alias("pair_key"),
        F.col("asked.content").alias("question"),
        F.col("content").alias("answer"),
        F.lit(None).cast("string").alias("wanted"),
        F.lit(False).alias("refusal_ok"),
    )
