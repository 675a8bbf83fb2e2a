"""Language of records and of their mixed segments.

Sparse multinomial logistic regression on TF-IDF character n-grams, trained online by
follow-the-regularised-leader with elastic-net penalties, then calibrated by one temperature.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, is_word, map_rows
from sifterra.session import bounded_sample, few_files, spread

LANGUAGES = ["de", "en", "hi", "ne", "ne-Latn"]

# ISO 639 codes and English names of the languages known here.
NAMES = {
    "de": "de", "deu": "de", "ger": "de", "german": "de",
    "en": "en", "eng": "en", "english": "en",
    "hi": "hi", "hin": "hi", "hindi": "hi",
    "ne": "ne", "nep": "ne", "nepali": "ne",
}


def named_language(label: str | None) -> str | None:
    """The language that a label names, or None. A region after - or _ doesn't count; ne-Latn is named only by itself."""
    if not label:
        return None
    low = label.strip().lower()
    if low == "ne-latn":
        return "ne-Latn"
    head, _, tail = low.replace("_", "-").partition("-")
    if tail and not ((len(tail) == 2 and tail.isalpha()) or (len(tail) == 3 and tail.isdigit())):
        return None
    return NAMES.get(head)


def word_shape(word: str) -> str:
    """Letters and combining marks only, in lower case."""
    return "".join(c for c in word.lower() if unicodedata.category(c)[0] in "LM")


def ngrams(word: str, longest: int) -> list[str]:
    """Character n-grams of one word between boundary marks; no n-gram crosses a blank, so a text's features are the sum of its words'."""
    s = f"<{word}>"
    return [s[i : i + n] for n in range(1, longest + 1) for i in range(len(s) - n + 1) if n > 1 or s[i] not in "<>"]


class LanguageModel:
    """Weights times IDF by n-gram. A text's logits are the bias plus the mean of its n-grams' rows, times ``scale``."""

    def __init__(self, table: dict[str, np.ndarray], bias: np.ndarray, scale: float, longest: int, temperature: float = 1.0):
        self.table, self.bias, self.scale, self.longest, self.temperature = table, bias, scale, longest, temperature
        self._start()

    def _start(self):
        self.words = Memo(self._word, 200_000)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "words"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def _word(self, token: str):
        shape = word_shape(token)
        grams = ngrams(shape, self.longest) if shape else []
        k = len(self.bias)
        total = np.zeros(k)
        for g in grams:
            row = self.table.get(g)
            if row is not None:
                total += row
        return (*total.tolist(), float(len(grams)), is_word(token))

    def logits(self, text: str) -> list[float] | None:
        """None where the text has no letters."""
        return self._read(text)[0]

    def _read(self, text: str) -> tuple[list[float] | None, int]:
        """Logits and the number of words, in one pass over the tokens."""
        parts = list(map(self.words.__getitem__, text.split()))
        if not parts:
            return None, 0
        *sums, grams, n = map(sum, zip(*parts))
        if not grams:
            return None, n
        return [(b + s * self.scale / grams) / self.temperature for b, s in zip(self.bias, sums)], n

    def read(self, text: str) -> tuple[str | None, float, int]:
        """Language (None without letters), confidence and number of words."""
        z, n = self._read(text)
        if z is None:
            return None, 0.0, n
        top = max(z)
        return LANGUAGES[z.index(top)], 1.0 / sum(math.exp(x - top) for x in z), n

    def classify(self, text: str) -> tuple[str, float] | None:
        lang, conf, _ = self.read(text)
        return None if lang is None else (lang, conf)


def _features(lines: list[str], longest: int, least_df: int):
    """IDF over the sample's lines and each line's L1-normalised counts."""
    memo = Memo(lambda w: Counter(ngrams(word_shape(w), longest)))
    counts = []
    df: Counter = Counter()
    for line in lines:
        c: Counter = Counter()
        for w, n in Counter(line.split()).items():
            for g, m in memo[w].items():
                c[g] += n * m
        counts.append(c)
        df.update(c.keys())
    index = {g: i for i, g in enumerate(sorted(g for g, n in df.items() if n >= least_df))}
    idf = np.array([math.log((1 + len(lines)) / (1 + df[g])) + 1 for g in index])
    rows = []
    for c in counts:
        n = sum(c.values())
        pairs = [(index[g], m / n) for g, m in c.items() if g in index]
        idx = np.fromiter((i for i, _ in pairs), np.int64, len(pairs))
        rows.append((idx, np.fromiter((v for _, v in pairs), float, len(pairs)) * idf[idx] if len(pairs) else np.zeros(0)))
    return index, idf, rows


def _ftrl(rows, labels, size: int, scale: float, epochs: int, alpha: float, beta: float, l1: float, l2: float, seed: int):
    """FTRL-Proximal with elastic net, one example at a time; weights exist only where the L1 ball is left."""
    k = len(LANGUAGES)
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for j in order.permutation(len(rows)):
            idx, val = rows[j]
            at = np.append(idx, size)
            x = np.append(val * scale, 1.0)[:, None]
            w = weights(at)
            s = (x * w).sum(0)
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[j]] -= 1
            g = x * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def _scores(rows, w, scale):
    out = np.empty((len(rows), w.shape[1]))
    for i, (idx, val) in enumerate(rows):
        out[i] = w[-1] + (val[:, None] * w[idx]).sum(0) * scale
    return out


def train(lines: list[tuple[str, str]], longest: int = 4, least_df: int = 2, scale: float = 12.0, epochs: int = 2, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.05, l2: float = 0.01, seed: int = 5) -> LanguageModel:
    """Fit on (text, language) pairs whose labels may be partly wrong.

    Models of either half relabel or drop the lines of the other that they contradict; the final one is
    trained on the rest and calibrated on a fifth that it hasn't seen.
    """
    texts = [t for t, _ in lines]
    y = np.array([LANGUAGES.index(label) for _, label in lines])
    index, idf, rows = _features(texts, longest, least_df)
    keep = np.array([len(r[0]) > 0 for r in rows], bool)
    rows, y = [r for r, k in zip(rows, keep) if k], y[keep]
    if not rows:
        return LanguageModel({}, np.zeros(len(LANGUAGES)), scale, longest)
    # Each half is judged by a model of the other one, so that no wrong label vouches for itself.
    side = np.arange(len(rows)) % 2 == 1
    p = np.zeros((len(rows), len(LANGUAGES)))
    for part in (side, ~side):
        others = np.flatnonzero(~part)
        if len(others) and part.any():
            w = _ftrl([rows[i] for i in others], y[others], len(index), scale, 1, alpha, beta, l1, l2, seed)
            s = _scores([rows[i] for i in np.flatnonzero(part)], w, scale)
            e = np.exp(s - s.max(1, keepdims=True))
            p[part] = e / e.sum(1, keepdims=True)
    best, conf = p.argmax(1), p.max(1)
    good = (best == y) | (conf > 0.8)
    y2 = np.where(conf > 0.8, best, y)
    rows2, y2 = [r for r, g in zip(rows, good) if g], y2[good]
    if not rows2:
        rows2, y2 = rows, y
    held = np.arange(len(rows2)) % 5 == 4
    fit = [i for i in range(len(rows2)) if not held[i]]
    w = _ftrl([rows2[i] for i in fit], y2[fit], len(index), scale, epochs, alpha, beta, l1, l2, seed)
    t = 1.0
    if held.any():
        s, yh = _scores([r for r, h in zip(rows2, held) if h], w, scale), y2[held]

        def loss(t):
            q = s / t
            q = q - q.max(1, keepdims=True)
            return float((np.log(np.exp(q).sum(1)) - q[np.arange(len(yh)), yh]).mean())

        t = min(np.geomspace(0.3, 20, 60), key=loss)
    table = {g: idf[i] * w[i] for g, i in index.items() if w[i].any()}
    return LanguageModel(table, w[-1], scale, longest, float(t))


def fit_language_model(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", bound: int = 1500, most_lines: int = 5000) -> LanguageModel:
    """Train on the lines of at most ``bound`` labelled records, chosen by hash, and at most ``most_lines`` lines of them."""
    df = few_files(df)
    labels = [x for x in NAMES] + ["ne-latn"]
    low = F.lower(F.trim(F.col(label)))
    known = df.where(F.coalesce(F.regexp_replace(low, r"[-_]([a-z]{2}|\d{3})$", ""), F.lit("")).isin(labels) | (low == "ne-latn"))
    rows = bounded_sample(known.select(key, text, label), [key], bound)
    lines = []
    for r in sorted(rows, key=lambda r: str(r[0])):
        lang = named_language(r[2])
        if lang and r[1]:
            lines += [(x, lang) for x in r[1].split("\n") if x.strip()]
    if len(lines) > most_lines:
        lines = [lines[i] for i in np.random.default_rng(3).permutation(len(lines))[:most_lines]]
    return train(lines)


def text_segments(model: LanguageModel, text: str, only: set[int] | None = None):
    """(words by language, confidence-weighted words by language, [(line_no, language, confidence)] of lines of five words or more)."""
    words: dict[str, int] = defaultdict(int)
    weight: dict[str, float] = defaultdict(float)
    long_lines = []
    for no, line in enumerate(text.split("\n"), 1):
        if only is not None and no not in only:
            continue
        lang, conf, n = model.read(line)
        if lang is None or not n:
            continue
        words[lang] += n
        weight[lang] += n * conf
        if n >= 5:
            long_lines.append((no, lang, conf))
    return words, weight, long_lines


def main_language(words: dict[str, int], weight: dict[str, float]) -> tuple[str, float] | None:
    """Language of most words; ties go to the higher confidence, then to the first name. Its confidence is the mean over its words."""
    if not words:
        return None
    best = max(sorted(words), key=lambda k: (words[k], weight[k]))
    return best, weight[best] / words[best]


SEGMENTS = "rec_key string, seg_no int, lang string, confidence double, label string, label_ok boolean"


def label_records(df: DataFrame, model: LanguageModel, prefix: str, key: str, text: str, label: str | None, mixed: bool = True) -> DataFrame:
    """One row per record (``seg_no`` 0) and one per line of five words or more where a record's lines are in several languages.

    Null keys and null, blank and letterless texts give no row. Any other columns are ignored, so clashing names do
    no harm; duplicate input rows give duplicate rows. No shuffle: one Arrow pass over the texts, whose
    word scores are memoised (a text's logits are additive over words).
    """
    columns = [F.col(key).cast("string").alias("k"), F.col(text).alias("t"), (F.col(label) if label else F.lit(None).cast("string")).alias("l")]

    def make():
        def one(k, t, lab):
            if k is None or t is None:
                return
            words, weight, lines = text_segments(model, t)
            main = main_language(words, weight)
            if main is None:
                return
            rec = f"{prefix}:{k}"
            yield rec, 0, main[0], main[1], lab, named_language(lab) == main[0]
            if mixed and len({x[1] for x in lines}) > 1:
                for no, lang, conf in lines:
                    yield rec, no, lang, conf, None, False

        return one

    return map_rows(spread(df).select(*columns), make, SEGMENTS)
