"""Reading level: acquisition grades of words from graded texts, then calibrated quantiles of a document's known-word grades."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, count_words, map_rows
from sifterra.llm.language import LanguageModel, main_language, text_segments
from sifterra.session import bounded_sample, spread

QUANTILES = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
#: Languages of the graded texts as the language model names them.
GRADED = ("en", "ne")


def graded_form(token: str) -> str:
    """Letters and marks in lower case; '' for numbers and marks alone, which have no grade."""
    return "".join(c for c in token.lower() if unicodedata.category(c)[0] in "LM")


def acquisition_grades(texts: list[tuple[str, int]], levels: list[int], least: int = 2, smooth: float = 0.5) -> dict[str, float]:
    """Expected level of each word that stands in ``least`` texts or more, under its length-normalised share in each level's texts."""
    count = {lv: Counter() for lv in levels}
    spread: Counter = Counter()
    for text, lv in texts:
        words = [w for w in map(graded_form, text.split()) if w]
        count[lv].update(words)
        spread.update(set(words))
    size = {lv: max(1, sum(count[lv].values())) for lv in levels}
    mean = sum(size.values()) / len(levels)
    grades = {}
    for w, n in spread.items():
        if n >= least:
            share = [count[lv][w] / size[lv] * mean + smooth / len(levels) for lv in levels]
            grades[w] = sum(lv * s for lv, s in zip(levels, share)) / sum(share)
    return grades


class ReadingModel:
    """Per language: word grades, and an ordinal logistic regression from grade quantiles to a level."""

    def __init__(self, levels: list[int]):
        self.levels = levels
        self.grades: dict[str, dict[str, float]] = {}
        self.fit_of: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        self._start()

    def _start(self):
        self.words = {lang: Memo(lambda t, g=self.grades[lang]: g.get(graded_form(t), -1.0), 150_000) for lang in self.grades}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "words"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def features(self, lang: str, text: str) -> np.ndarray | None:
        known = [g for g in map(self.words[lang].__getitem__, text.split()) if g >= 0]
        if not known:
            return None
        known.sort()
        n = len(known) - 1
        q = [known[round(p * n)] for p in QUANTILES]
        return np.array([*q, sum(known) / len(known)])

    def scores(self, lang: str, x: np.ndarray) -> np.ndarray:
        """Probability of each level."""
        mean, scale, w, cuts = self.fit_of[lang]
        z = float(((x - mean) / scale) @ w)
        above = 1 / (1 + np.exp(np.clip(cuts - z, -60, 60)))
        edge = np.concatenate([[1.0], above, [0.0]])
        return edge[:-1] - edge[1:]

    def level(self, lang: str, text: str) -> tuple[int, float] | None:
        if lang not in self.fit_of:
            return None
        x = self.features(lang, text)
        if x is None:
            return None
        p = self.scores(lang, x)
        return self.levels[int(p.argmax())], float(p.max())


def fit_reading_model(samples: list[tuple[str, int, str]], steps: int = 800, ridge: float = 0.02, rate: float = 0.1) -> ReadingModel:
    """``samples``: (language, level, text). The regression is fitted on grades that each tenth's own texts didn't contribute to, so that it is calibrated for unseen texts."""
    levels = sorted({lv for _, lv, _ in samples})
    model = ReadingModel(levels)
    by: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for lang, lv, text in samples:
        by[lang].append((text, lv))
    for lang, texts in by.items():
        xs, ys = [], []
        for fold in range(10):
            inner = ReadingModel(levels)
            inner.grades[lang] = acquisition_grades([t for i, t in enumerate(texts) if i % 10 != fold], levels)
            inner._start()
            for i, (text, lv) in enumerate(texts):
                if i % 10 == fold and (x := inner.features(lang, text)) is not None:
                    xs.append(x)
                    ys.append(levels.index(lv))
        model.grades[lang] = acquisition_grades(texts, levels)
        if xs:
            model.fit_of[lang] = _ordinal(np.array(xs), np.array(ys), len(levels), steps, ridge, rate)
    model._start()
    return model


def _ordinal(x: np.ndarray, y: np.ndarray, k: int, steps: int, ridge: float, rate: float):
    """Cumulative-logit regression by Adam; cut points are kept apart by a softplus."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    p = np.concatenate([np.zeros(x.shape[1]), [-1.0], np.full(max(0, k - 2), 1.0)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    d = x.shape[1]

    def cuts_of(p):
        return np.cumsum(np.concatenate([[p[d]], np.log1p(np.exp(p[d + 1 :]))]))

    for step in range(1, steps + 1):
        w, cuts = p[:d], cuts_of(p)
        s = z @ w
        above = 1 / (1 + np.exp(np.clip(cuts[None, :] - s[:, None], -60, 60)))
        edge = np.concatenate([np.ones((len(y), 1)), above, np.zeros((len(y), 1))], 1)
        lik = np.maximum(edge[np.arange(len(y)), y] - edge[np.arange(len(y)), y + 1], 1e-9)
        slope = edge * (1 - edge)
        lo, hi = slope[np.arange(len(y)), y], slope[np.arange(len(y)), y + 1]
        gs = -(lo - hi) / lik / len(y)
        gc = np.zeros(k - 1)
        for j in range(k - 1):
            gc[j] = (np.where(y == j + 1, lo / lik, 0) - np.where(y == j, hi / lik, 0)).mean()
        g = np.zeros_like(p)
        g[:d] = z.T @ gs + ridge * w
        g[d] = gc.sum()
        for j in range(1, k - 1):
            g[d + j] = gc[j:].sum() / (1 + np.exp(-p[d + j]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return mean, scale, p[:d], cuts_of(p)


def fit_from_table(samples: DataFrame, bound: int = 5000) -> ReadingModel:
    """Fit on at most ``bound`` graded samples, chosen by hash."""
    rows = bounded_sample(samples.where("text is not null and reading_level is not null and lang is not null").select("lang", "reading_level", "text"), ["lang", "reading_level", "text"], bound)
    return fit_reading_model(sorted((r[0], r[1], r[2]) for r in rows))


def reading_levels(docs: DataFrame, language: LanguageModel, reading: ReadingModel, key: str = "doc_id", text: str = "text", least_words: int = 50) -> DataFrame:
    """``doc_id, reading_level, confidence, lang, n_words`` of documents in a graded language, of one language only and of ``least_words`` words or more.

    Null and blank texts, other languages, mixed documents and documents without a known word give no row.
    One Arrow pass without a shuffle; language and grade lookups are memoised by word.
    """

    def make():
        def one(k, t):
            if not t:
                return
            n = count_words(t)
            if n < least_words:
                return
            words, weight, lines = text_segments(language, t)
            main = main_language(words, weight)
            if main is None or main[0] not in GRADED or len({x[1] for x in lines}) > 1:
                return
            level = reading.level(main[0], t)
            if level:
                yield k, level[0], level[1], main[0], n

        return one

    return map_rows(spread(docs).select(F.col(key), F.col(text)), make, f"{key} {dict(docs.dtypes)[key]}, reading_level int, confidence double, lang string, n_words int")
