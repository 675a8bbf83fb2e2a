"""Garbled text: noisy-channel decoding of wrongly decoded bytes, with wildcards for lost ones, under corpus word frequencies."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, map_rows
from sifterra.session import broadcast_if_small, materialize, spread

#: Single-byte encodings that UTF-8 is wrongly read in.
CODECS = ("cp1252", "mac_roman", "cp1251", "cp437", "cp850", "koi8_r", "cp1250")
#: Marks that stand for lost letters.
LOST = "�□\x1a"
_LOST_RUN = re.compile(f"[{LOST}]+")
#: A question mark at a word's end in the midst of a sentence.
_LOST_END = re.compile(r"[A-Za-z]\? [a-z]")
_BLANKS = re.compile(r"([ \t\r\n]+)")


def _inverse(codec: str) -> dict[str, int]:
    """Character to byte; bytes that the codec doesn't define stand for the control of the same number, as browsers decode them."""
    table = {}
    for b in range(256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(c, b)
        if codec == "cp1252" and 0x80 <= b < 0xA0:
            table.setdefault(chr(b), b)
    return table


def _plausible(cp: int) -> bool:
    """Characters that texts in the corpus' languages use beyond ASCII (Latin letters, Devanagari, general punctuation, currency, pictographs), and those that a half-undone double encoding holds."""
    return 0x80 <= cp <= 0x17F or 0x900 <= cp <= 0x97F or 0x200B <= cp <= 0x203A or cp in (0x192, 0x2C6, 0x2DC, 0x20AC, 0x20B9, 0x2122, 0x2026, 0xFEFF) or 0x1F300 <= cp <= 0x1FAFF


def _code_points(lead: int, rest: tuple[int, ...]) -> list[int]:
    """Plausible code points of a UTF-8 sequence of one lead byte and following bytes, of which a lost one (-2) can be any."""
    size = len(rest) + 1
    low = high = lead & (0xFF >> (size + 1))
    for b in rest:
        low, high = low << 6 | (0 if b == -2 else b & 63), high << 6 | (63 if b == -2 else b & 63)
    least = (0x80, 0x800, 0x10000)[size - 2]
    fits = lambda cp: all(b == -2 or (cp >> 6 * (size - 2 - i)) & 63 == b & 63 for i, b in enumerate(rest))
    return [cp for cp in range(max(low, least), min(high, 0x10FFFF) + 1) if _plausible(cp) and fits(cp)]


class ByteLattice:
    """Positions of a text under one codec. Each holds its byte, or any byte where a mark stands for a lost one."""

    def __init__(self, codec: str):
        self.codec, self.byte = codec, _inverse(codec)
        self.byte |= {c: -2 for c in LOST}
        some = lambda low, high: "".join(re.escape(c) for c, b in self.byte.items() if low <= b <= high)
        tail, lead = some(0x80, 0xBF) + LOST, some(0xE0, 0xEF)
        # Without a lead byte and a byte that may follow it no path reads a sequence, so the search is left out.
        self.pattern = f"[{some(0xC2, 0xDF)}{some(0xF0, 0xF4)}][{tail}]|[{lead}][{tail} ]"
        self.possible = re.compile(self.pattern)
        #: Ends in a sequence that a blank, once a no-break space, may go on with.
        self.open = re.compile(f"[{lead}][{tail}]?$")
        self.points = Memo(lambda k: _code_points(k[0], k[1:]), 50_000)

    def decode(self, text: str, unigram) -> str:
        """Best path. Each step keeps a character or reads two to four of them as one UTF-8 sequence, whose lost bytes can be any."""
        byte = [self.byte.get(c, -1) for c in text]
        n = len(text)
        score = [-math.inf] * (n + 1)
        back: list[tuple[int, str]] = [(0, "")] * (n + 1)
        score[0] = 0.0
        for i in range(n):
            here, b = score[i], byte[i]
            step = here + unigram(text[i])
            if step > score[i + 1]:
                score[i + 1], back[i + 1] = step, (i, text[i])
            size = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
            if not size or i + size > n:
                continue
            rest = byte[i + 1 : i + size]
            if size == 3:
                rest = [0xA0 if x == 0x20 else x for x in rest]  # a no-break space that was made a blank
            if not all(x == -2 or 0x80 <= x <= 0xBF for x in rest):
                continue
            points = self.points[(b, *rest)]
            if not points:
                continue
            if -2 in rest:
                out, gain = LOST[0], math.log(sum(math.exp(unigram(chr(o))) for o in points)) - 1.0
            else:
                out = chr(points[0])
                gain = unigram(out)
            step = here + gain
            if step > score[i + size]:
                score[i + size], back[i + size] = step, (i, out)
        out, at = [], n
        while at:
            at, c = back[at]
            out.append(c)
        return "".join(reversed(out))


class WordModel:
    """Corpus word and word-pair counts; finds the likeliest words for damaged ones.

    Words are numbered by length, so that all words of one length are one string that a pattern is run over;
    pair counts are sparse rows by first and by second word. ``total`` and ``chars`` are those of the whole
    corpus where ``words`` holds only those that damage can need.
    """

    def __init__(self, words: dict[str, int], pairs: dict[tuple[str, str], int], total: int | None = None, chars: dict[str, int] | None = None):
        self.words, self.pairs = words, pairs
        self.total = max(1, sum(words.values()) if total is None else total)
        if chars is None:
            count: Counter = Counter()
            for w, n in words.items():
                for c in w:
                    count[c] += n
            chars = dict(count)
        self.chars, self.char_total = chars, sum(chars.values()) + 1
        self._start()

    def _start(self):
        order = sorted(self.words, key=lambda w: (len(w), -self.words[w], w))
        self.order, size = order, len(order)
        self.number = {w: i for i, w in enumerate(order)}
        self.count = np.array([*(self.words[w] for w in order), 0.0])  # the last place is any unknown word
        self.prob = (self.count + 0.1) / self.total
        self.rank = np.empty(size, np.int64)
        self.rank[sorted(range(size), key=lambda i: (-self.words[order[i]], order[i]))] = np.arange(size)
        self.lengths: dict[int, tuple[int, str]] = {}
        at = 0
        while at < size:
            n, end = len(order[at]), at
            while end < size and len(order[end]) == n:
                end += 1
            self.lengths[n] = (at, "\n".join(order[at:end]))
            at = end
        known = [(self.number[a], self.number[b], n) for (a, b), n in self.pairs.items() if a in self.number and b in self.number]
        a, b, n = (np.array(x) for x in zip(*known)) if known else (np.zeros(0, np.int64),) * 3
        self.after, self.before = _rows(a, b, n, size + 1), _rows(b, a, n, size + 1)
        self.matching = Memo(self.options, 1_000)
        floor = math.log(0.3 / self.char_total)
        self.unigram = Memo(lambda c: math.log(self.chars[c] / self.char_total) if c in self.chars else math.log(0.02) if c.isascii() else math.log(1e-4) if "ऀ" <= c <= "ॿ" else max(floor, math.log(1e-7))).__getitem__
        self.score = Memo(self._score, 200_000).__getitem__

    def __getstate__(self):
        return {"words": self.words, "pairs": self.pairs, "total": self.total, "chars": self.chars, "char_total": self.char_total}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def _score(self, token: str) -> float:
        """Log probability of a token: of its corpus frequency, of that of the likeliest word which its lost letters fit, or of its characters where the corpus doesn't know it."""
        n = self.words.get(token, 0)
        spelt = sum(map(self.unigram, token)) - 2.0
        if not n and _LOST_RUN.search(token) and _LOST_RUN.sub("", token):
            fits = self.matching[token]
            n = self.count[fits[0]] / math.e if len(fits) else 0
        return max(math.log(n / self.total), spelt) if n else spelt

    def options(self, token: str) -> np.ndarray:
        """Numbers of all corpus words that a damaged token can be, the most frequent first: a lost-byte run stands for one to its length of letters, each '?' for one."""
        core, low = _word_pattern(token)
        pattern = re.compile(f"(?m)^(?:{core})$")
        found = [start + m.start() // (n + 1) for n in range(low, len(token) + 1) if n in self.lengths for start, text in [self.lengths[n]] for m in pattern.finditer(text)]
        ids = np.array(found, np.int64)
        return ids[np.argsort(self.rank[ids])]

    def likely(self, token: str, left: int | None, right: int | None) -> np.ndarray:
        """Of the options between two sound tokens, those that can be the best or the next best.

        Without a pair count the score of a word grows with its frequency alone, so that all words
        seen beside ``left`` or ``right`` and the two most frequent others hold both.
        """
        full = self.matching[token]
        near = np.zeros(len(self.count), bool)
        for row, at in ((self.after, left), (self.before, right)):
            if at is not None:
                near[row[1][row[0][at] : row[0][at + 1]]] = True
        beside = near[full]
        others = np.flatnonzero(~beside)[:2]
        beside[others] = True
        return full[beside]

    def ahead(self, ids: np.ndarray, scores: np.ndarray, choices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best score of each choice and the place in ``ids`` that it comes from, as if every pair were tried: pairs without a count differ in the first word's part only."""
        base = scores - np.log(self.count[ids] + 2.0)
        rest = int(base.argmax())
        best = base[rest] + np.log(2.0 * self.prob[choices])
        came = np.full(len(choices), rest)
        start, other, n = self.after
        sizes = start[ids + 1] - start[ids]
        if sizes.sum():
            at = np.repeat(start[ids] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            place = np.full(len(self.count), -1)
            place[choices] = np.arange(len(choices))
            to, from_ = place[other[at]], np.repeat(np.arange(len(ids)), sizes)
            on = (to >= 0) & (other[at] < len(self.order))
            to, from_, at = to[on], from_[on], at[on]
            value = base[from_] + np.log(n[at] + 2.0 * self.prob[other[at]])
            by = np.lexsort((from_, -value, to))
            to, from_, value = to[by], from_[by], value[by]
            first = np.concatenate([[True], to[1:] != to[:-1]]) if len(to) else np.zeros(0, bool)
            to, from_, value = to[first], from_[first], value[first]
            up = value > best[to]
            best[to[up]], came[to[up]] = value[up], from_[up]
        return best, came

    def step(self, a: str | None, b: str) -> float:
        p = (self.words.get(b, 0) + 0.1) / self.total
        if a is None:
            return math.log(p)
        return math.log((self.pairs.get((a, b), 0) + 2.0 * p) / (self.words.get(a, 0) + 2.0))

    def _beside(self, rows, at: int, ids: np.ndarray) -> np.ndarray:
        line = np.zeros(len(self.count))
        line[rows[1][rows[0][at] : rows[0][at + 1]]] = rows[2][rows[0][at] : rows[0][at + 1]]
        return line[ids]

    def values(self, ids: np.ndarray, left: int | None, right: int | None) -> np.ndarray:
        """Score of each word between two others."""
        out = np.log(self.prob[ids]) if left is None else np.log((self._beside(self.after, left, ids) + 2.0 * self.prob[ids]) / (self.count[left] + 2.0))
        return out if right is None else out + np.log((self._beside(self.before, right, ids) + 2.0 * self.prob[right]) / (self.count[ids] + 2.0))

    def repair(self, text: str, margin: float = math.log(3.0)) -> tuple[str, int, int]:
        """Viterbi over all options of each run of damaged tokens between sound ones; a token is replaced only where the best word leads the next by ``margin``. (text, damaged, restored)"""
        tokens = re.split(r"(\s+)", text)
        places = [i for i, t in enumerate(tokens) if t and not t.isspace()]
        hurt = [damaged_token(tokens[i]) for i in places]
        if not any(hurt):
            return text, 0, 0
        unknown, words = len(self.order), [tokens[i] for i in places]
        sound = lambda k: self.number.get(words[k], unknown) if 0 <= k < len(places) else None
        restored, k = 0, 0
        while k < len(places):
            if not hurt[k]:
                k += 1
                continue
            end = k
            while end < len(places) and hurt[end]:
                end += 1
            left, right = sound(k - 1), sound(end)
            if end - k == 1:
                layers = [self.likely(words[k], left, right)]
            else:
                layers = [self.matching[w] for w in words[k:end]]
            layers = [x if len(x) else np.array([unknown]) for x in layers]
            if left is None:
                scores, backs = np.log(self.prob[layers[0]]), []
            else:
                scores, backs = self.ahead(np.array([left]), np.zeros(1), layers[0])[0], []
            for a, b in zip(layers, layers[1:]):
                scores, came = self.ahead(a, scores, b)
                backs.append(came)
            if right is not None:
                scores = scores + np.log((self._beside(self.before, right, layers[-1]) + 2.0 * self.prob[right]) / (self.count[layers[-1]] + 2.0))
            path = [int(scores.argmax())]
            for came in reversed(backs):
                path.append(int(came[path[-1]]))
            path = [int(x[i]) for x, i in zip(layers, reversed(path))]
            for j, (ids, best) in enumerate(zip(layers, path)):
                if best == unknown:
                    continue
                value = self.values(ids, path[j - 1] if j else left, path[j + 1] if j + 1 < len(path) else right)
                own = value[ids == best][0]
                top = np.partition(value, -2)[-2] if len(ids) > 1 else -math.inf
                if (len(ids) == 1 or own >= top + margin) and self.order[best] != words[k + j]:
                    tokens[places[k + j]] = self.order[best]
                    restored += 1
            k = end
        return "".join(tokens), sum(hurt), restored


def _rows(a: np.ndarray, b: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: start of each ``a``, its ``b`` and their counts."""
    by = np.lexsort((b, a))
    return np.searchsorted(a[by], np.arange(size + 1)), b[by].astype(np.int64), n[by].astype(float)


def _word_pattern(token: str) -> tuple[str, int]:
    """Pattern of the words that a damaged token can be, and their least length."""
    if any(c in LOST for c in token):
        parts = re.findall(f"[{LOST}]+|[^{LOST}]+", token)
        core = "".join(f".{{1,{len(x)}}}" if x[0] in LOST else re.escape(x) for x in parts)
        # A question mark beside lost bytes may be a mark or another lost letter.
        core = core.replace(r"\?", ".")
        return core, max(1, len(_LOST_RUN.sub("", token)) + len(_LOST_RUN.findall(token)))
    return re.escape(token).replace(r"\?", "."), len(token)


def damaged_token(token: str) -> bool:
    """Holds a lost-letter mark, a run of question marks in a word's place, or one inside or before letters."""
    if any(c in LOST for c in token):
        return True
    if "?" not in token:
        return False
    core = token.strip("\"'“”‘’()[],.;:!।")
    return bool(re.fullmatch(r"\?{2,}", core)) or bool(re.search(r"\?\w", core)) and "://" not in core and "=" not in core


class Repairer:
    def __init__(self, words: WordModel):
        self.words = words
        self._start()

    def _start(self):
        self.lattices = [ByteLattice(c) for c in CODECS]
        lead, tail = byte_classes()
        some = lambda chars: "".join(map(re.escape, sorted(chars)))
        #: A lead byte and one that may follow, each under any codec; and the codecs that can read a token.
        self.anywhere = re.compile(f"[{some(lead)}][{some(tail)}{LOST} ]")
        self.readers = Memo(lambda token: [k for k, lat in enumerate(self.lattices) if lat.possible.search(token + " ")], 100_000)
        self.read = [Memo(lambda atom, lat=lat: lat.decode(atom, self.words.unigram), 50_000) for lat in self.lattices]

    def __getstate__(self):
        return {"words": self.words}

    def __setstate__(self, state):
        self.words = state["words"]
        self._start()

    def readings(self, parts: list[str]) -> list[tuple[int, int, str, str]]:
        """Every stretch of tokens that some codec reads otherwise: (first token, end, codec, text read).

        ``parts`` are tokens and the blanks between them. A blank is inside a stretch only where it may have been the last byte of a sequence.
        """
        out = []
        text, starts = "".join(parts), None
        done, last = [0] * len(self.lattices), -1
        for m in self.anywhere.finditer(text):
            if starts is None:
                starts = [0, *accumulate(map(len, parts))]
            i = bisect_right(starts, m.start()) - 1
            if i == last:
                continue
            last = i
            for k in self.readers[parts[i]]:
                if i < done[k]:
                    continue
                lat, end = self.lattices[k], i + 1
                while end + 1 < len(parts) and parts[end] == " " and lat.open.search(parts[end - 1]):
                    end += 2
                atom = "".join(parts[i:end]) if end > i + 1 else parts[i]
                now = self.read[k][atom]
                if now != atom:
                    out.append((i // 2, (end + 1) // 2, lat.codec, now))
                done[k] = end
        return out

    def undo(self, text: str) -> tuple[str, str | None]:
        """One wrong decoding undone: Viterbi over the tokens, each kept or read by a codec's lattice, under corpus word frequencies. (text, codec that read most tokens)"""
        parts = _BLANKS.split(text)
        arcs: dict[int, list[tuple[int, str, str]]] = {}
        for i, end, codec, now in self.readings(parts):
            arcs.setdefault(i, []).append((end, codec, now))
        if not arcs:
            return text, None
        score, n = self.words.score, (len(parts) + 1) // 2
        best, back = [-math.inf] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            step = best[i] + (score(parts[2 * i]) if parts[2 * i] else 0.0)
            if step > best[i + 1]:
                best[i + 1], back[i + 1] = step, (i, None, parts[2 * i])
            for end, codec, now in arcs.get(i, ()):
                step = best[i] + sum(map(score, now.split()))
                if step > best[end]:
                    best[end], back[end] = step, (i, codec, now)
        out, at, used = [], n, Counter()
        while at:
            i, codec, now = back[at]
            out.append(now)
            if i:
                out.append(parts[2 * i - 1])
            if codec:
                used[codec] += at - i
            at = i
        return "".join(reversed(out)), used.most_common(1)[0][0] if used else None

    def repair(self, text: str | None, legacy: bool | None = None) -> dict | None:
        """None for a sound text; else its damage: codec chain, restored text, number of damaged tokens left.

        ``legacy``: the text is in a legacy font, whose code points are any marks at all, so question marks in it are
        no damage; where it isn't given, ``looks_legacy`` decides once it matters. Wrong decodings are undone until
        none makes the text likelier; each makes it shorter, so this ends.
        """
        if not text or (text.isascii() and "?" not in text):
            return None
        chain, now = [], text
        while not now.isascii():
            after, codec = self.undo(now)
            if codec is None:
                break
            chain.append(codec)
            now = after
        if legacy is None:
            legacy = marked(text) and looks_legacy(text)
        if not (chain or _LOST_RUN.search(text) or not legacy and asked(text)):
            return None
        fixed, damaged, restored = self.words.repair(now) if not legacy else (now, sum(c in LOST for c in now), 0)
        return {"codecs": ">".join(chain), "restored": fixed, "damaged_words": damaged, "restored_words": restored}

    def sound(self, text: str | None) -> bool:
        """No codec reads any part otherwise and no letter is lost, whatever the words' frequencies."""
        if not text or _LOST_RUN.search(text):
            return not text
        return not (asked(text) and not looks_legacy(text)) and not self.readings(_BLANKS.split(text))

    def needs(self, text: str | None) -> set[str]:
        """Keys of the corpus words that can matter for a text: '=' and a token for those it has or is read as; for damaged ones a length with the first letter, the last, or neither known."""
        out: set[str] = set()
        now = text or ""
        while now:
            parts = _BLANKS.split(now)
            tokens = {t for p in (parts, *(r[3].split() for r in self.readings(parts) if not now.isascii())) for t in p}
            for t in tokens:
                out.add("=" + t)
                if damaged_token(t):
                    _, low = _word_pattern(t)
                    free = (*LOST, "?")
                    kind = "f" + t[0] if t[0] not in free else "l" + t[-1] if t[-1] not in free else "*"
                    out.update(f"{kind}{n}" for n in range(low, len(t) + 1))
            after, codec = self.undo(now) if not now.isascii() else (now, None)
            now = after if codec else ""
        return out


def marked(text: str) -> bool:
    return "?" in text or _LOST_RUN.search(text) is not None


def asked(text: str) -> bool:
    """Letters were lost to question marks."""
    return "?" in text and (_LOST_END.search(text) is not None or any(damaged_token(t) for t in text.split()))


def looks_legacy(text: str | None) -> bool:
    """Text in a legacy font: mostly Latin code points, but few plain words — marks stand inside the words."""
    if not text:
        return False
    tokens = [t for t in text.split() if len(t) > 2]
    if not tokens:
        return False
    odd = sum(bool(re.search(r"[A-Za-z][/*\[\]{}|^'=+\;%&$#@ÚÔÕ][A-Za-z/*'ÚÔÕ]|[a-z][A-Z]|^[/*'][A-Za-z]|[A-Za-z][/*]$", t)) for t in tokens)
    return odd > 0.3 * len(tokens)


def byte_classes() -> tuple[set[str], set[str]]:
    """Characters that stand for a lead byte, and for a following one, under any codec."""
    lead, tail = set(), set()
    for lattice in map(ByteLattice, CODECS):
        lead |= {c for c, b in lattice.byte.items() if 0xC2 <= b <= 0xF4}
        tail |= {c for c, b in lattice.byte.items() if 0x80 <= b <= 0xBF}
    return lead, tail


def suspect(text: Column) -> Column:
    """Whether a text can hold any damage, by built-in expressions: a lead byte with one that may follow, a mark for lost letters, or a question mark inside or between words. Sound texts never reach Python.

    Characters become one of four classes first (a lead byte, a following byte, either, a mark), each under any
    codec: a regex over classes of hundreds of characters would take a hundred times as long.
    """
    lead, tail = byte_classes()
    kind = {c: "\ue000" if c in lead & tail else "\ue001" if c in lead else "\ue002" for c in lead | tail} | {c: "\ue003" for c in LOST}
    classes = F.translate(text, "".join(kind), "".join(kind.values()))
    return F.coalesce(classes.rlike("[\ue000\ue001][\ue000\ue002\ue003 ]|\ue003|\\?[^\\s]|" + _LOST_END.pattern), F.lit(False))


def clean_words(texts: DataFrame, least: int = 2) -> DataFrame:
    """``w, n``: counts of clean words over all rows of ``text``."""
    clean = F.col("w").rlike(r"^[ऀ-ॿA-Za-zÀ-ÿ’'“”0-9.,;:–§©€£/()-]+$") & ~F.col("w").rlike(r"[Â-Ãà][¡-¿]|[àÃâ]$")
    t = texts.where(F.col("text").isNotNull()).select(F.explode(F.split(F.trim("text"), r"\s+")).alias("w"))
    # The patterns run over different words, not over every occurrence.
    return t.groupBy("w").agg(F.count("*").alias("n")).where((F.col("n") >= least) & clean)


def needed_words(words: DataFrame, needs: DataFrame) -> DataFrame:
    """Words that some damage can need: an equi-join on a word's four keys (itself; its length with first letter, last letter, neither)."""
    n = F.length("w").cast("string")
    keys = F.array(F.concat(F.lit("="), "w"), F.concat(F.lit("f"), F.left("w", F.lit(1)), n), F.concat(F.lit("l"), F.right("w", F.lit(1)), n), F.concat(F.lit("*"), n))
    return words.select("w", "n", F.explode(keys).alias("need")).join(broadcast_if_small(needs), "need", "left_semi").select("w", "n").distinct()


def needed_pairs(texts: DataFrame, words: DataFrame, least: int = 2) -> DataFrame:
    """``x, y, n``: counts of adjacent words that are both needed; the others are dropped before the shuffle."""
    t = texts.where(F.col("text").isNotNull()).select(F.split(F.trim("text"), r"\s+").alias("a"))
    p = t.select(F.explode(F.arrays_zip(F.col("a").alias("x"), F.slice("a", 2, 1_000_000_000).alias("y"))).alias("p")).select(F.col("p.x").alias("x"), F.col("p.y").alias("y")).where("y is not null")
    for side in ("x", "y"):
        p = p.join(broadcast_if_small(words.select(F.col("w").alias(side)), 32 << 20), side, "left_semi")
    return p.groupBy("x", "y").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def field_table(cv: DataFrame, key: str = "cv_id") -> DataFrame:
    """Long form: one row per record and text field."""
    fields = [("preview_before", F.col("preview_before")), ("preview_after", F.col("preview_after")), ("best_effort_text", F.col("best_effort.text"))]
    return cv.select(key, F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), c.alias("text")) for n, c in fields])).alias("x")).select(key, "x.field_name", "x.text")


_FOUND = "field_name string, codecs string, original string, restored string, damaged_words int, restored_words int"


def garbled_fields(fields: DataFrame, key: str = "cv_id", least: int = 2, model_words: int = 500_000) -> DataFrame:
    """One row per damaged field: ``cv_id, field_name, codecs, original, restored, damaged_words, restored_words``.

    Null, empty and sound fields give no row; legacy-font text is no damage by itself; equal rows give equal
    rows; an empty table gives an empty result. ``codecs`` is the chain of wrong encodings undone ('' where
    letters were only lost).

    Words and pairs are counted over all rows, seen ``least`` times or more. A worker holds those that the
    damage can need, not the vocabulary: beyond ``model_words`` of them the damaged fields are split into
    shards by their hash, each with its own model, so no word is left out at any size. Only suspect
    fields reach Python.
    """
    spark = fields.sparkSession
    kind = dict(fields.dtypes)[key]
    words = materialize(clean_words(fields, least), "words")
    # Counts of characters, and of all words beside the empty one: no more rows than there are characters.
    letters = words.select(F.explode(F.array_append(F.filter(F.split("w", ""), lambda c: c != ""), F.lit(""))).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n"))
    chars = {r.c: r.n for r in letters.collect()}
    total = chars.pop("", 0)
    bare = Repairer(WordModel({}, {}, total, chars))
    fields = spread(fields)
    hurt = fields.select(key, "field_name", "text").where(suspect(F.col("text")))

    def make_needs():
        def one(k, name, text):
            if not bare.sound(text):
                yield k, name, text, list(bare.needs(text))

        return one

    asked = materialize(map_rows(hurt, make_needs, f"{key} {kind}, field_name string, text string, needs array<string>"), "suspects")
    place = F.xxhash64("text")

    def model_of(part: DataFrame) -> tuple[DataFrame, int]:
        needed = materialize(needed_words(words, part.select(F.explode("needs").alias("need")).distinct()), "needed")
        return needed, needed.count()

    needed, size = model_of(asked)
    shards = max(1, -(-size // model_words))
    out = None
    for s in range(shards):
        part = asked
        if shards > 1:
            part = asked.where(F.pmod(place, F.lit(shards)) == s)
            needed, _ = model_of(part)
        pairs = needed_pairs(fields, needed, least).collect()
        model = WordModel({r.w: r.n for r in needed.collect()}, {(r.x, r.y): r.n for r in pairs}, total, chars)
        shared = spark.sparkContext.broadcast(Repairer(model))

        def make(shared=shared):
            repairer = shared.value

            def one(k, name, text):
                found = repairer.repair(text)
                if found:
                    yield k, name, found["codecs"], text, found["restored"], found["damaged_words"], found["restored_words"]

            return one

        found = map_rows(part.select(key, "field_name", "text"), make, f"{key} {kind}, {_FOUND}")
        out = found if out is None else out.unionByName(found)
    return out
