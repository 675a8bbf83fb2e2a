"""Template residue, filler, error messages and script notices, found by one multi-pattern automaton.

The automaton holds phrases and the opening and closing marks of templates. What it matches, with the empty
words of a notice around it, is the covered part of a line; a line counts as residue when that is most of it.
So wordings that no list holds are found by their parts.
"""

from __future__ import annotations

import re

import ahocorasick

from sifterra.llm.common import Memo
from sifterra.llm import phrases

#: Longest content of a template mark, and the words that may stand around one and still say nothing.
LONGEST_MARK, WORDS_A_MARK = 60, 5
#: Least share of customary pseudo-Latin words in a line of filler.
LATIN_SHARE = 0.3
_DIGITS = re.compile(r"[0-9०-९]+(?:[.,][0-9०-९]+)*")
_TOKENS = re.compile(r"[^\W_](?:[^\W_]|['ऀ-ः़-ॏ॑-ॗ])*")
_QUOTES = str.maketrans("’‘“”", "''\"\"")
_NAME = re.compile(r"[\w.]+")


def _lines(block: str) -> list[str]:
    return [x.strip() for x in block.strip().split("\n") if x.strip()]


def automaton() -> ahocorasick.Automaton:
    """Pattern to a list of (length, kind): a kind of phrase, a word of pseudo-Latin, or what a mark opens and closes."""
    found: dict[str, list[tuple]] = {}
    for kind, block in (("error", phrases.ERROR_PHRASES), ("script", phrases.SCRIPT_PHRASES), ("filler", phrases.FILLER_PHRASES), ("placeholder", phrases.MARK_PHRASES)):
        for phrase in _lines(block):
            found.setdefault(phrase, []).append((len(phrase), kind))
    for i, (start, end) in enumerate(phrases.MARK_PAIRS):
        found.setdefault(start, []).append((len(start), "open", i))
        found.setdefault(end, []).append((len(end), "close", i))
    for word in phrases.FILLER_WORDS.split():
        if len(word) > 3:
            found.setdefault(word, []).append((len(word), "latin"))
    for prefix in phrases.MARK_PREFIXES:
        found.setdefault(prefix, []).append((len(prefix), "prefix"))
    a = ahocorasick.Automaton()
    for pattern, what in found.items():
        a.add_word(pattern, what)
    a.make_automaton()
    return a


def _letters(text: str) -> int:
    return sum(map(str.isalnum, text))


class ResidueMatcher:
    """``coverage(line)``: the share of a line's letters and digits that residue covers, and the leading kind."""

    def __init__(self):
        self.auto = automaton()
        self.filler = frozenset(phrases.FILLER_WORDS.split())
        self.empty = frozenset(phrases.NOTICE_WORDS.split())
        self.memo = Memo(self.coverage, 60_000)

    def __reduce__(self):
        return (ResidueMatcher, ())

    def coverage(self, line: str) -> tuple[float, str | None]:
        text = _DIGITS.sub("0", line.lower().translate(_QUOTES))
        spans, marks, open_at, kinds, latin = [], [], {}, {}, 0
        for end, what in self.auto.iter(text):
            end += 1
            for item in what:
                size, kind = item[:2]
                start = end - size
                if kind == "close":
                    at = open_at.pop(item[2], None)
                    if at is not None and at[1] <= start and start - at[1] <= LONGEST_MARK:
                        marks.append((at[0], end))
                        continue
                    if phrases.MARK_PAIRS[item[2]][0] == phrases.MARK_PAIRS[item[2]][1]:  # the same mark opens
                        open_at[item[2]] = (start, end)
                elif kind == "open":
                    if phrases.MARK_PAIRS[item[2]][0] != phrases.MARK_PAIRS[item[2]][1]:
                        open_at[item[2]] = (start, end)
                elif kind == "prefix":
                    name = _NAME.match(text, end)
                    if name:
                        marks.append((start, name.end()))
                elif (start and text[start].isalnum() and text[start - 1].isalnum()) or (end < len(text) and text[end - 1].isalnum() and text[end].isalnum()):
                    continue  # inside a word
                elif kind == "latin":
                    latin += 1
                elif kind == "placeholder":
                    marks.append((start, end))
                else:
                    spans.append((start, end))
                    kinds[kind] = kinds.get(kind, 0) + size
        if marks:
            rest, at = [], 0
            for a, b in sorted(marks):
                rest += _TOKENS.findall(text[at:a]) if a > at else []
                at = max(at, b)
            rest += _TOKENS.findall(text[at:])
            # A frame of a few fixed words around each mark holds nothing once the marks are taken away.
            if len(rest) <= WORDS_A_MARK * len(marks):
                return 1.0, "placeholder"
            if not spans:
                return len(marks) / (len(marks) + len(rest)), "placeholder"
        if not spans and latin < 2:
            return 0.0, None
        words = [(m.start(), m.end(), m[0]) for m in _TOKENS.finditer(text)]
        if latin > 1 and sum(w in self.filler for _, _, w in words) > LATIN_SHARE * len(words) and not any(len(w) > 3 and w in self.empty for _, _, w in words):
            return 1.0, "filler"
        if not spans:
            return 0.0, None
        spans += [(a, b) for a, b, w in words if w in self.empty or w.isdigit() or (len(w) > 1 and w == w[0] * len(w))]
        solid, covered, reach = _letters(text) or 1, 0, 0
        for a, b in sorted(spans):
            a = max(a, reach)
            if b > a:
                covered += _letters(text[a:b])
                reach = b
        return min(1.0, covered / solid), max(kinds, key=kinds.get)
