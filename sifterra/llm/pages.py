"""Main body of pages (a linear-chain CRF over blocks) and pages without content."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, map_slices
from sifterra.llm.residue import ResidueMatcher
from sifterra.session import bounded_sample, few_files, spread

#: BODY alone is the page's own content; the others are kinds of furniture.
LABELS = ["BODY", "BANNER", "MENU", "CRUMB", "NOTICE", "TOOLS", "SIDEHEAD", "SIDELINK", "PREVNEXT", "FOOTER"]
_AT = {x: i for i, x in enumerate(LABELS)}
BUCKETS = 1 << 15
RESIDUE_SHARE = 0.6

# Menu entries, sidebar headings and other wordings of site furniture, for labelling the training pages.
MENU_ENTRIES = frozenset(
    x.strip().lower()
    for x in """Home|About Us|Notices|Downloads|Contact|Gallery|FAQ|Services|Staff|Login|Publications|Tenders|Sitemap|Acts and Rules|Citizen Charter|Organisation Chart
|Right to Information|English|Nepali|Search|New!|News|Careers|Help|Feedback|गृहपृष्ठ|हाम्रो बारेमा|सूचना|डाउनलोड|सम्पर्क|ग्यालरी|प्रश्नोत्तर|सेवाहरू|कर्मचारी|लगइन|प्रकाशन|बोलपत्र
|साइटम्याप|ऐन नियम|नागरिक वडापत्र|सङ्गठन संरचना|सूचनाको हक|नेपाली|खोज्नुहोस्|नयाँ!|Test your connection""".replace("\n", "").split("|")
)
SIDE_HEADINGS = frozenset(
    x.strip().lower()
    for x in "Popular Posts|You may also like|Related Notices|Latest News|Recent Downloads|Quick Links|Related Links|Recent Posts|See also|ताजा सूचना|सम्बन्धित लिङ्कहरू|लोकप्रिय|ताजा समाचार|सम्बन्धित सूचना".split("|")
)
_NOTICE = re.compile(r"(?i)cookie|कुकी|stores small files on your device|your privacy matters|javascript|script-capable|scripts (?:are|have)|map could not be loaded|नक्सा लोड|loading|browser before you continue")
_TOOLS = re.compile(r"(?i)^(?:tweet|share|सेयर)\b.*(?:\||:)|^a\+ a a-|print page|email this page|^like us on|follow the .* channel|^skip to|सामग्रीमा जानुहोस्|newsletter|^back to top")
_FOOTER = re.compile(
    r"(?i)^visitors?\b|आगन्तुक|©|^copyright|all rights reserved|सर्वाधिकार|^powered by|cms version|best viewed|^last updated|^office hours|^privacy policy|^phone:|\| fax:|terms of use|^designed by|items in the archive"
)
_PREVNEXT = re.compile(r"(?i)^(?:previous|next|prev|अघिल्लो|अर्को|पछिल्लो)\s*:|^[«‹<←]|[»›→]$")
_OFFICE = re.compile(r"^[A-Z][\w’' -]+, [A-Z]\w+$|^government portal of|(?:नियोग|कार्यालय|नगरपालिका|सँगालो|सचिवालय|मन्त्रालय|अभिलेखालय)$", re.I)
_SEPARATOR = re.compile(r"\s*[|»›>·•]\s*|\s+/\s+|\s{2,}")
_ITEM = re.compile(r"(?i)^(?:copy of|two photos|letter from|fee:|time:|counter \d|contact person:|home address|दस्तुर:|लाग्ने समय:|जिम्मेवार:)|को प्रतिलिपि$|को फोटो|प्रति$|floor$|^[\d०-९]+\.")
_LONG_ENTRIES = re.compile("|".join(re.escape(x) for x in sorted(MENU_ENTRIES, key=lambda x: (-len(x), x)) if " " in x or len(x) > 3))
_STOP = re.compile(r"[.।!?:;]['\"”’)]?$")
_DIGITS = re.compile(r"[0-9०-९]+")


def _all_menu(line: str) -> bool:
    low = line.strip().lower()
    if low in MENU_ENTRIES:
        return True
    if _STOP.search(low):
        return False
    parts = [p.strip().lower() for p in _SEPARATOR.split(line) if p.strip()]
    if len(parts) > 1 and sum(p in MENU_ENTRIES for p in parts) >= 0.6 * len(parts):
        return True
    return len(low) > 20 and len(_LONG_ENTRIES.sub(" ", low).split()) <= 1


_MENU = Memo(_all_menu, 60_000)


def seed_labels(lines: list[str], title: str | None, residue: ResidueMatcher) -> list[int]:
    """Labels for a training page from the wordings above and the order of blocks."""
    head = (title or "").strip()
    out: list[int] = []
    side, headline = False, False
    for i, raw in enumerate(lines):
        line = raw.strip()
        low = line.lower()
        crumb = _SEPARATOR.split(line)
        lab = "BODY"
        if _MENU[line]:
            lab = "MENU"
        elif low in SIDE_HEADINGS:
            lab = "SIDEHEAD"
        elif _FOOTER.search(line):
            lab = "FOOTER"
        elif _TOOLS.search(line):
            lab = "TOOLS"
        elif _PREVNEXT.search(line) and len(line) < 160:
            lab = "PREVNEXT"
        elif len(crumb) > 1 and len(line) < 250 and (crumb[0].strip().lower() in MENU_ENTRIES and (line.endswith(head) if head else True)):
            lab = "CRUMB"
        elif len(line) < 150 and (_NOTICE.search(line) or residue.coverage(line)[0] >= RESIDUE_SHARE):
            lab = "NOTICE"
        elif i <= 2 and len(line) < 80 and not _STOP.search(line) and _OFFICE.search(line) and line != head:
            lab = "BANNER"
        elif side and not _STOP.search(line) and not _ITEM.search(line) and 2 <= len(line.split()) <= 12 and not (line == head and not headline):
            lab = "SIDELINK"
        side = lab in ("SIDEHEAD", "SIDELINK")
        headline |= lab == "BODY" and line == head
        out.append(_AT[lab])
    return out


_HASHES = Memo(lambda text: zlib.crc32(text.encode()) % BUCKETS, 200_000)
_hash = _HASHES.__getitem__


def _text_features(line: str) -> tuple[int, ...]:
    """Features that depend on the block's own text only: every distinct word counts, wherever it stands and however long the block is."""
    low = line.strip().lower()
    words = low.split()
    n = len(words)
    own = [_WORD_AT["w"][w] for w in words]
    f = [f"n={min(n, 6) if n < 7 else 7 + (n > 12) + (n > 25)}", f"c={min(len(line) // 20, 8)}"]
    if words:
        own += [_WORD_AT["first"][words[0]], _WORD_AT["last"][words[-1]], _WORD_AT["two"][" ".join(words[:2])], _WORD_AT["end2"][" ".join(words[-2:])]]
    f.append("stop=" + (low[-1:] if _STOP.search(low[-4:]) else "none"))
    f += [name for name, mark in _MARKS if mark in low]
    if _DIGITS.search(low):
        f.append("has=digit")
    short = n <= 20
    if short:
        f.append("line=" + _DIGITS.sub("0", low))
    f.append("item" if short and _ITEM.search(line) else "noitem")
    parted = any(c in low for c in "|»›>·•") or " / " in low or "  " in low
    f.append(f"parts={min(sum(map(bool, _SEPARATOR.split(low))), 4) if parted else 1}")
    f.append(f"menu={_MENU[line.strip()]}")
    return tuple(dict.fromkeys([*own, *map(_hash, f)]))


# Digits count alike.
_WORD_AT = {kind: Memo(lambda w, kind=kind: _hash(f"{kind}={_DIGITS.sub('0', w)}"), 100_000) for kind in ("w", "first", "last", "two", "end2")}
_MARKS = [("has=" + name, mark) for name, mark in (("bar", "|"), ("guil", "»"), ("gt", ">"), ("slash", " / "), ("copy", "©"), ("colon", ":"), ("at", "@"), ("double", "  "), ("comma", ", "), ("dots", "..."), ("left", "«"))]


#: How a block ends and its number of words, in three sizes; and what may stand where no block is.
SHAPES = [end + size for end in ("stop", "open") for size in "012"]
TITLE_KINDS = ["title=again", "title=first", "title=ends", "notitle", "untitled"]
TAIL = 7


class PageTagger:
    """CRF weights and the features; memoises each text's own score, adds those of its place, decodes by Viterbi, a batch of pages at a time."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.weights, self.trans, self.start, self.end = weights, trans, start, end
        self._start()

    def _start(self):
        w = lambda *names: self.weights[[_hash(n) for n in names]].sum(0)
        self.own = Memo(lambda line: (w_own(self.weights, line), _shape(line), line.strip()), 60_000)
        self.by_tag = Memo(lambda path: self.weights[[_hash(f) for f in tag_features(path)]].sum(0), 20_000)
        self.at_head = np.array([w(f"pos={i}") for i in (0, 1, 2, 3, "mid")])
        self.at_tail = np.array([w(f"tail={i}") for i in (*range(TAIL), "far")])
        self.after = np.array([[w("prev=" + p, f"self={s}/{p}") for p in (*SHAPES, "^")] for s in SHAPES])
        self.ahead = np.array([w("next=" + n) for n in (*SHAPES, "$")])
        self.titles = np.array([w(t) for t in TITLE_KINDS[:4]] + [np.zeros(self.weights.shape[1])])

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("weights", "trans", "start", "end")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def scores(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all blocks of some pages, one after the other, and the first block of each page. A page is (blocks, title) or (blocks, title, tag paths)."""
        sizes = np.array([len(p[0]) for p in pages])
        first = np.concatenate([[0], np.cumsum(sizes)])
        own = [self.own[line] for p in pages for line in p[0]]
        out = np.array([x[0] for x in own])
        shape = np.array([x[1] for x in own])
        at = np.arange(first[-1]) - np.repeat(first[:-1], sizes)
        left = np.repeat(sizes, sizes) - 1 - at
        out += self.at_head[np.minimum(at, 4)] + self.at_tail[np.minimum(left, TAIL)]
        none = len(SHAPES)
        before, behind = np.concatenate([[none], shape[:-1]]), np.concatenate([shape[1:], [none]])
        before[at == 0], behind[left == 0] = none, none
        out += self.after[shape, before] + self.ahead[behind]
        title = np.empty(len(shape), np.int64)
        for p, a in zip(pages, first):
            title[a : a + len(p[0])] = title_kinds([x[2] for x in own[a : a + len(p[0])]], p[1])
            if len(p) > 2 and p[2]:
                out[a : a + len(p[0])] += np.array([self.by_tag[path or ""] for path in p[2]])
        return out + self.titles[title], first

    def tag_all(self, pages: list[tuple], batch: int = 128) -> list[list[int]]:
        """The best path of labels of each page: Viterbi over pages of similar length at once."""
        out: list[list[int]] = [[] for _ in pages]
        order = sorted((i for i, p in enumerate(pages) if p[0]), key=lambda i: len(pages[i][0]))
        for a in range(0, len(order), batch):
            chosen = order[a : a + batch]
            score, first = self.scores([pages[i] for i in chosen])
            sizes = np.diff(first)
            longest, rows = int(sizes[-1]), np.arange(len(chosen))
            best = score[first[:-1]] + self.start
            last = np.where((sizes == 1)[:, None], best, 0.0)
            backs = np.zeros((longest, len(chosen), len(self.start)), np.int64)
            for j in range(1, longest):
                on = sizes > j
                m = best[on, :, None] + self.trans
                backs[j, on] = m.argmax(1)
                best[on] = m.max(1) + score[first[:-1][on] + j]
                ended = sizes == j + 1
                last[ended] = best[ended]
            label = (last + self.end).argmax(1)
            path = np.zeros((longest, len(chosen)), np.int64)
            for j in range(longest - 1, -1, -1):
                on = sizes > j
                path[j, on] = label[on]
                if j:
                    label = np.where(on, backs[j, rows, label], label)
            for c, i in enumerate(chosen):
                out[i] = path[: sizes[c], c].tolist()
        return out

    def tag(self, lines: list[str], title: str | None, tags: list[str] | None = None) -> list[int]:
        return self.tag_all([(lines, title, tags)])[0]


def w_own(weights: np.ndarray, line: str) -> np.ndarray:
    return weights.take(_text_features(line), 0).sum(0)


def _shape(line: str) -> int:
    n = len(line.split())
    return (0 if _STOP.search(line.strip()) else 3) + (0 if n < 4 else 1 if n < 13 else 2)


def title_kinds(stripped: list[str], title: str | None) -> list[int]:
    """How each block stands to the page's title, as places in ``TITLE_KINDS``."""
    head = (title or "").strip()
    if not head:
        return [3] * len(stripped)
    out, seen = [], False
    for s in stripped:
        if s == head:
            out.append(0 if seen else 1)
            seen = True
        else:
            out.append(2 if s.endswith(head) else 4)
    return out


def tag_features(path: str) -> list[str]:
    """Features of a leaf block's ancestors, outermost first (``html/body/div/ul/li``): each tag, the innermost two and the last. '' has none."""
    parts = [p for p in path.lower().split("/") if p]
    return ["in=" + p for p in dict.fromkeys(parts)] + (["leaf=" + parts[-1], "leaves=" + "/".join(parts[-2:])] if parts else [])


def place_features(lines: list[str], title: str | None, tags: list[str] | None = None):
    """Names of a block's features besides those of its own text."""
    n = len(lines)
    shapes = [SHAPES[_shape(line)] for line in lines]
    kinds = title_kinds([line.strip() for line in lines], title)
    for i in range(n):
        before = shapes[i - 1] if i else "^"
        f = [f"pos={i if i < 4 else 'mid'}", f"tail={n - 1 - i if n - 1 - i < TAIL else 'far'}", "prev=" + before, "next=" + (shapes[i + 1] if i + 1 < n else "$"), f"self={shapes[i]}/{before}"]
        if kinds[i] < 4:
            f.append(TITLE_KINDS[kinds[i]])
        yield f + (tag_features(tags[i] or "") if tags else [])


def train_tagger(pages: list[tuple], epochs: int = 5, rate: float = 0.3, l2: float = 1e-5, batch: int = 64, seed: int = 1) -> PageTagger:
    """Maximum conditional likelihood by AdaGrad: forward-backward over padded batches of pages. A page is (blocks, title, labels) or (blocks, title, labels, tag paths)."""
    k = len(LABELS)
    w, t = np.zeros((BUCKETS, k)), np.zeros((k, k))
    start, end = np.zeros(k), np.zeros(k)
    acc = [np.full(x.shape, 1e-3) for x in (w, t, start, end)]
    memo = Memo(_text_features, 100_000)
    data = []
    for lines, title, y, *tags in pages:
        feats = [np.array([*memo[line], *map(_hash, names)]) for line, names in zip(lines, place_features(lines, title, *tags))]
        data.append((feats, np.array(y)))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), batch):
            chosen = [data[i] for i in order[a : a + batch]]
            b, longest = len(chosen), max(len(y) for _, y in chosen)
            rows = [row for feats, _ in chosen for row in feats]
            idx, sizes = np.concatenate(rows), np.array([len(row) for row in rows])
            owner = np.repeat(np.arange(len(rows)), sizes)
            flat = np.add.reduceat(w.take(idx, 0), np.cumsum(sizes) - sizes)
            e, mask, y = np.zeros((b, longest, k)), np.zeros((b, longest), bool), np.zeros((b, longest), int)
            at = 0
            for r, (_, labels) in enumerate(chosen):
                m = len(labels)
                e[r, :m], mask[r, :m], y[r, :m] = flat[at : at + m], True, labels
                at += m
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0] + start
            for j in range(1, longest):
                nxt = _lse(alpha[:, j - 1, :, None] + t, 1) + e[:, j]
                alpha[:, j] = np.where(mask[:, j, None], nxt, alpha[:, j - 1])
            beta[:, longest - 1] = end
            for j in range(longest - 2, -1, -1):
                nxt = _lse(t + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
                beta[:, j] = np.where(mask[:, j + 1, None], nxt, end)
            z = _lse(alpha[:, -1] + end, 1)
            p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
            gold = np.zeros_like(p)
            np.put_along_axis(gold, y[:, :, None], 1.0, 2)
            gold *= mask[:, :, None]
            miss = (p - gold)[mask].take(owner, 0)
            gw = np.stack([np.bincount(idx, miss[:, c], BUCKETS) for c in range(k)], 1)
            gt = np.zeros_like(t)
            for j in range(1, longest):
                on = mask[:, j]
                if on.any():
                    q = np.exp(alpha[on, j - 1, :, None] + t + (e[on, j] + beta[on, j])[:, None, :] - z[on, None, None])
                    gt += q.sum(0)
                    np.add.at(gt, (y[on, j - 1], y[on, j]), -1.0)
            last = mask.sum(1) - 1
            gs = (p - gold)[:, 0].sum(0)
            ge = (p - gold)[np.arange(b), last].sum(0)
            for x, g, c in ((w, gw, acc[0]), (t, gt, acc[1]), (start, gs, acc[2]), (end, ge, acc[3])):
                g = g / b + l2 * x
                c += g * g
                x -= rate * g / np.sqrt(c)
    return PageTagger(w, t, start, end)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def fit_page_tagger(pages: DataFrame, bound: int = 2000, key: str = "page_id", labels: str | None = None, tags: str | None = None) -> PageTagger:
    """Train on at most ``bound`` pages, chosen by the hash of their key.

    ``labels`` names an array column with one of ``LABELS`` for each block; without it the wordings and orders of
    ``seed_labels`` label the pages. ``tags`` names an array column with each block's path of ancestor tags.
    """
    columns = ["title", "extracted_text", *(c for c in (labels, tags) if c)]
    rows = bounded_sample(few_files(pages).select(key, *columns), [key], bound)
    residue = ResidueMatcher()
    data = []
    for r in sorted(rows, key=lambda r: str(r[0])):
        lines = (r[2] or "").split("\n")
        if not (r[2] and any(x.strip() for x in lines)):
            continue
        y = [_AT.get(x, 0) for x in r[labels]] if labels and r[labels] else None if labels else seed_labels(lines, r[1], residue)
        paths = r[tags] if tags else None
        if y and len(y) == len(lines) and (paths is None or len(paths) == len(lines)):
            data.append((lines, r[1], y, paths) if tags else (lines, r[1], y))
    if not data:
        k = len(LABELS)
        return PageTagger(np.zeros((BUCKETS, k)), np.zeros((k, k)), np.eye(k)[0], np.zeros(k))
    return train_tagger(data)


def _solid(line: str) -> int:
    """Characters but blanks."""
    return len(line) - line.count(" ")


def residue_of(lines: list[str], labels: list[int], title: str | None, residue: ResidueMatcher, least: float = RESIDUE_SHARE) -> tuple[bool, str | None, float]:
    """Whether what a page holds besides furniture and its headline is residue: the matched share of its length reaches ``least``. (shell, leading kind, share)

    A page with nothing left counts where its furniture holds residue. Reading ends once the share can't be reached.
    """
    head = (title or "").strip()
    own = [line for line, lab in zip(lines, labels) if lab == 0 and line.strip() and line.strip() != head]
    total, bare, covered = sum(map(_solid, own)), 0, 0
    kinds: dict[str, int] = {}
    for line in own or [x for x, lab in zip(lines, labels) if lab]:
        share, kind = residue.memo[line]
        n = _solid(line)
        if share >= least:
            covered += n
            kinds[kind] = kinds.get(kind, 0) + n
        elif own:
            bare += n
            if bare > (1 - least) * total:
                return False, None, 0.0
    if not covered:
        return False, None, 0.0
    return True, max(kinds, key=kinds.get), covered / total if own else 1.0


def read_pages(pages: list[tuple], tagger: PageTagger, residue: ResidueMatcher) -> list[tuple[list[str], list[int], bool, str | None, float]]:
    """Of each (title, text) or (title, text, tag paths): lines, labels, whether the page is a shell, the residue's kind and its share of what is not furniture. Null and blank texts have no lines."""
    blocks = [((p[1] or "").split("\n") if (p[1] or "").strip() else [], p[0]) for p in pages]
    paths = [p[2] if len(p) > 2 and p[2] and len(p[2]) == len(b[0]) else None for p, b in zip(pages, blocks)]
    out = []
    for (lines, title), labels in zip(blocks, tagger.tag_all([(*b, t) for b, t in zip(blocks, paths)])):
        out.append((lines, labels, *residue_of(lines, labels, title, residue)))
    return out


def _page_columns(pages: DataFrame, key: str, tags: str | None) -> DataFrame:
    return spread(pages).select(F.col(key), "title", "extracted_text", *([F.col(tags)] if tags else []))


def page_blocks(pages: DataFrame, tagger: PageTagger, key: str = "page_id", tags: str | None = None) -> DataFrame:
    """One row per line: ``line_no`` (from 1), ``block`` (a label), ``is_body``, ``shell`` (the page has no content).

    ``tags`` names an array column with each line's path of ancestor tags (see ``html_blocks``). Null and blank texts
    give no row; repeated rows give repeated rows; extra columns are ignored. No shuffle.
    """
    residue = ResidueMatcher()

    def make():
        def some(rows):
            for (k, *_), (lines, labels, shell, _, _) in zip(rows, read_pages([r[1:] for r in rows], tagger, residue)):
                for no, (line, lab) in enumerate(zip(lines, labels), 1):
                    if line.strip():
                        yield k, no, LABELS[lab], lab == 0, shell

        return some

    kind = dict(pages.dtypes)[key]
    return map_slices(_page_columns(pages, key, tags), make, f"{key} {kind}, line_no int, block string, is_body boolean, shell boolean")


def main_text(pages: DataFrame, tagger: PageTagger, key: str = "page_id", tags: str | None = None) -> DataFrame:
    """One row per page: the text of its main body ('' for a shell, null for a null text)."""
    residue = ResidueMatcher()

    def make():
        def some(rows):
            for (k, _, text, *_), (lines, labels, shell, _, _) in zip(rows, read_pages([r[1:] for r in rows], tagger, residue)):
                yield k, None if text is None else "" if shell else "\n".join(x for x, lab in zip(lines, labels) if lab == 0), shell

        return some

    kind = dict(pages.dtypes)[key]
    return map_slices(_page_columns(pages, key, tags), make, f"{key} {kind}, body string, shell boolean")


def shell_pages(pages: DataFrame, tagger: PageTagger, key: str = "page_id", tags: str | None = None) -> DataFrame:
    """One row per page without real content: the kind of residue and its share of what isn't furniture.

    A page counts when lines covered by residue make up ``RESIDUE_SHARE`` of its length, furniture and headline
    apart. Script counts and shell flags are hints with errors both ways and decide nothing.
    """
    residue = ResidueMatcher()

    def make():
        def some(rows):
            for (k, *_), (_, _, shell, kind, share) in zip(rows, read_pages([r[1:] for r in rows], tagger, residue)):
                if shell:
                    yield k, kind, share

        return some

    kind = dict(pages.dtypes)[key]
    return map_slices(_page_columns(pages, key, tags), make, f"{key} {kind}, residue_kind string, residue_share double")
