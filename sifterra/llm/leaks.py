"""Evaluation items inside training text: a BM25 index of the items with block-max pruning, queried by every passage."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, map_rows
from sifterra.session import spread

_RUN = regex.compile(r"[\p{L}\p{M}\p{Nd}]+")


def _digit(c: str) -> str:
    return str(unicodedata.decimal(c)) if unicodedata.category(c) == "Nd" else c


def normal_word(word: str) -> str:
    return "".join(_digit(c) for c in word.casefold()) if not word.isascii() else word.casefold()


def runs(text: str) -> list[str]:
    """Unbroken runs of letters, combining marks and digits, in NFC; not yet folded."""
    return _RUN.findall(text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text))


#: Shares are single-precision sums; what is this near to 1 reaches it. The exact check follows.
_NEAR = 1 - 1e-4
_ODD = np.random.default_rng(8).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n words in a row."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    rows = np.lib.stride_tricks.sliding_window_view(ids.astype(np.uint64) + np.uint64(1), n)
    mixed = (rows * np.resize(_ODD, n)).sum(1, dtype=np.uint64)
    return mixed ^ (mixed >> np.uint64(29))


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places of several ranges, one after the other."""
    sizes = end - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def _sums(keys: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur and the sum of each one's values: on an array of all keys where those are few, else by sorting."""
    if size <= 8 * len(keys):
        total = np.bincount(keys, values, size)
        some = np.flatnonzero(total)
        return some, total[some]
    some, place = np.unique(keys, return_inverse=True)
    return some, np.bincount(place, values, len(some))


class ItemIndex:
    """Inverted index of item parts (question, gold answer) with block maxima, in blocks of ``block`` parts.

    A part's threshold is the least BM25 score that any ``least`` of its words in a row give, so a
    passage that holds such a run always reaches it: pruning loses nothing. Scores are stored as shares of
    their part's threshold, so that one bound, 1, holds for all parts. All is sparse: what is held grows with
    the items' words. Parts are numbered by threshold, so that those of one block have alike ones.
    """

    def __init__(self, items: list[tuple[int, list[str]]], least: int = 10, block: int = 4, k1: float = 1.2, b: float = 0.75):
        self.least, self.block = least, block
        parts = []
        for item, texts in items:
            for t in texts:
                words = [normal_word(w) for w in runs(t or "")]
                if len(words) >= least:
                    parts.append((item, words))
        df = Counter(w for _, words in parts for w in set(words))
        self.vocab = {w: i for i, w in enumerate(sorted(df))}
        n, avg = len(parts), (sum(len(w) for _, w in parts) / len(parts) if parts else 1.0)
        idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
        scored = []
        for item, words in parts:
            part = {w: idf[w] * f * (k1 + 1) / (f + k1 * (1 - b + b * len(words) / avg)) for w, f in Counter(words).items()}
            scored.append((min(sum(part[w] for w in set(words[i : i + least])) for i in range(len(words) - least + 1)), item, words, part))
        scored.sort(key=lambda x: (x[0], str(x[1])))
        self.items = [item for _, item, _, _ in scored]
        self.threshold = np.array([t for t, _, _, _ in scored])
        self.words = np.array([self.vocab[w] for _, _, words, _ in scored for w in words], np.int32)
        self.word_at = np.concatenate([[0], np.cumsum([len(words) for _, _, words, _ in scored], dtype=np.int64)])
        self.grams = np.concatenate([_grams(self.words[a:e], least) for a, e in zip(self.word_at, self.word_at[1:])]) if n else np.zeros(0, np.uint64)
        self.gram_at = self.word_at - np.arange(n + 1) * (least - 1)
        # Postings by block, for scoring; and by term the blocks that hold it with its greatest share there.
        self.term = np.array([self.vocab[w] for _, _, _, part in scored for w in part], np.int32)
        self.part = np.repeat(np.arange(n, dtype=np.int32), [len(part) for _, _, _, part in scored])
        self.share = np.array([s / t for t, _, _, part in scored for s in part.values()], np.float32)
        self.starts = np.searchsorted(self.part, np.arange(0, n + block, block))
        by = np.lexsort((self.part, self.term))
        key = self.term[by].astype(np.int64) * (n // block + 1) + self.part[by] // block
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.blocks = (self.part[by] // block)[first]
        self.most = np.maximum.reduceat(self.share[by], first) if len(first) else np.zeros(0, np.float32)
        self.lists = np.searchsorted(self.term[by][first], np.arange(len(self.vocab) + 1))
        self.top = np.maximum.reduceat(self.most, self.lists[:-1]) if len(self.vocab) else np.zeros(0, np.float32)
        self._start()

    def _start(self):
        self.ids = Memo(lambda w: self.vocab.get(normal_word(w), -1), 200_000)
        self.inside = np.zeros(len(self.vocab), bool)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("ids", "inside")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def size_in_bytes(self) -> int:
        """About what a worker holds of it."""
        return sum(x.nbytes for x in (self.term, self.part, self.share, self.blocks, self.most, self.words, self.grams)) + 120 * len(self.vocab)

    def candidates(self, terms: list[int] | set[int], lean: float = 0.75) -> list[tuple[int, float]]:
        """Parts whose score with this passage reaches their threshold, with the score.

        Block-max WAND, lists by lists: in order of their greatest shares, the lists before the pivot can't bring a part to
        ``lean`` together, so only blocks of the lists from the pivot on come up; a block whose maxima there
        and the bound of the lists before leave it under 1 is dead. Postings are read in live blocks only.
        """
        ts = np.fromiter(terms, np.int64, len(terms))
        if not len(ts):
            return []
        top = self.top[ts]
        order = np.argsort(top, kind="stable")
        ts, reach = ts[order], np.cumsum(top[order], dtype=float)
        if reach[-1] < _NEAR:
            return []
        pivot = int(np.searchsorted(reach, lean))
        before = float(reach[pivot - 1]) if pivot else 0.0
        at = _ranges(self.lists[ts[pivot:]], self.lists[ts[pivot:] + 1])
        blocks, most = _sums(self.blocks[at], self.most[at], len(self.starts))
        live = blocks[most + before >= _NEAR]
        if not len(live):
            return []
        at = _ranges(self.starts[live], self.starts[live + 1])
        self.inside[ts] = True
        at = at[self.inside[self.term[at]]]
        self.inside[ts] = False
        parts, score = _sums(self.part[at], self.share[at], len(self.items))
        good = score >= _NEAR
        return [(int(p), float(s * self.threshold[p])) for p, s in zip(parts[good], score[good])]

    def passages(self, ids: list[int], window: int):
        """Stretches without a word that no item has, of ``least`` words or more, cut into windows that overlap by ``least - 1`` words, so no run is cut."""
        least, start = self.least, 0
        ids.append(-1)
        while start + least < len(ids):
            try:
                end = ids.index(-1, start)
            except ValueError:
                break
            for a in range(start, end - least + 1, window - least + 1):
                yield ids[a : min(a + window, end)]
            start = end + 1

    def search(self, text: str, window: int = 128) -> dict[int, float]:
        """Items with a run of ``least`` words in the text, each with its best passage score."""
        found: dict[int, float] = {}
        for part in self.passages(list(map(self.ids.__getitem__, runs(text))), window):
            cand = self.candidates(set(part))
            if not cand:
                continue
            ids = np.array(part, np.int32)
            parts = np.array([p for p, _ in cand])
            sizes = self.gram_at[parts + 1] - self.gram_at[parts]
            same = np.isin(self.grams[_ranges(self.gram_at[parts], self.gram_at[parts + 1])], _grams(ids, self.least))
            hits = np.logical_or.reduceat(same, np.cumsum(sizes) - sizes)
            for j in np.flatnonzero(hits):
                p, score = cand[j]
                item = self.items[p]
                if found.get(item, -1.0) < score and self.shares_run(p, part):
                    found[item] = score
        return found

    def shares_run(self, p: int, ids: list[int]) -> bool:
        """Whether a part and a passage have ``least`` words in a row in common, word by word."""
        n, own = self.least, self.words[self.word_at[p] : self.word_at[p + 1]].tolist()
        runs_ = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        return any(tuple(ids[i : i + n]) in runs_ for i in range(len(ids) - n + 1))


def leaked_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", fields: tuple[str, ...] = ("question", "gold_answer"), least: int = 10, shard: int = 200_000, most_bytes: int = 512 << 20) -> DataFrame:
    """One row per (item, document) where the document holds ``least`` or more words in a row of one of the item's fields.

    All items are indexed. The index grows with their words (some 1.2 kB an item) and is broadcast only within
    ``most_bytes``: sets of more than ``shard`` items, or beyond those bytes, are indexed in shards by the hash of their id,
    each a further pass over the documents.
    Null and empty texts and items match nothing; parts shorter than ``least`` words can't match; duplicate
    items or rows give the row again unless the caller takes distinct rows. Other columns are ignored.
    """
    rows = items.select(item_key, *fields).distinct()
    count = rows.count()
    shards = max(1, -(-count // shard))
    out = None
    kinds = dict(docs.dtypes)[key], dict(items.dtypes)[item_key]
    waiting = [(n, shards) for n in range(shards)]
    while waiting:
        n, of = waiting.pop(0)
        own = rows if of == 1 else rows.where(F.pmod(F.xxhash64(item_key), F.lit(of)) == n)
        index = ItemIndex([(r[0], list(r[1:])) for r in sorted(own.collect(), key=lambda r: str(r[0]))], least)
        if index.size_in_bytes() > most_bytes and len(set(index.items)) > 1:
            waiting += [(n, 2 * of), (n + of, 2 * of)]
            continue
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared):
            found = shared.value

            def one(k, t):
                if t:
                    for item, score in found.search(t).items():
                        yield item, k, score

            return one

        part = map_rows(spread(docs).select(F.col(key), F.col(text)), make, f"{item_key} {kinds[1]}, {key} {kinds[0]}, score double")
        out = part if out is None else out.unionByName(part)
    return out
