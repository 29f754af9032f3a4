"""Evaluation texts leaking into training text.

Method: pigeonhole edit matching. A passage of MIN_WORDS consecutive words of an item may differ by at most `budget` words
(inserted, left out or replaced). Each item is split into adjacent pieces so short that any such passage, wherever it begins,
holds budget + 1 whole pieces, one more than errors can spoil. Exact hits of pieces in a
text are found by hash. Hits whose surroundings can't hold a passage within the budget are put aside by comparing words left
and right of the piece, over all hits of many texts at once; around each of the others the distance between every passage
that holds the piece and the text is computed by Myers' bit-parallel algorithm over words. Distance 0 means that the passage
is in the text as it is.

Words are runs of letters and digits in consistent form and lower case; whatever is between them is ignored. The items are a
stated query set: they meet all documents in blocks of some BLOCK characters, each block's pieces broadcast.

Defined results: null texts, questions and answers, and those of fewer than MIN_WORDS words, give nothing; a repeated
document row or item counts once; documents with equal texts are each reported; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, lower_codes, mix, polynomial, read, spans

MIN_WORDS, BLOCK = 12, 20_000_000
#: Characters of text that are looked at together.
TOGETHER = 1 << 16
SCHEMA = "doc_id bigint, item_uid string, part string, distance int"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and the text of each."""
    joined = "\n".join(t.replace("\n", " ") for t in texts)
    _, c, kinds = lower_codes(joined)
    starts, ends = spans((kinds & WORD > 0) & (c != ord("_")))
    sums, inverse = polynomial(c)
    x = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return x, np.searchsorted(np.flatnonzero(c == 10), starts)


def piece_length(min_words: int, budget: int) -> int:
    """Any min_words consecutive words hold more than `budget` whole adjacent pieces of this length."""
    return max(1, (min_words + 1) // (budget + 2))


def least_run(min_words: int, n: int, budget: int) -> int:
    """Of the stretches that `budget` changed words leave of a passage, the longest that holds a whole piece of n words has at least so many, wherever the passage begins and the changes are."""
    if budget > 2:
        return n
    least = min_words
    for first in range(n):  # place of the first whole piece
        for spoilt in itertools.combinations(range(min_words), budget):
            edges = [-1, *spoilt, min_words]
            runs = [b - a - 1 for a, b in itertools.pairwise(edges) if (a + 1 - first + n - 1) // n * n + first + n <= b]
            least = min(least, max(runs))
    return least


def hashes(x: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    m = max(0, len(x) - n + 1)
    total = x[:m].copy()
    for j in range(1, n):
        total = total * _STEP + x[j : m + j]
    return mix(total)


def myers(pattern: list, text: list) -> int:
    """Least edit distance, in words, of the pattern to any part of the text (Myers 1999; the bits of one integer are the pattern's places)."""
    m, at = len(pattern), {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for w in text:
        eq = at.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = (mv | ~(xh | pv)) & full, pv & xh
        score += (ph & top > 0) - (mh & top > 0)
        ph, mh = ph << 1 & full, mh << 1 & full  # a match may begin anywhere
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv
        best = min(best, score)
    return best


def passages(items: DataFrame, min_words: int) -> DataFrame:
    """(item_uid, part, passage) of the questions and answers."""
    part = [items.select(F.col("uid").alias("item_uid"), F.lit(p).alias("part"), F.col(p).alias("passage")) for p in ("question", "answer")]
    return part[0].unionByName(part[1]).filter(f"item_uid is not null and length(passage) >= {2 * min_words - 1}").distinct()


class Index:
    """The pieces of passages, sorted by hash: known, the bounds of each in entry; an entry is a place in row, the words of all passages, each followed by a word that no text holds."""

    def __init__(self, rows: list, min_words: int, budget: int):
        self.n, self.min_words, self.budget = piece_length(min_words, budget), min_words, budget
        self.least = least_run(min_words, self.n, budget)
        self.pad = 2 * min_words + budget + 4
        of, row, entry, at = [], [np.ones(self.pad, np.uint64)], [], self.pad
        for r in rows:
            x, _ = words([r["passage"]])
            if len(x) >= min_words:
                of.append((r["item_uid"], r["part"], at, at + len(x)))
                entry += range(at, at + len(x) - self.n + 1, self.n)
                row += [x, np.ones(1, np.uint64)]
                at += len(x) + 1
        self.names = [o[:2] for o in of]
        self.first, self.last = (np.array([o[k] for o in of], np.int64) for k in (2, 3))
        self.row = np.concatenate([*row, np.ones(self.pad, np.uint64)])
        entry = np.array(entry, np.int64)
        h = hashes(self.row, self.n)[entry]
        order = np.argsort(h, kind="stable")
        self.entry = entry[order]
        self.known, self.start = np.unique(h[order], return_index=True)
        self.start = np.append(self.start, len(order))

    def _equal(self, item: np.ndarray, text: np.ndarray, x: np.ndarray, step: int) -> np.ndarray:
        """How many words from the places on (in the direction of step) are equal in item and text, up to min_words."""
        k = step * np.arange(self.min_words)
        same = self.row[item[:, None] + k] == x[text[:, None] + k]
        return np.where(same.all(1), self.min_words, same.argmin(1))

    def _reach(self, item: np.ndarray, text: np.ndarray, x: np.ndarray, step: int, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of the item, at most `most`, that go on equally, and those with one word replaced, inserted or left out."""
        exact = np.minimum(self._equal(item, text, x, step), most)
        one = exact
        for a, b in ((1, 1), (0, 1), (1, 0)):
            more = self._equal(item + step * (exact + a), text + step * (exact + b), x, step)
            one = np.maximum(one, np.minimum(exact + a + more, most))
        return exact, one

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int]]:
        """(number of the text, number of the passage, distance) of the texts that hold a passage within the budget."""
        if not len(self.known):
            return
        words_, of = words(texts)
        place = np.arange(len(words_)) + (of + 1) * self.pad  # between texts, words that no item holds
        x = np.zeros(len(words_) + (len(texts) + 1) * self.pad, np.uint64)
        x[place] = words_
        h = hashes(x, self.n)
        k = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        at = np.flatnonzero(self.known[k] == h)
        many = self.start[k[at] + 1] - self.start[k[at]]
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(many) >> 18)) + 1):
            yield from self._verify(x, at[part], self.start[k[at[part]]], many[part], place, of)

    def _verify(self, x, at, start, many, place, of) -> Iterator[tuple[int, int, int]]:
        text = np.repeat(at, many)
        item = self.entry[np.repeat(start - np.cumsum(many) + many, many) + np.arange(len(text))]
        n, w = self.n, self.min_words
        if self.least > n:
            stay = (x[text - 1] == self.row[item - 1]) | (x[text + n] == self.row[item + n])
            text, item = text[stay], item[stay]
        if not len(text):
            return
        no = np.searchsorted(self.first, item, side="right") - 1
        exact = np.zeros(len(text), bool)
        if self.budget <= 1:
            right, right1 = self._reach(item + n, text + n, x, 1, self.last[no] - item - n)
            left, left1 = self._reach(item - 1, text - 1, x, -1, item - self.first[no])
            exact = left + n + right >= w
            stay = exact if not self.budget else exact | (left1 + n + right >= w) | (left + n + right1 >= w)
            text, item, no, exact = text[stay], item[stay], no[stay], exact[stay]
        doc = of[np.searchsorted(place, text)]
        found: dict[tuple[int, int], int] = {}
        for i in np.argsort(~exact, kind="stable").tolist():  # exact ones first
            k = int(doc[i]), int(no[i])
            if found.get(k, self.budget + 1):
                d = self._distance(x, int(text[i]), int(item[i]), k[1])
                if d <= self.budget:
                    found[k] = min(d, found.get(k, d))
        for (d, i), least in found.items():
            yield d, i, least

    def _distance(self, x: np.ndarray, text: int, item: int, no: int) -> int:
        """Least distance of the passages that hold the piece at `item` to the words around `text`."""
        w, k, best = self.min_words, self.budget, self.budget + 1
        around = x[text - w - k : text + w + k].tolist()
        own = self.row[item - w : item + w].tolist()
        for s in range(max(int(self.first[no]), item + self.n - w), min(item, int(self.last[no]) - w) + 1):
            begin = w + k + s - item
            best = min(best, myers(own[w + s - item : 2 * w + s - item], around[begin - k : begin + w + k]))
            if not best:
                break
        return best


def together(b: pd.DataFrame, size: int) -> Iterator[pd.DataFrame]:
    """The rows of b in stretches of about size characters."""
    if len(b):
        group = np.cumsum(b["text"].str.len().to_numpy()) // size
        for part in np.split(np.arange(len(b)), np.flatnonzero(np.diff(group)) + 1):
            yield b.iloc[part]


def leaks(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, budget: int = 1, block: int = BLOCK) -> DataFrame:
    """SCHEMA: the least distance, up to the budget, of a passage of the item's part to the document docs(doc_id, text)."""
    docs = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    of = passages(items, min_words)
    total = of.agg(F.sum(F.length("passage"))).first()[0] or 0
    blocks = max(1, -(-total // block))
    rows = None
    for i in range(blocks):
        sent = docs.sparkSession.sparkContext.broadcast(Index(of.filter(F.pmod(F.xxhash64("item_uid", "part", "passage"), F.lit(blocks)) == i).collect(), min_words, budget))

        def match(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = sent.value
            for b in batches:
                for part in together(b, TOGETHER):
                    ids = part["doc_id"].tolist()
                    yield pd.DataFrame([(ids[d], *index.names[no], least) for d, no, least in index.find(part["text"].tolist())], columns=["doc_id", "item_uid", "part", "distance"])

        one = docs.mapInPandas(match, SCHEMA)
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("doc_id", "item_uid", "part").agg(F.min("distance").alias("distance"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """The leaks at distance 0 of the same run as `p8_leaks`."""
    return p8_leaks(spark, sf).filter("distance = 0").select("doc_id", "item_uid").distinct()


def p8_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Leaks with up to one changed word, too."""
    return leaks(read(spark, sf, "documents"), read(spark, sf, "bench_items"))
