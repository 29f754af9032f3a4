"""Missing or wrong document language labels.

Method: for each language an interpolated Kneser-Ney model of character n-grams up to ORDER, within words (marked at both
ends; each Han character is a word of its own), stored in arrays sorted by n-gram hash. A sentence gets the language of the
lowest cross-entropy per character; it is rejected ("und") above the language's limit, calibrated on sentences held out from
fitting. A paragraph has the language of most of its non-blank characters, a document likewise. Confidence is the share of
characters in that language, times the mean probability of the language against the next best.

The models are fitted on a bounded sample of labelled rows: SAMPLE rows per label (MOST in all), those of the least hash of
doc_id, whole texts. Languages are the labels of two lower-case letters that stand for one: taken by their number of rows, the
model of a label must be clearly better on its texts than those of the labels before (one put on texts of other languages
fails that; see `true_labels`). As labels are partly wrong, sentences that the models ascribe to another language
are left out and the models fitted again. The vi model is fitted on words with and without marks. The limit of rejection is
SLACK times the QUANTILE of the cross-entropies of sentences held out, so that single odd ones don't move it.

Defined results: null and empty texts, and texts without letters, get no language and no rows in `wrong`; a repeated row
counts once; without labelled rows nothing can be fitted and no language is assigned; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import consistent, read

ORDER, SAMPLE, MOST, DISCOUNT, HELD_OUT, SLACK, QUANTILE, APART = 5, 400, 20_000, 0.75, 5, 1.5, 0.99, 0.3
ALPHABET = 1 << 16  # below order 1 all characters are as likely
_HAN = "㐀-䶿一-鿿豈-﫿"
_WORD = re.compile(rf"[{_HAN}]|[^\W\d_{_HAN}]+")
_SENTENCE = re.compile(r"(?<=[.!?。！？；;:])")
_POWER = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(ORDER)]


def words(t: str) -> list[str]:
    return _WORD.findall(t.lower())


def unmarked(w: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", w.replace("đ", "d")) if not unicodedata.combining(c))


def grams(ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of all characters (end mark included) of the words: hashes of the n-grams that end there, one row per order (0 where the word begins later), and the number of the word."""
    text = "".join(f"\x02{w}\x03" for w in ws)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(w) + 2 for w in ws])
    word = np.repeat(np.arange(len(ws)), length)
    place = np.arange(len(c)) - np.repeat(np.cumsum(length) - length, length)
    h = np.zeros((ORDER, len(c)), np.uint64)
    total = np.zeros(len(c), np.uint64)
    for k in range(ORDER):
        moved = np.zeros(len(c), np.uint64)
        moved[k:] = c[: max(0, len(c) - k)]
        total = total + (moved + np.uint64(7)) * _POWER[k]
        x = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k + 1)
        h[k] = np.where(place >= k, x, 0)
    use = place > 0
    return h[:, use], word[use]


class Model:
    """Log probabilities, sorted by hash: seen[k] of n-grams of order k + 1 (interpolated), back[k] the weight that their context leaves to the next lower order."""

    def __init__(self, counts: Counter):
        ws = list(counts)
        h, word = grams(ws)
        times = np.array([counts[w] for w in ws], np.float64)[word]
        context = contexts(ws)
        self.seen, self.back = [], []
        # Kneser-Ney: below the top order an n-gram counts by the different characters before it
        previous: tuple | None = None  # n-grams and probabilities of the next lower order
        for k in range(ORDER):
            ok = h[k] > 0
            if k == ORDER - 1:
                g, i = np.unique(h[k][ok], return_inverse=True)
                n = np.bincount(i, times[ok])
            else:
                longer = h[k + 1] > 0
                pair = np.unique(np.stack([h[k][longer], h[k + 1][longer]]), axis=1)
                g, i = np.unique(h[k][ok], return_inverse=True)
                n = np.bincount(np.searchsorted(g, pair[0]), minlength=len(g)).astype(np.float64)
                starts = np.unique(h[k][ok & ~longer])  # n-grams at the beginning of a word have nothing before them
                np.add.at(n, np.searchsorted(g, starts), np.bincount(i, times[ok], minlength=len(g))[np.searchsorted(g, starts)])
            first = np.zeros(len(g), np.int64)
            first[i] = np.flatnonzero(ok)
            ctx = context[k][first]
            cg, ci = np.unique(ctx, return_inverse=True)
            total, kinds = np.bincount(ci, n), np.bincount(ci)
            weight = DISCOUNT * kinds / total
            lower = 1 / ALPHABET if previous is None else previous[1][np.searchsorted(previous[0], h[k - 1][first])]
            p = np.maximum(n - DISCOUNT, 0) / total[ci] + weight[ci] * lower
            previous = g, p
            self.seen.append((g, np.log(p)))
            self.back.append((cg, np.log(weight)))

    def cost(self, h: np.ndarray, ctx: list[np.ndarray]) -> np.ndarray:
        """Negative log probability of each character."""
        out = np.log(ALPHABET) - self._weight(0, ctx[0])
        for k in range(ORDER):
            g, p = self.seen[k]
            if not len(g):
                break
            i = np.minimum(np.searchsorted(g, h[k]), len(g) - 1)
            hit = (g[i] == h[k]) & (h[k] > 0)
            if k:
                out = out - np.where(h[k] > 0, self._weight(k, ctx[k]), 0)
            out = np.where(hit, -p[i], out)
        return out

    def _weight(self, k: int, ctx: np.ndarray) -> np.ndarray:
        g, w = self.back[k]
        i = np.minimum(np.searchsorted(g, ctx), len(g) - 1)
        return np.where(g[i] == ctx, w[i], 0.0)


def contexts(ws: list[str]) -> list[np.ndarray]:
    """Hash of the characters before each character of the words, by the number of them: none, 1, ... ORDER - 1."""
    text = "".join(f"\x02{w}\x03" for w in ws)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(w) + 2 for w in ws])
    place = np.arange(len(c)) - np.repeat(np.cumsum(length) - length, length)
    out, total = [], np.zeros(len(c), np.uint64)
    for k in range(ORDER):
        if k:
            moved = np.zeros(len(c), np.uint64)
            moved[k:] = c[: max(0, len(c) - k)]
            total = total + (moved + np.uint64(7)) * _POWER[k - 1]
        out.append(((total ^ (total >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + np.uint64(1))[place > 0])
    return out


class Models:
    def __init__(self, counts: dict[str, Counter]):
        self.languages = sorted(counts)
        self.models = {x: Model(counts[x]) for x in self.languages}
        self.limit = dict.fromkeys(self.languages, np.inf)
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, len(self.languages)))

    def __getstate__(self):
        return self.__dict__ | {"place": {}, "known": self.known[:0]}

    def costs(self, ws: list[str]) -> np.ndarray:
        """Per word and language, over the word's characters and its end."""
        h, word = grams(ws)
        ctx = contexts(ws)
        return np.stack([np.bincount(word, self.models[x].cost(h, ctx), len(ws)) for x in self.languages], 1)

    def learn(self, tokens: set[str]) -> None:
        """Costs of words not met before; what is kept of earlier batches is bounded."""
        if len(self.place) + len(tokens) > 400_000:
            self.place, self.known = {}, self.known[:0]
        new = [w for w in tokens if w not in self.place]
        found = [self.known]
        for a in range(0, len(new), 50_000):
            found.append(self.costs(new[a : a + 50_000]))
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.known = np.concatenate(found)

    def scores(self, units: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of lists of words: the cost in each language, and the number of characters."""
        size = np.array(list(map(len, units)))
        self.learn({w for ws in units for w in ws})
        at = np.fromiter((self.place[w] for ws in units for w in ws), np.int64, size.sum())
        starts = np.cumsum(size) - size
        n = np.add.reduceat(np.fromiter((len(w) + 1 for ws in units for w in ws), np.int64, size.sum()), starts)
        return np.add.reduceat(self.known[at], starts, axis=0), n

    def classify(self, units: list[list[str]]) -> list[tuple[str, float, float]]:
        """Of lists of words: language, its probability against the next best, cross-entropy per character."""
        if not units:
            return []
        cost, n = self.scores(units)
        best = cost.argmin(1)
        row = np.arange(len(units))
        least = cost[row, best]
        margin = np.full(len(units), 50.0)
        if cost.shape[1] > 1:
            margin = np.minimum(np.partition(cost, 1, axis=1)[:, 1] - least, 50.0)
        entropy = least / n
        out = entropy > np.array([self.limit[x] for x in self.languages])[best]
        p = 1 / (1 + np.exp(-margin))
        return [("und" if o else self.languages[i], x, e) for o, i, x, e in zip(out.tolist(), best.tolist(), p.tolist(), entropy.tolist())]


def _counts(units: list[tuple[str, list[str]]]) -> dict[str, Counter]:
    counts: dict[str, Counter] = {}
    for lang, ws in units:
        counts.setdefault(lang, Counter()).update(ws)
        if lang == "vi":
            counts[lang].update(map(unmarked, ws))
    return counts


def true_labels(rows: list[list[tuple[str, list[str]]]]) -> list[str]:
    """The labels that stand for a language of their own, in order of first use: their model, fitted on every other row, must be cheaper by APART a character than those of the labels before, for at least half of the sentences of their other rows. rows are lists of (label, words)."""
    at: Counter = Counter()
    halves: tuple[list, list] = ([], [])
    for units in rows:
        if units:
            halves[at[units[0][0]] % 2].extend(units)
            at[units[0][0]] += 1
    counts = _counts(halves[0])
    label = np.array([x for x, _ in halves[1]])
    if not len(label):
        return []
    models = Models(counts)
    cost, n = models.scores([ws for _, ws in halves[1]])
    cost /= n[:, None]
    place, taken = {x: i for i, x in enumerate(models.languages)}, []
    for x in counts:
        mine = cost[label == x]
        least = mine[:, [place[y] for y in taken]].min(1) if taken else np.inf
        if len(mine) and 2 * np.count_nonzero(mine[:, place[x]] + APART < least) >= len(mine):
            taken.append(x)
    return taken


def fit(rows: list[tuple[str, str]]) -> Models | None:
    """Models from (label, text)."""
    each = [[(lang, ws) for s in _SENTENCE.split(consistent(t)) if (ws := words(s))] for lang, t in rows]
    true = set(true_labels(each))
    units = [u for x in each for u in x if u[0] in true]
    kept = units
    for _ in range(2):
        counts = _counts(kept)
        if not counts:
            return None
        models = Models(counts)
        kept = [u for u, (lang, _, _) in zip(units, models.classify([ws for _, ws in units])) if lang == u[0]]
    # limits of rejection: every HELD_OUT-th sentence is scored by models fitted on the others
    counts = _counts([u for i, u in enumerate(kept) if i % HELD_OUT])
    if set(counts) == set(models.languages):
        held = kept[::HELD_OUT]
        scored = list(zip(held, Models(counts).classify([ws for _, ws in held])))
        for lang in models.languages:
            e = [entropy for (x, ws), (_, _, entropy) in scored if x == lang and len(ws) > 2]
            if e:
                models.limit[lang] = SLACK * float(np.quantile(e, QUANTILE))
    return models


def sentences(text: str) -> list[tuple[int, list[str], int]]:
    """(paragraph, words, non-blank characters) of the sentences that have words."""
    return [(no, ws, len("".join(s.split()))) for no, line in enumerate(consistent(text).split("\n"), 1) for s in _SENTENCE.split(line) if (ws := words(s))]


def paragraphs(parts: list[tuple[int, int, str, float]]) -> list[tuple[int, str, float, int]]:
    """(para_no, language, confidence, non-blank characters) from sentences (paragraph, characters, language, probability); para_no 0 is the document."""
    each: dict[int, dict[str, list[float]]] = {}
    for no, n, lang, p in parts:
        for k in (0, no):
            x = each.setdefault(k, {}).setdefault(lang, [0, 0.0])
            x[0] += n
            x[1] += n * p
    out = []
    for no in sorted(each):
        total = sum(x[0] for x in each[no].values())
        lang, (_, p) = max(sorted(each[no].items()), key=lambda x: x[1][0])
        out.append((no, lang, round(float(p / total), 4), int(total)))
    return out


def sample(docs: DataFrame, n: int = SAMPLE) -> list[tuple[str, str]]:
    """At most n labelled rows per label of two lower-case letters (of which there are 676 at most), the whole texts, of the least hash of doc_id; the most frequent label first."""
    plain = docs.filter(F.col("lang").rlike("^[a-z]{2}$") & F.col("doc_id").isNotNull()).withColumn("h", F.xxhash64("doc_id"))
    rows = {r["lang"]: r["n"] for r in plain.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return []
    n = min(n, MOST // len(rows))
    # a share of all hashes that holds n and half as many again, so that one pass over the texts suffices
    below = F.create_map(*[F.lit(x) for k, v in rows.items() for x in (k, min((1 << 63) - 1, int((1.5 * n / v) * 2**64) - (1 << 63)))])
    near = plain.filter(F.col("h") <= below[F.col("lang")]).filter("text is not null").groupBy("lang", "h", "doc_id").agg(F.min("text").alias("text")).collect()
    out, taken = [], Counter()
    for r in sorted(near, key=lambda r: (-rows[r["lang"]], r["lang"], r["h"], r["doc_id"])):
        if taken[r["lang"]] < n:
            taken[r["lang"]] += 1
            out.append((r["lang"], r["text"]))
    return out


def languages(docs: DataFrame, models: Models | None) -> DataFrame:
    """(doc_id, stored, para_no, lang, confidence, document_lang) of every document and paragraph with letters."""
    schema = "doc_id bigint, stored string, para_no bigint, lang string, confidence double, document_lang string"
    if models is None:
        return docs.sparkSession.createDataFrame([], schema)
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            out = []
            parts = [sentences(t) for t in b["text"]]
            found = iter(m.classify([ws for p in parts for _, ws, _ in p]))
            for doc_id, stored, p in zip(b["doc_id"], b["lang"], parts):
                ps = paragraphs([(no, n, *next(found)[:2]) for no, _, n in p])
                out += [(doc_id, stored, no, lang, conf, ps[0][1]) for no, lang, conf, _ in ps]
            yield pd.DataFrame(out, columns=["doc_id", "stored", "para_no", "lang", "confidence", "document_lang"])

    return docs.filter("text is not null and doc_id is not null").select("doc_id", "lang", "text").mapInPandas(label, schema)


def wrong(found: DataFrame) -> DataFrame:
    """Documents whose stored label isn't exactly their language, and paragraphs that depart from their document's."""
    case = F.when(F.col("para_no") == 0, ~F.col("stored").eqNullSafe(F.col("lang"))).otherwise(F.col("lang") != F.col("document_lang"))
    return found.filter(case & (F.col("lang") != "und")).select("doc_id", "para_no", "lang").distinct()


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return wrong(languages(docs, fit(sample(docs))))


def p9_languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return languages(docs, fit(sample(docs))).select("doc_id", "para_no", "lang", "confidence").distinct()
