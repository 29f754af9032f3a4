"""Noise in text from scanned pages.

Method: windows of the text around suspect places, with line ends as characters, are decoded jointly (Viterbi) into words of a
lexicon: a word may be read across a mark and a line end (hyphen), across a space or a line end alone (merge), end without a
space (split), or with misread characters (confusion; digits too), each at a cost; words cost by their frequency. Suspect are
words broken with a mark, tokens with odd characters, neighbours that together make a likelier word than apart, and tokens
that are no word but two or more. The lexicon holds the syllables that the
rules of Vietnamese spelling allow, which bounds it, with their counts over all texts. Lines that hold only a page number or a
running header (the document's own title again) are removed; these are told by rules. Paragraph boundaries of what remains are chosen by dynamic
programming over the lines.

Defined results: null and empty texts and null uids give no rows; rows with the same uid count once; texts without noise are in
no result of `noise` and come out of `repaired` unchanged; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import p5_site_lines as p5
from .common import Memo, consistent, host, read, small_rows

# Parts of Vietnamese syllables.
ONSETS = "b c ch d đ g gh gi h k kh l m n ng ngh nh p ph qu r s t th tr v x".split()
OPEN = "a e ê i o ô ơ u ư y ia ua ưa ai ao au ay âu ây eo êu iu oa oe oi ôi ơi ui uê uơ uy uya ưi ưu oai oay oao oeo uây uôi ươi ươu iêu yêu uyu".split()
CLOSED = "a ă â e ê i o ô ơ u ư y iê yê oa oă oe oo uâ uê uô uy uyê ươ".split()
NO_NG, ONLY_NH = {"i", "ê", "y", "uê", "uy"}, {"a", "i", "ê", "y", "oa", "uê", "uy"}
# How recognition misreads characters (seen, meant).
CONFUSIONS = (
    ("li", "h"), ("1i", "h"), ("|i", "h"), ("l1", "h"), ("l!", "h"), ("|1", "h"), ("ii", "n"), ("1i", "n"), ("i1", "n"), ("!i", "n"), ("i!", "n"), ("rn", "m"), ("cl", "d"), ("vv", "w"),
    ("1", "i"), ("1", "l"), ("!", "i"), ("|", "l"), ("|", "i"), ("0", "o"), ("@", "a"), ("€", "e"), ("+", "t"), ("9", "g"), ("6", "b"), ("5", "s"), ("$", "s"), ("(", "c"), ("u'", "ư"), ("o'", "ơ"), ("u’", "ư"), ("o’", "ơ"),
)
COST_CONFUSION, COST_HYPHEN, COST_MERGE, COST_SPLIT, COST_UNKNOWN, COST_LITERAL_BREAK = 3.0, 0.5, 9.0, 7.0, 16.0, 6.0
_TONE = {"̀", "́", "̉", "̃", "̣"}
_SYLLABLE = re.compile("(" + "|".join(sorted(ONSETS, key=len, reverse=True)) + ")?(.+)")
_BREAK = regex.compile(r"(?<=\p{L})[-¬‐][ \t\r]*\n[ \t\r]*(?=\p{L})")
_MARK_END = regex.compile(r"\p{L}[-¬‐][ \t\r]*\n")
_HEAD = re.compile(r"(?:(?P<before>\d{1,4})\s*[|–—·-]\s*)?(?:[^\W\d_]\S*\s+){0,4}(?P<number>[\dOIl]+/[\dOIl]{4}/[^\s;,.()|]+)(?:\s*[|–—·-]\s*(?P<after>\d{1,4})|\s+(?P<apart>\d{1,4}))?")
_MARKS = {"-", "¬", "‐"}
_ODD = re.compile(r"[1!90@€+(|'’65$]|ii|rn|li|cl|vv")
_EDGE = "\"“”.,;:?)[]…«»<>–—-"
_AFTER = _EDGE.rstrip("-")
_NUMBER = re.compile(r"(?<![^\W\d_])\d+[OolI](?=[\d.,/;:)\s]|$)|(?<=\d[./,])[OolI]+\d")
_DIGITS = re.compile(r"[\dOolI]+")
_AS_DIGITS = str.maketrans("OolI", "0011")
_LABEL = re.compile(r"\d+[a-zđ]\W*")
PAGE = re.compile(r"\s*(?:[-—–]\s*\d{1,4}\s*[-—–]|(?:trang|page)\s+\d{1,4}(?:\s*/\s*\d{1,4})?|tr\.\s*\d{1,4}|\[\s*\d{1,4}\s*\]|\d{1,4}(?:\s*/\s*\d{1,4})?)\s*", re.I)
_DOC_NUMBER = re.compile(r"[\dOIl]+/[\dOIl]{4}/[^\s;,.()]+")
_LETTERS = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"\S+")
_UNIT = re.compile(r"[^\W_]+|[^\s]")


@functools.lru_cache(1 << 16)
def is_syllable(w: str) -> bool:
    """Whether Vietnamese spelling allows the word (lower case, composed)."""
    base, tones = [], []
    for c in unicodedata.normalize("NFD", w):
        (tones if c in _TONE else base).append(c)
    if len(tones) > 1 or not base:
        return False
    b = unicodedata.normalize("NFC", "".join(base))
    tone = tones[0] if tones else ""
    for n in range(min(3, len(b) - 1), -1, -1):
        if n and b[:n] not in ONSETS:
            continue
        rime = b[n:]
        if n and b[:n] == "qu" and rime in ("u", "ư"):
            continue
        if rime in OPEN:
            return True
        for coda in ("ch", "ng", "nh", "c", "m", "n", "p", "t"):
            v = rime[: -len(coda)]
            if rime.endswith(coda) and v in CLOSED:
                if coda in ("c", "ch", "p", "t") and tone not in ("́", "̣"):
                    continue
                if coda in ("ch", "nh") and v not in ONLY_NH or coda in ("ng", "c") and v in NO_NG:
                    continue
                return True
    return False


class Lexicon:
    def __init__(self, counts: dict[str, int]):
        self.total = sum(counts.values()) + 1
        self.cost = {w: float(-np.log((n + 0.5) / self.total)) for w, n in counts.items() if is_syllable(w)}
        self.trie: dict = {}
        for w, c in self.cost.items():
            node = self.trie
            for x in w:
                node = node.setdefault(x, {})
            node[""] = c

    def reads(self, s: str, i: int) -> Iterator[tuple[int, str, float, tuple[str, ...]]]:
        """(end, word, cost, operations) of the words of the lexicon that s may be read as from i on."""
        stack = [(i, self.trie, "", 0.0, ())]
        while stack:
            j, node, word, cost, ops = stack.pop()
            if "" in node:
                split = j < len(s) and s[j].isalpha()
                yield j, word + (" " if split else ""), cost + node[""] + (COST_SPLIT if split else 0), ops + (("split",) if split else ())
            if j >= len(s):
                continue
            c = s[j].lower()
            if c in node and c:
                stack.append((j + 1, node[c], word + s[j], cost, ops))
            for seen, meant in CONFUSIONS:
                if meant in node and s[j : j + len(seen)].lower() == seen:
                    m = meant.upper() if s[j].isupper() else meant
                    stack.append((j + len(seen), node[meant], word + m, cost + COST_CONFUSION, ops + ("confusion",)))
                elif len(seen) == 2 and meant in node and c == seen[0] and s[j + 1 : j + 2] in _MARKS and (b := _BREAK.match(s, j + 1)) and s[b.end()].lower() == seen[1]:
                    m = meant.upper() if s[j].isupper() else meant
                    stack.append((b.end() + 1, node[meant], word + m, cost + COST_CONFUSION + COST_HYPHEN, ops + ("confusion", "hyphen")))
            if word:
                b = _BREAK.match(s, j)
                if b:
                    stack.append((b.end(), node, word, cost + COST_HYPHEN, ops + ("hyphen",)))
                elif c in " \n" and j + 1 < len(s) and s[j + 1].isalpha():
                    stack.append((j + 1, node, word, cost + COST_MERGE, ops + ("merge",)))

    def literal(self, word: str) -> float:
        """The cost of a word as it stands: of a known one by its frequency, else by its length."""
        known = self.cost.get(word.lower())
        if known is not None:
            return known
        return 4.0 if word.isdigit() or not word.isalnum() or (word.isupper() and len(word) < 6) else max(COST_UNKNOWN, 3.0 + 3.0 * len(word) if word.isalpha() else 0)

    def apart(self, a: str, b: str) -> bool:
        """Whether two neighbouring tokens are likelier one word torn apart."""
        x, y = a.lstrip(_EDGE), b.rstrip(_AFTER)
        if not (x.isalpha() and y.isalpha()) or x.isupper() != y.isupper() and len(x) > 1 or y[0].isupper() and not x.isupper():
            return False
        one = self.cost.get((x + y).lower())
        return one is not None and one + COST_MERGE < self.literal(x) + self.literal(y)

    def glued(self, token: str) -> bool:
        """Whether a token is likelier two or more words run together."""
        core = token.strip(_EDGE)
        return len(core) > 3 and core.isalpha() and not core.isupper() and core.lower() not in self.cost and self.decode(core)[1]["split"] > 0

    def decode(self, s: str) -> tuple[str, Counter]:
        """The best reading of s and the operations that it takes."""
        n = len(s)
        best: list = [(0.0, 0, "", ())] + [None] * n

        def put(j: int, cost: float, i: int, text: str, ops: tuple) -> None:
            if best[j] is None or cost < best[j][0] - 1e-9:
                best[j] = (cost, i, text, ops)

        for i in range(n):
            if best[i] is None:
                continue
            base, c = best[i][0], s[i]
            start = i == 0 or not s[i - 1].isalnum()
            if c.isspace() or not (c.isalnum() or _ODD.match(c)):
                put(i + 1, base, i, c, ())
                continue
            m = _UNIT.match(s, i)
            word = m.group()
            literal = self.literal(word)
            glued = i > 0 and s[i - 1].isalnum() or m.end() < n and (s[m.end()] in "@€+|" or s[m.end()] in "'’!(" and m.end() + 1 < n and s[m.end() + 1].isalpha())
            put(m.end(), base + literal + (COST_LITERAL_BREAK if _BREAK.match(s, m.end()) or glued else 0), i, word, ())
            number = _DIGITS.match(s, i) if start else None
            if number and _NUMBER.search(s[max(0, i - 2) : number.end() + 1]):
                put(number.end(), base + COST_CONFUSION, i, number.group().translate(_AS_DIGITS), ("confusion",))
            if start or s[i - 1].isalpha():
                for j, w, cost, ops in self.reads(s, i):
                    put(j, base + cost, i, w, ops)
        out, ops, j = [], Counter(), n
        while j:
            _, i, text, o = best[j]
            out.append(text)
            ops.update(o)
            j = i
        return "".join(reversed(out)), ops


def suspect(token: str) -> bool:
    """Whether a token may hold misread characters: it has some of them and isn't well spelt as it stands."""
    if _NUMBER.search(token):
        return True
    if not _ODD.search(token) and not _ODD.search(token.lower()):
        return False
    core = token.strip(_EDGE)
    low = core.lower()
    if is_syllable(low) or not any(c.isalpha() for c in core) or _LABEL.fullmatch(token):
        return False
    letters = sum(c.isalpha() for c in core)
    if core.isalpha():
        return not (core.isupper() and len(core) < 5)
    bare = core.strip("!('’+")
    if is_syllable(bare.lower()) and core[:1] not in "@€+" and core[-1:] in "!('’":
        return False
    return letters >= 2 and not re.fullmatch(r"[A-ZĐ]+\d+|\d+[A-ZĐ]+\d*|.*\d[-/.].*|.*[-/]\d.*|[A-ZĐ]*\d+[A-ZĐ]?[-./].*", core)


_SUSPECT = Memo(suspect)


def _letters(w: str) -> str:
    """A token in lower case if it has letters only, else nothing."""
    return w.lower() if w.isalpha() else ""


class Reader:
    """Finds and repairs noise, with a lexicon."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.tokens = Memo(lambda w: lexicon.decode(w)[1]["confusion"] > 0, 200_000)
        self.left, self.right = Memo(lambda w: _letters(w.lstrip(_EDGE))), Memo(lambda w: _letters(w.rstrip(_AFTER)))
        self.run_together = Memo(lexicon.glued, 200_000)
        self.breaks = Memo(lambda w: lexicon.decode(w)[1]["hyphen"] > 0, 100_000)

    def window(self, t: str, i: int, j: int) -> tuple[int, int]:
        """From the beginning of the token at i to the end of the one at j."""
        while i > 0 and not t[i - 1].isspace():
            i -= 1
        while j < len(t) and not t[j].isspace():
            j += 1
        return i, j

    def broken(self, t: str) -> Iterator[tuple[int, int]]:
        for m in _BREAK.finditer(t):
            i, j = self.window(t, m.start(), m.end())
            if self.breaks[re.sub(r"[ \t\r]*\n[ \t\r]*", "\n", t[i:j])]:
                yield i, j

    def wrong(self, t: str) -> bool:
        for w in set(t.split()):
            if _SUSPECT[w] and self.tokens[w]:
                return True
        return False

    def spaced(self, t: str) -> Iterator[tuple[int, int]]:
        """Where words are torn apart by a space or a line end, or run together."""
        tokens, cost = t.split(), self.lexicon.cost
        left, right = [self.left[w] for w in tokens], [self.right[w] for w in tokens[1:]]
        torn = [i for i, (a, b) in enumerate(zip(left, right)) if a and b and a + b in cost and self.lexicon.apart(tokens[i], tokens[i + 1])]
        joined = [i for i, w in enumerate(tokens) if self.run_together[w]]
        if torn or joined:
            at = [m.span() for m in _TOKEN.finditer(t)]
            yield from ((at[i][0], at[i + 1][1]) for i in torn if at[i + 1][0] - at[i][1] == 1)
            yield from (at[i] for i in joined)

    def furniture(self, lines: list[str], title: str | None, number: str | None) -> set[int]:
        """Indices of the lines that hold only a page number or a running header."""
        pages = {i for i, x in enumerate(lines) if x and PAGE.fullmatch(x)}
        own = _number_form(number)
        # the document's kind and number with a page number
        out = pages | {i for i, x in enumerate(lines) if own and "/" in x and (m := _HEAD.fullmatch(x)) and (m["before"] or m["after"] or m["apart"]) and _number_form(m["number"]) == own}
        subject = subject_words(lines, title)
        if len(subject) < 3:
            return out
        joined = "".join(subject)
        first = subject[0]
        for i, x in enumerate(lines):
            if i in out:
                continue
            low = x.lower()
            if first[:2] not in low and not (own and own[-6:] in low):
                continue
            n = _DOC_NUMBER.search(x)
            numbered = bool(n) and bool(own) and _number_form(n.group()) == own
            capital = x.isupper()
            near = i - 1 in pages or i + 1 in pages
            if not (numbered or capital or near) or "về việc" in low or low.startswith("v/v") or i and lines[i - 1].lower().rstrip().endswith(("về việc", "v/v")):
                continue
            rest = x[: n.start()] + " " + x[n.end() :] if n else x
            ws = [w for w in _LETTERS.findall(rest.lower())]
            for cut in range(4 if numbered else 1):
                for back in range(4 if numbered else 1):
                    r = ws[cut : len(ws) - back]
                    text = "".join(r)
                    if len(r) >= 3 and (cut + back == 0 or numbered) and r[0][:1] == first[:1] and _close(text, joined[: len(text)]):
                        out.add(i)
        return out

    def between(self, t: str, skip: np.ndarray | None) -> set[int]:
        """Indices of the lines of the site, whose wordings are in skip: they may stand between the halves of a broken word."""
        if skip is None or not len(skip):
            return set()
        scan = p5.Scan(t)
        return set(np.flatnonzero(np.isin(scan.wording, skip) & (scan.upto > scan.first)).tolist())

    def noise(self, text: str, title: str | None, number: str | None, skip: np.ndarray | None = None) -> list[str]:
        t = consistent(text)
        out = []
        lines = [x.strip() for x in t.split("\n")]
        furniture = self.furniture(lines, title, number)
        broken = next(self.broken(t), None)
        if not broken and _MARK_END.search(t):
            # a word broken at a page's end goes on after the furniture
            away = furniture | self.between(t, skip)
            broken = away and next(self.broken("\n".join(x for i, x in enumerate(lines) if i not in away)), None)
        if broken:
            out.append("broken_word")
        if self.wrong(t):
            out.append("wrong_char")
        if furniture:
            out.append("page_furniture")
        return out

    def repair(self, text: str, title: str | None, number: str | None) -> str:
        lines = [x.strip() for x in consistent(text).split("\n")]
        drop = self.furniture(lines, title, number)
        t = "\n".join(x for i, x in enumerate(lines) if i not in drop)
        spans = sorted({*self.broken(t), *self.spaced(t), *(m.span() for m in _TOKEN.finditer(t) if _SUSPECT[m.group()] and self.tokens[m.group()])})
        out, at, k = [], 0, 0
        while k < len(spans):
            i, j = spans[k]
            while k + 1 < len(spans) and spans[k + 1][0] <= j + 1:
                k += 1
                j = max(j, spans[k][1])
            out += [t[at:i], self.lexicon.decode(t[i:j])[0]]
            at, k = j, k + 1
        t = "".join(out) + t[at:]
        return paragraphs(t.split("\n"))


def _number_form(number: str | None) -> str:
    """A document's number with letters read for digits set right, for comparison."""
    return (number or "").translate(_AS_DIGITS).rstrip(").").lower()


def _close(a: str, b: str) -> bool:
    """Equal but for an eighth of the characters, place by place or after a shift (words misread change the length)."""
    if a == b:
        return True
    from difflib import SequenceMatcher

    return len(a) > 10 and len(b) > 0.7 * len(a) and SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85


def subject_words(lines: list[str], title: str | None) -> list[str]:
    """The words of a document's subject, from its title or else from its line on the matter."""
    if title:
        n = _DOC_NUMBER.search(title)
        rest = title[n.end() :] if n else title
        matter = re.search(r"(?:về việc|v/v)\s+(.+)", rest, re.I | re.S)
        rest = matter.group(1) if matter else rest
        if rest.strip():
            return _LETTERS.findall(rest.lower())
    for i, x in enumerate(lines):
        if x[:3].lower() == "v/v":
            full = x[3:]
            for y in lines[i + 1 :]:
                if y.isupper() or not y:
                    break
                full = full[:-1] + y if full[-1:] in "-¬" else full + " " + y
            return _LETTERS.findall(full.lower())
    return []


def paragraphs(lines: list[str]) -> str:
    """Joins the lines of a text into paragraphs: the division of least cost, by dynamic programming over the lines.

    A line that ends before the paragraph does costs by how far it is from full width and by a sentence end; a paragraph's last line
    costs if it ends within a sentence; a blank line always divides; each paragraph costs a little.
    """
    lines = [x.strip() for x in lines]
    width = np.percentile([len(x) for x in lines if x] or [1], 90)
    n = len(lines)
    # a paragraph's cost is a sum over its lines, so that one open at a line needs only its beginning and its cost so far
    best, back = [0.0] + [np.inf] * n, [0] * (n + 1)
    cost, begin = np.inf, 0
    for j, x in enumerate(lines):
        if not x:
            best[j + 1], back[j + 1], cost = best[j], j, np.inf
            continue
        if best[j] + 0.3 < cost:
            cost, begin = best[j] + 0.3, j
        ends = x[-1:] in tuple(".;:!?)”\"") or x.isupper()
        following = lines[j + 1] if j + 1 < n else ""
        opens = not following or following[0].isupper() or following[0].isdigit() or following[0] in "-+*[(“"
        best[j + 1], back[j + 1] = cost + (0 if ends else 2.0 if opens else 6.0), begin
        cost += (3.0 if ends and opens and len(x) < 0.75 * width else 0.6 if ends and opens else 0.2) + (4.0 if x.isupper() or following.isupper() else 0)
    out, j = [], n
    while j:
        i = back[j]
        if lines[i]:
            out.append(" ".join(lines[i:j]))
        j = i
    return "\n\n".join(reversed(out))


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """(table_name, uid, title, number, host, raw_text) of both tables."""
    docs = read(spark, sf, "legal_docs").select(F.lit("legal_docs").alias("table_name"), "uid", "title", F.col("doc_id").alias("number"), host().alias("host"), "raw_text")
    cases = read(spark, sf, "court_cases").select(F.lit("court_cases").alias("table_name"), "uid", F.lit(None).cast("string").alias("title"), F.col("case_number").alias("number"), host().alias("host"), "raw_text")
    return docs.unionByName(cases)


def syllables(rows: DataFrame) -> DataFrame:
    """(word, n): how often each well-spelt word occurs in all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c: Counter = Counter()
            for t in b["raw_text"]:
                c.update(_LETTERS.findall(consistent(t).lower()))
            yield pd.DataFrame([(w, n) for w, n in c.items() if is_syllable(w)], columns=["word", "n"])

    return rows.filter("raw_text is not null").select("raw_text").mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(rows: DataFrame) -> Lexicon:
    """The spelling rules allow fewer than 50,000 words, so the counts are small whatever the texts' size."""
    found = small_rows(syllables(rows), 50_000)
    if found is None:
        raise ValueError("more well-spelt words than the rules allow")
    return Lexicon({r["word"]: r["n"] for r in found})


def _number(number: str | None, title: str | None, text: str) -> str | None:
    m = _DOC_NUMBER.search(consistent(title)) if title else None
    if m:
        return m.group()
    return consistent(number) if number else (m.group() if (m := _DOC_NUMBER.search(consistent(text))) else None)


def noise(rows: DataFrame, broadcast_limit: int = 200_000) -> DataFrame:
    """(table_name, uid, noise_kind) of rows(table_name, uid, title, number, raw_text); with a host too, words are also read across the lines of their site."""
    hosts = F.coalesce("host", F.lit("")) if "host" in rows.columns else F.lit("")
    rows = rows.filter("uid is not null and raw_text is not null").select("table_name", "uid", "title", "number", hosts.alias("host"), "raw_text")
    sent = rows.sparkSession.sparkContext.broadcast(lexicon(rows))
    lines = p5.repeated(rows.filter("host <> ''").select("table_name", "uid", "host", "raw_text")).select("table_name", "host", "wording").distinct()
    few, by = small_rows(lines, broadcast_limit), {}
    if few is None:
        rows = rows.join(lines.groupBy("table_name", "host").agg(F.collect_list("wording").alias("skip")), ["table_name", "host"], "left")
    else:
        for r in few:
            by.setdefault((r["table_name"], r["host"]), []).append(r["wording"])
        by = {k: np.array(v, np.int64) for k, v in by.items()}
    site = rows.sparkSession.sparkContext.broadcast(by)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(sent.value)
        for b in batches:
            skips = b["skip"] if "skip" in b else (site.value.get(k) for k in zip(b["table_name"], b["host"]))
            out = [(t, u, k) for t, u, title, number, text, skip in zip(b["table_name"], b["uid"], b["title"], b["number"], b["raw_text"], skips) for k in reader.noise(text, title and consistent(title), _number(number, title, text), skip)]
            yield pd.DataFrame(out, columns=["table_name", "uid", "noise_kind"])

    return rows.mapInPandas(find, "table_name string, uid string, noise_kind string").distinct()


def repaired(rows: DataFrame) -> DataFrame:
    """(table_name, uid, raw_text, noise_kinds): each uid's text, repaired into continuous paragraphs if it has noise, else as it is; besides those of `noise` there is the kind word_space, for words torn apart or run together."""
    rows = rows.filter("uid is not null and raw_text is not null").select("table_name", "uid", "title", "number", "raw_text")
    sent = rows.sparkSession.sparkContext.broadcast(lexicon(rows))

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(sent.value)
        for b in batches:
            out = []
            for t, u, title, number, text in zip(b["table_name"], b["uid"], b["title"], b["number"], b["raw_text"]):
                title, number = title and consistent(title), _number(number, title, text)
                kinds = reader.noise(text, title, number)
                if next(reader.spaced(consistent(text)), None):
                    kinds.append("word_space")
                out.append((t, u, reader.repair(text, title, number) if kinds else text, kinds))
            yield pd.DataFrame(out, columns=["table_name", "uid", "raw_text", "noise_kinds"])

    return rows.dropDuplicates(["table_name", "uid"]).mapInPandas(mend, "table_name string, uid string, raw_text string, noise_kinds array<string>")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return noise(texts(spark, sf))


def p2_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return repaired(texts(spark, sf))
