"""Shared helpers: reading tables, the consistent form of a string, hashing, size-checked broadcasts."""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters of other alphabets (and rare Latin ones) that look like a Latin letter, with the letter meant.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ү": "Y", "Ԍ": "G",
    # Greek
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "η": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # Armenian
    "օ": "o", "ս": "u", "ո": "n", "հ": "h", "Տ": "S", "Օ": "O",
    # Latin letters of other languages
    "ð": "đ", "Ð": "Đ", "Ɖ": "Đ", "ɖ": "đ", "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʋ": "v",
}

_INVISIBLE = "͏ᅟᅠ឴឵᠋-᠏ㅤ︀-️ﾠ"
_SPACES = "   -   　"
_SINGLETONS = "̀́̓̈́ΩKÅ豈-﫿ᄀ-ᇿ"
_LATIN_ODD = "ðÐƉɖɑɡıɩʋ"
_GREEK_CYR = "Ͱ-ϿЀ-ԯ԰-֏"
#: Characters that a consistent value doesn't hold, or only in a foreign word.
_FAST = re.compile(rf"[­̀-ͯ{_GREEK_CYR}؀-؅؜۝܏{_INVISIBLE}{_SPACES}​-‏‪-‮⁠-⁯﻿￹-￻{_SINGLETONS}！-～{_LATIN_ODD}᪰-᫿᷀-᷿⃐-⃿︠-︯ऀ-෿\U0001d400-\U0001d7ff\U000e0000-\U000e01ef]")
_DROP_ONE = regex.compile(rf"[\p{{Cf}}{_INVISIBLE}]")
_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {c: " " for c in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)}
_CONFUSABLE = re.compile(rf"[{_GREEK_CYR}{_LATIN_ODD}\U0001d400-\U0001d7ff]")
_LATIN = regex.compile(r"\p{Latin}")
_MATH = re.compile("[\U0001d400-\U0001d7ff]")
_LOOK = str.maketrans(LOOKALIKES)


def _word(w: str) -> str:
    if _MATH.search(w):
        w = _MATH.sub(lambda x: unicodedata.normalize("NFKC", x.group()), w)
    return w.translate(_LOOK) if _LATIN.search(w) else w


def _words(t: str, places) -> str:
    """Look-alike letters, which are at the places, replaced in words (runs of letters and marks) that have a Latin letter."""
    out, at = [], 0
    part = lambda c: c.isalpha() or unicodedata.category(c)[0] == "M"
    for i in places:
        if i >= at:
            j = i + 1
            while i > at and part(t[i - 1]):
                i -= 1
            while j < len(t) and part(t[j]):
                j += 1
            out += [t[at:i], _word(t[i:j])]
            at = j
    return "".join(out) + t[at:] if out else t


def odd(t: str) -> bool:
    """Whether a string holds a character that its consistent form may not hold."""
    return not t.isascii() and bool(_FAST.search(t) if len(t) < 200 else (kinds()[codes(t)] & ODD).any())


def consistent(t: str) -> str:
    """P1 form of a string: NFC, ASCII widths, nothing invisible, Latin letters in words that have any; other words, line ends, tabs, repeated spaces, quotes, dashes and signs stay."""
    if not odd(t):
        return t
    c = codes(t)
    k = kinds()[c]
    every = np.bitwise_or.reduce(k)
    if every & DROP:
        c = c[k & DROP == 0]
    if every & WIDE:
        c = np.where((c >= 0xFF01) & (c < 0xFF5F), c - 0xFEE0, c)
        c[kinds()[c] & WIDE > 0] = 32
    if every & (DROP | WIDE):
        t = text_of(c)
    if every & (LOOK | DROP | WIDE):
        t = _words(t, np.flatnonzero(kinds()[c] & LOOK).tolist())
    return unicodedata.normalize("NFC", t)


def codes(t: str) -> np.ndarray:
    """The code points of a string."""
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_of(c: np.ndarray) -> str:
    return c.astype(np.uint32, copy=False).tobytes().decode("utf-32-le", "surrogatepass")


#: Kinds of a code point, as bits: may be changed by `consistent`; invisible; of another width; look-alike; white space or digit; part of a word; lower case is more than one character or depends on its place.
ODD, DROP, WIDE, LOOK, BLANK, WORD, CASE = (1 << i for i in range(7))


@functools.cache
def kinds() -> np.ndarray:
    """The kinds of every code point."""
    found = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for bit, pattern in ((ODD, _FAST), (DROP, _DROP_ONE), (LOOK, _CONFUSABLE), (BLANK, re.compile(r"[\s\d]")), (WORD, re.compile(r"\w"))):
        found[[ord(c) for c in pattern.findall(every)]] |= np.uint8(bit)
    found[list(_WIDE)] |= np.uint8(WIDE)
    found[[0x130, 0x3A3]] |= np.uint8(CASE)
    return found


@functools.cache
def _lower() -> np.ndarray:
    return np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)], np.uint32)


def lower_codes(t: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The consistent form of a string, the code points of its lower case, and their kinds."""
    c = codes(t)
    k = kinds()[c]
    every = np.bitwise_or.reduce(k) if len(k) else 0
    if every & ODD:
        t = consistent(t)
        c = codes(t)
        k = kinds()[c]
        every = np.bitwise_or.reduce(k) if len(k) else 0
    if every & CASE:
        c = codes(t.lower())
        return t, c, kinds()[c]
    return t, _lower()[c], k


def spans(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of true values start and end."""
    edge = np.empty(len(part) + 1, bool)
    edge[0], edge[-1] = (part[0], part[-1]) if len(part) else (False, False)
    np.not_equal(part[1:], part[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    return at[::2], at[1::2]


def polynomial(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of c[i] * B**i modulo 2**64, and the powers of 1/B: with them the hash of any stretch is (sums[end] - sums[start]) * inverse[start]."""
    power, inverse = _powers(len(c) + 1)
    sums = np.empty(len(c) + 1, np.uint64)
    sums[0] = 0
    np.multiply(c, power[: len(c)], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums, inverse


BASE = 0x9E3779B97F4A7C15
_POWER = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(1 << 14, b, np.uint64))]) for b in (BASE, pow(BASE, -1, 1 << 64))]


def _powers(n: int) -> list[np.ndarray]:
    while len(_POWER[0]) <= n:
        _POWER[:] = [np.concatenate([p, p[1:] * p[-1]]) for p in _POWER]
    return _POWER


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def host(url: str = "url"):
    """The host of an address, lower case; what has no scheme counts up to the first slash."""
    return F.lower(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/@?#]*@)?([^/:?#]+)", 1))


def h64(s: str) -> int:
    """Signed 64-bit hash, the same on every machine."""
    x = xxhash.xxh3_64_intdigest(s)
    return x - (1 << 64) if x >> 63 else x


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Memo(dict):
    """A bounded dict with a function for missing keys: cleared when full, so that memory stays bounded and results don't depend on it."""

    def __init__(self, f, limit: int = 400_000):
        super().__init__()
        self.f, self.limit = f, limit

    def __missing__(self, k):
        if len(self) >= self.limit:
            self.clear()
        v = self[k] = self.f(k)
        return v


def small_rows(df: DataFrame, limit: int) -> list | None:
    """The rows of df if there are at most limit, else None: the size check before anything is broadcast."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def parameters(df: DataFrame, limit: int = 1000) -> list:
    """The rows of a parameter table; an error if there are more than limit."""
    rows = small_rows(df, limit)
    if rows is None:
        raise ValueError(f"a parameter table of more than {limit} rows")
    return rows


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by checkpoint() in the shared folder that the cluster names; a local folder is set only where none is named (tests)."""
    spark = df.sparkSession
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("a cluster must name a shared folder in spark.checkpoint.dir")
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vanquarry-"))
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return df.checkpoint()
