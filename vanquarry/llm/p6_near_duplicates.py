"""Near-duplicate records with small edits.

Method: PartEnum. The features of a text are its sequences of five words. Sets are put into bands by size (a factor of two
each; a set takes part in its own band and the next, so that two sets that can be similar meet in one). For a band the
domain of features is partitioned by hashing, several times over; the part of a set that lies in one partition, if it has
at least LEAST features, is a signature. Of the partitions SLOTS are enumerated. Pairs that share SHARED
signatures are candidates; two sets of Jaccard similarity 0.5 do except with probability 2e-6 at most, wherever their sizes lie in the bands (see `slots`). Copies (equal sets) are one
class from the start, so pairs are formed between classes only. A signature shared by more than HOT classes isn't paired
as such: its members are keyed by it and each other signature of theirs, once more. Every candidate pair is then checked
exactly on sets made anew from the texts.

Defined results: null uids, null texts and texts of fewer than five words take no part; rows with the same uid count once (of
different texts the one of the least set id counts); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import p5_site_lines as p5
from .common import WORD, cut, h64, lower_codes, mix, polynomial, small_rows, spans

N_WORDS, THRESHOLD = 5, 0.5
SLOTS, PER_PART, LEAST, SHARED, HOT, BLOCK = 470, 2.5, 3, 2, 200, 1000
#: If set, a class of more members is returned as a star; None: every pair is returned.
ALL_PAIRS: int | None = None
SHORT = 32
#: Bits of a signature that are shuffled: equal ones of different parts only make candidates, which are checked.
_BITS = np.uint64((1 << 48) - 1)
_STEP = [np.uint64(pow(0xD6E8FEB86659FD93, j, 1 << 64)) for j in range(N_WORDS)]


def words(text: str, skip: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the words of a text in consistent form and lower case, without the lines whose wording is in skip."""
    if skip is not None and len(skip):
        scan = p5.Scan(text)
        c, kinds = scan.text, scan.kinds
    else:
        _, c, kinds = lower_codes(text)
    starts, ends = spans(kinds & WORD > 0)
    if skip is not None and len(skip):
        out = np.isin(scan.wording, skip) & (scan.upto > scan.first)
        if out.any():
            stay = ~out[scan.line(starts)]
            starts, ends = starts[stay], ends[stay]
    sums, inverse = polynomial(c)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def features(x: np.ndarray) -> np.ndarray:
    """The set of hashed five-word sequences, sorted, of word hashes."""
    if len(x) < N_WORDS:
        return np.zeros(0, np.uint64)
    m = len(x) - N_WORDS + 1
    total = x[:m].copy()
    for j in range(1, N_WORDS):
        total += x[j : m + j] * _STEP[j]
    return distinct(mix(total))


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def slots(s: np.ndarray, band: int, n_slots: int = SLOTS) -> np.ndarray:
    """Signatures of the set s in a band (sizes of 2**band up to 2**(band+1)).

    Partitions hold PER_PART features of a set of the band's lower size on average. Of two sets a partition has Poisson(c)
    common and Poisson(d) other features; it gives a shared signature with probability exp(-d) * P(Poisson(c) >= LEAST). The
    fewest are shared by sets in neighbouring bands of which one is contained in the other, twice its size: they meet in the
    upper band only, with c = d = PER_PART / 2 to PER_PART, so that a partition gives one with probability 0.037 at least (the
    PER_PART of 2.5 makes both ends equal). Of SLOTS partitions that gives 17.6 shared signatures on average, near enough to
    Poisson: fewer than two with 4.2e-7; for sets of SHORT to 250 features it is 16 on average: 2e-6. Sets of one band share some 30 (fewer than two with 1e-12).
    """
    n_parts = max(1, round(2**band / PER_PART))
    value = (mix(s) >> np.uint64(13)).astype(np.float64)
    # the features are hashes already: a multiplication with an odd number of the round's own spreads them anew
    h = s * _spread(band, -(-n_slots // n_parts))
    slot = ((h >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).view(np.int64)
    slot += np.arange(len(h), dtype=np.int64)[:, None] * n_parts
    use = slot < n_slots
    value = np.broadcast_to(value, h.shape)[use]
    slot = slot[use]
    full = np.flatnonzero(np.bincount(slot, minlength=n_slots) >= LEAST)
    # sums of 51 bits may round, but alike for the same features, which are in order
    total = np.bincount(slot, value, n_slots)[full].astype(np.uint64)
    return mix(mix(total) + full.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(band * 1000003))


@functools.cache
def _spread(band: int, rounds: int) -> np.ndarray:
    return np.array([[((r + 1) * 0x9E3779B97F4A7C15 + 2 * band * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) | 1] for r in range(rounds)], np.uint64)


def signatures(s: np.ndarray) -> np.ndarray:
    """Those of both bands of a set. A set of fewer than SHORT features meets only sets of fewer than 2 * SHORT: there the least features, one more than may be missing from a similar set, are signatures, each SHARED times, so that none is missed."""
    out = []
    if len(s) < 2 * SHORT:
        head = s[: len(s) // 2 + 1]
        out += [mix(head ^ np.uint64(0x2545F4914F6CDD1D + k)) for k in range(SHARED)]
    if len(s) >= SHORT:
        band = len(s).bit_length() - 1
        out += [slots(s, band), slots(s, band + 1)]
    return distinct(np.concatenate(out))


def set_id(s: np.ndarray) -> int:
    """Identity of a set: the sum of its mixed features, signed."""
    return int(np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0


def with_skips(rows: DataFrame, lines: DataFrame, limit: int) -> tuple[DataFrame, dict | None]:
    """rows and, if the repeated wordings of all sites are at most limit, these by table and host; else rows with a column skip."""
    w = lines.select("table_name", "host", "wording").distinct()
    few = small_rows(w, limit)
    if few is None:
        return rows.join(w.groupBy("table_name", "host").agg(F.collect_list("wording").alias("skip")), ["table_name", "host"], "left"), None
    by: dict = {}
    for r in few:
        by.setdefault((r["table_name"], r["host"]), []).append(r["wording"])
    return rows, {k: np.array(v, np.int64) for k, v in by.items()}


def _sets(b: pd.DataFrame, by: dict | None) -> Iterator[np.ndarray]:
    skips = (by.get(k) for k in zip(b["table_name"], b["host"])) if by is not None else b["skip"]
    for t, skip in zip(b["raw_text"], skips):
        yield features(words(t, skip))


def pairs(rows: DataFrame, threshold: float = THRESHOLD, broadcast_limit: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Of rows(table_name, uid, host, raw_text): members (table_name, set_id, uid) and the links between classes (table_name, a, b, jaccard)."""
    if not 0.5 <= threshold <= 1:
        raise ValueError("the bands are made for a threshold of 0.5 or more")
    rows = rows.filter("uid is not null and raw_text is not null")
    sites = rows.filter("host <> ''")
    rows, by = with_skips(rows.select("table_name", "uid", F.coalesce("host", F.lit("")).alias("host"), "raw_text"), p5.repeated(sites), broadcast_limit)
    sent = rows.sparkSession.sparkContext.broadcast(by)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # of a class, one text of a task gives signatures: copies are put together before anything is shuffled
        for b in batches:
            out = []
            for t, u, s in zip(b["table_name"], b["uid"], _sets(b, sent.value)):
                if len(s):
                    i, own = set_id(s) ^ h64(t), np.array([h64(t + u)], np.int64)
                    out.append((t, u, i, len(s), own if i in seen else np.append(own, ((signatures(s) ^ np.uint64(h64(t) & (1 << 64) - 1)) & _BITS).view(np.int64))))
                    seen.add(i)
            yield pd.DataFrame(out, columns=["table_name", "uid", "set_id", "n", "signatures"])

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(t, i, s.view(np.int64)) for t, i, s in zip(b["table_name"], b["set_id"], _sets(b, sent.value)) if set_id(s) ^ h64(t) == i]
            yield pd.DataFrame(out, columns=["table_name", "set_id", "features"])

    # one shuffle of narrow rows: the signatures of each text and, under a key of its own, the text's row of members
    base = rows.mapInPandas(sign, "table_name string, uid string, set_id bigint, n int, signatures array<bigint>")
    spread = base.select("set_id", "table_name", "uid", "n", F.posexplode("signatures").alias("pos", "signature")).selectExpr("signature", "set_id", "if(pos = 0, struct(table_name, uid, n), null) as who")
    w = "over (partition by signature)"
    # signatures of one class only go at once; a signature holds its table, so that the rows to sort are narrow
    held = cut(spread.withColumns({"lo": F.expr(f"min(set_id) {w}"), "hi": F.expr(f"max(set_id) {w}")}).filter("lo <> hi or who is not null").select("signature", "set_id", "who"))
    texts = held.filter("who is not null").select("who.*", "set_id")
    members = texts.groupBy("table_name", "uid").agg(F.min("set_id").alias("set_id"))
    size = texts.groupBy("table_name", "set_id").agg(F.max("n").alias("n"))
    several = held.filter("who is null").select("signature", "set_id").distinct()
    shared = cut(several.withColumn("size", F.expr(f"count(*) {w}")).join(size, "set_id"))
    found = _pair(shared.filter(F.col("size") <= HOT), ["signature"], threshold)
    hot = shared.filter(F.col("size") > HOT).select("table_name", "set_id", "n", "signature")
    other = shared.select("table_name", "set_id", F.col("signature").alias("other"))
    twice = hot.join(other, ["table_name", "set_id"]).filter("signature <> other")
    found = found.unionByName(_pair(twice, ["signature", "other"], threshold))
    found = cut(found.groupBy("table_name", "a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= SHARED).select("table_name", "a", "b"))
    # the sets of the classes that occur in a candidate pair, each from one of its texts
    ids = found.select("table_name", F.col("a").alias("set_id")).union(found.select("table_name", "b")).distinct()
    one = cut(texts.select("table_name", "set_id", "uid").join(ids, ["table_name", "set_id"]).groupBy("table_name", "set_id").agg(F.min("uid").alias("uid")))
    if one.count() <= broadcast_limit:
        one = F.broadcast(one)  # else the texts are shuffled to meet the classes
    full = cut(rows.join(one, ["table_name", "uid"]).mapInPandas(again, "table_name string, set_id bigint, features array<bigint>").dropDuplicates(["table_name", "set_id"]))
    a, b = (full.select("table_name", F.col("set_id").alias(x), F.col("features").alias(f"f{x}")) for x in "ab")
    common = F.size(F.array_intersect("fa", "fb"))
    links = found.join(a, ["table_name", "a"]).join(b, ["table_name", "b"]).withColumn("common", common).withColumn("jaccard", F.col("common") / (F.size("fa") + F.size("fb") - F.col("common")))
    return members, links.filter(F.col("jaccard") >= threshold).select("table_name", "a", "b", "jaccard")


def _pair(df: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Candidate pairs of classes that share the keys and can be similar by size."""
    a = df.select("table_name", *keys, F.col("set_id").alias("a"), F.col("n").alias("na"))
    b = df.select("table_name", *keys, F.col("set_id").alias("b"), F.col("n").alias("nb"))
    return a.join(b, ["table_name", *keys]).filter((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold)).groupBy("table_name", "a", "b").agg(F.count("*").alias("n"))


def found(rows: DataFrame) -> DataFrame:
    """(table_name, uid_a, uid_b): all pairs of uids at or above the threshold, formed in blocks of some BLOCK members so that a large class is spread; if ALL_PAIRS is set, of a class of more members each is paired with the least uid only, and with other classes only through it."""
    members, links = pairs(rows)
    size = members.groupBy("table_name", "set_id").agg(F.count("*").alias("size"), F.min("uid").alias("least"))
    if ALL_PAIRS is not None:
        inner = members.join(size.filter(F.col("size") > ALL_PAIRS), ["table_name", "set_id"])
        stars = inner.filter("uid > least").select("table_name", F.col("least").alias("uid_a"), F.col("uid").alias("uid_b"))
        members = members.join(size, ["table_name", "set_id"]).filter((F.col("size") <= ALL_PAIRS) | (F.col("uid") == F.col("least"))).select("table_name", "set_id", "uid")
        size = size.withColumn("size", F.when(F.col("size") <= ALL_PAIRS, F.col("size")).otherwise(1))
    blocks = size.select("table_name", "set_id", "size", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(blocks, ["table_name", "set_id"]).withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    x, y = (placed.filter("size > 1").select("table_name", "set_id", F.col("uid").alias(f"uid_{c}"), "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) for c in "ab")
    y = y.select("table_name", "set_id", "uid_b", F.col("block").alias("other"), F.col("other").alias("block"))
    copies = x.join(y, ["table_name", "set_id", "block", "other"]).filter("uid_a < uid_b").select("table_name", "uid_a", "uid_b")
    across = links.select("table_name", "a", "b")
    for c in "ab":
        n = blocks.select("table_name", F.col("set_id").alias(c), F.col("blocks").alias("n"))
        across = across.join(n, ["table_name", c]).withColumn(f"block_{c}", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    for c in "ab":
        across = across.join(placed.select("table_name", F.col("set_id").alias(c), F.col("block").alias(f"block_{c}"), F.col("uid").alias(f"u{c}")), ["table_name", c, f"block_{c}"])
    out = copies.unionByName(across.select("table_name", F.least("ua", "ub").alias("uid_a"), F.greatest("ua", "ub").alias("uid_b")))
    return out if ALL_PAIRS is None else out.unionByName(stars)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return found(p5.texts(spark, sf))


def p6_classes(spark: SparkSession, sf: str) -> DataFrame:
    """(table_name, uid, class_id, copies, links): each text's class of equal sets, its size and its number of links to other classes."""
    members, links = pairs(p5.texts(spark, sf))
    degree = links.select("table_name", F.col("a").alias("set_id")).union(links.select("table_name", "b")).groupBy("table_name", "set_id").agg(F.count("*").alias("links"))
    size = members.groupBy("table_name", "set_id").agg(F.count("*").alias("copies"), F.min("uid").alias("class_id"))
    return members.join(size.join(degree, ["table_name", "set_id"], "left"), ["table_name", "set_id"]).select("table_name", "uid", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))


def p6_links(spark: SparkSession, sf: str) -> DataFrame:
    """(table_name, class_a, class_b, jaccard): the links between different texts, each class by its least uid; with `p6_classes` the whole result without a pair for every two copies."""
    members, links = pairs(p5.texts(spark, sf))
    least = members.groupBy("table_name", "set_id").agg(F.min("uid").alias("uid"))
    for c in "ab":
        links = links.join(least.select("table_name", F.col("set_id").alias(c), F.col("uid").alias(f"u{c}")), ["table_name", c])
    return links.select("table_name", F.least("ua", "ub").alias("class_a"), F.greatest("ua", "ub").alias("class_b"), "jaccard")
