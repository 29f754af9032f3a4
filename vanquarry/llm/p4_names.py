"""Variant spellings of names typed by people.

Method: trie join. The distinct typed names are sharded by ranges of their letters, so that those of a shard share their
beginnings, and each shard is put into a trie; the registered names, with the short forms that rules derive from them, are put
into another per kind of entity. The tries are joined: along every path of the registered trie goes a Levenshtein automaton whose
states are the nodes of the typed trie within the bound, so that all names with the same beginning are compared at once.
Names that meet none are put into a trie again in other orders: rotations of their words or parts, permutations of up to MOST_PARTS parts,
and last by their words in sorted order, which meets a name of any length in any order of its words, but without errors.
Letters are compared without marks; of several entities at the least distance the one closest with marks is
taken, and if that is no single one, none. Digits must agree.

The names are compared in consistent form (P1). Typed names are made distinct before anything else, so a name that a third
of all rows hold is looked up once. The registry, a stated set of names, is sent in blocks of BLOCK names; its tries are built where they are used.

Defined results: null and blank names link to nothing; a name equal to the canonical name of its entity is linked, but is no
case of `p4_found`; registry rows without name or kind are left out, repeated ones count once; rows with the same uid
count once; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import consistent, read, small_rows

FIELDS = (("legal_docs", "issuing_body", "body"), ("legal_docs", "signer", "signer"), ("court_cases", "court_name", "court"))
BLOCK, CHUNK, MOST_PARTS, BOUND = 50_000, 20_000, 5, 2
# Abbreviations usual in Vietnamese names of offices, written out without marks.
SHORT = {
    "tand": "toa an nhan dan", "ubnd": "uy ban nhan dan", "hdnd": "hoi dong nhan dan", "nd": "nhan dan", "ub": "uy ban", "hd": "hoi dong", "ta": "toa an",
    "tvqh": "thuong vu quoc hoi", "ubtvqh": "uy ban thuong vu quoc hoi", "qh": "quoc hoi", "cp": "chinh phu", "ttg": "thu tuong chinh phu", "ttcp": "thu tuong chinh phu",
    "kv": "khu vuc", "t": "tinh", "h": "huyen", "q": "quan", "tp": "thanh pho", "tx": "thi xa", "tt": "thu tuong",
}
# Titles and remarks beside a person's name.
TITLES = {"ong", "ba", "ts", "ths", "gs", "pgs", "ls", "kt", "tm", "tl", "ct", "pct", "q", "bt", "tt", "dong chi", "luat su", "tham phan"}
REMARK = re.compile(r"\((?:đã ký|da ky|ký|cũ|cu|mới|moi)[^)]*\)", re.I)
LEVELS = ("tinh", "thanh pho", "huyen", "quan", "thi xa")
_DIGITS = re.compile(r"\d+")


def plain(t: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", t.lower().replace("đ", "d")) if not unicodedata.combining(c))


def office_words(t: str) -> str:
    """Name of an office without marks, abbreviations written out, words apart."""
    t = re.sub(r"(?<![\w])((?:\w\.){2,}\w?)(?!\w)", lambda m: m.group().replace(".", "") + " ", plain(t))
    t = re.sub(r"(?<=[a-z])(?=\d)|(?<=\d)(?=[a-z])", " ", t)
    return " ".join(SHORT.get(w, w) for w in re.findall(r"[^\W_]+", t))


def key(t: str) -> str:
    return t.replace(" ", "")


def office_forms(name: str) -> dict[str, int]:
    """Forms of a registered office, each with the greatest distance at which it may be met."""
    full = office_words(name)
    out = {full: 2}
    for whole, heads in (("toa an nhan dan", ("toa an nhan dan", "toa an", "toa")), ("uy ban nhan dan", ("uy ban nhan dan", "uy ban")), ("hoi dong nhan dan", ("hoi dong nhan dan", "hoi dong"))):
        if full.startswith(whole + " "):
            rest = full[len(whole) + 1 :]
            rests = {rest}
            for level in LEVELS:
                if rest.startswith(level + " "):
                    at = rest.find(" tinh ", len(level))
                    one = rest[:at] if at > 0 else rest
                    rests |= {one, one[len(level) + 1 :]} | ({one + rest[at + 5 :], one[len(level) + 1 :] + rest[at + 5 :], one[len(level) + 1 :] + rest[at:]} if at > 0 else set())
                    break
            out |= {f"{h} {r}": out.get(f"{h} {r}", 2 if len(h) + len(r) > 14 else 1) for h in heads for r in rests}
    words = full.split()
    if len(words) > 1 and full not in SHORT.values():
        out.setdefault("".join(w[0] for w in words), 0)
        out.setdefault("".join(w[0] for w in words if w != "va"), 0)
    if full.startswith("thu tuong "):
        out["thu tuong"] = 1
    return out


def person_words(t: str) -> list[str]:
    """Words without marks, titles and remarks; a full stop stays with an abbreviated word."""
    ws = re.findall(r"[^\W\d_]+\.?", plain(REMARK.sub(" ", t)))
    while len(ws) > 1 and ws[0].rstrip(".") in TITLES and (ws[0][-1] != "." or len(ws[0]) > 2):
        ws = ws[1:]
    return ws


def person_forms(name: str) -> dict[str, int]:
    ws = [w.rstrip(".") for w in person_words(name)]
    out = {"".join(ws): 2}
    if len(ws) > 2:
        first, middle, last = ws[0], ws[1:-1], ws[-1]
        short = ["".join(middle) + last, first + last, "".join(w[0] + "." for w in ws[:-1]) + last]
        short += [first + "".join(w[:n] + "." for w in middle) + last for n in (1, 2)]
        short += [first[:n] + "." + "".join(middle) + last for n in range(1, len(first) + 1)]
        for s in short:
            out.setdefault(s, 0)
    return out


class Trie:
    """Nodes are numbers: next[n] leads from a character to a node; ends[n] holds the entries of the words that end there."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.ends: dict[int, list] = {}

    def add(self, word: str, entry) -> None:
        n = 0
        for c in word:
            m = self.next[n].get(c)
            if m is None:
                m = self.next[n][c] = len(self.next)
                self.next.append({})
            n = m
        self.ends.setdefault(n, []).append(entry)

    def join(self, other: Trie, bound: int) -> Iterator[tuple[int, list, list]]:
        """(distance, entries here, entries there) of all words within the bound (a swap of neighbours counts one)."""
        there = other.next

        def follow(active: dict[int, int]) -> dict[int, int]:
            queue = [n for n, d in active.items() if d < bound]
            while queue:
                n = queue.pop()
                d = active[n] + 1
                for m in there[n].values():
                    if d < active.get(m, bound + 1):
                        active[m] = d
                        if d < bound:
                            queue.append(m)
            return active

        stack: list[tuple] = [(0, follow({0: 0}), {}, "")]
        while stack:
            node, active, before, last = stack.pop()
            if node in self.ends:
                for n, d in active.items():
                    if n in other.ends:
                        yield d, self.ends[node], other.ends[n]
            for c, child in self.next[node].items():
                new: dict[int, int] = {}
                for n, d in active.items():
                    if d < bound and d + 1 < new.get(n, 9):
                        new[n] = d + 1
                    for x, m in there[n].items():
                        e = d + (x != c)
                        if e <= bound and e < new.get(m, 9):
                            new[m] = e
                for n, d in before.items():
                    m = there[n].get(c)
                    m = None if m is None or d >= bound else there[m].get(last)
                    if m is not None and d + 1 < new.get(m, 9):
                        new[m] = d + 1
                if new:
                    stack.append((child, follow(new), active, c))


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def bound(n: int) -> int:
    return 0 if n < 5 else 1 if n < 9 else 2


def orders(kind: str, name: str) -> tuple[list[str], list[str], str]:
    """Keys of a typed name: as it is, in other orders of its parts and words, and by its sorted words."""
    if kind == "signer":
        ws = person_words(name)
        return ["".join(ws)], ["".join(ws[i:] + ws[:i]) for i in range(1, len(ws))], "".join(sorted(w.rstrip(".") for w in ws))
    parts = [p for p in (office_words(x) for x in re.split(r"\s*[,()]\s*|\s+-\s+", name)) if p]
    bare = office_words(REMARK.sub(" ", name))
    first = [key(" ".join(parts)), key(bare)]
    others = itertools.permutations(parts) if len(parts) <= MOST_PARTS else (parts[i:] + parts[:i] for i in range(len(parts)))
    other = [key(" ".join(p)) for p in others][1:]
    # the levels of a place in the wrong order: head, then the words from a level on moved forward
    ws = office_words(name).split()
    cuts = [i for i, w in enumerate(ws) if w in ("tinh", "huyen", "quan") or ws[i : i + 2] in (["thanh", "pho"], ["thi", "xa"], ["khu", "vuc"])]
    other += ["".join(ws[: cuts[0]] + ws[j:] + ws[cuts[0] : j]) for j in cuts[1:]]
    return list(dict.fromkeys(first)), list(dict.fromkeys(other)), "".join(sorted(bare.split()))


class Registry:
    """Tries by kind, and names by kind and sorted words, of rows (entity_id, entity_kind, canonical_name)."""

    def __init__(self, rows: list[tuple]):
        self.tries: dict[str, Trie] = {}
        self.sorted: dict[tuple[str, str], list] = {}
        for entity, kind, name in rows:
            name = consistent(name)
            full = key(name.lower())
            for form, most in (person_forms(name) if kind == "signer" else office_forms(name)).items():
                self.tries.setdefault(kind, Trie()).add(key(form), (entity, most, key(form), full))
            ws = [w.rstrip(".") for w in person_words(name)] if kind == "signer" else office_words(name).split()
            self.sorted.setdefault((kind, "".join(sorted(ws))), []).append((entity, full))

    def look_up(self, kind: str, names: list[str]) -> list[tuple[str, int, int, int]]:
        """(name, entity, distance without marks, distance with marks) of the entities at the least distance without marks, in the first kind of order that meets any."""
        if kind not in self.tries:
            return []
        out = []
        ways = {n: orders(kind, consistent(n)) for n in names}
        for stage, most_of_all in ((0, BOUND), (1, 1)):
            typed = Trie()
            for n in names:
                for k in ways[n][stage]:
                    if k:
                        typed.add(k, (n, k))
            best: dict[str, dict[int, tuple[int, str]]] = {}
            for d, forms, those in self.tries[kind].join(typed, most_of_all):
                for n, k in those:
                    for entity, most, form, full in forms:
                        if d <= min(most, bound(len(k))) and _DIGITS.findall(k) == _DIGITS.findall(form):
                            at = best.setdefault(n, {})
                            at[entity] = min((d, full), at.get(entity, (9, full)))
            out += [(n, e, d + 10 * stage, full) for n, at in best.items() for e, (d, full) in at.items() if d == min(at.values())[0]]
            names = [n for n in names if n not in best]
        out += [(n, e, 20, full) for n in names for e, full in self.sorted.get((kind, ways[n][2]), ())]
        return [(n, e, d, distance(marked(n), full)) for n, e, d, full in out]


def marked(name: str) -> str:
    return key(" ".join(re.findall(r"[^\W_]+", consistent(name).lower())))


def links(names: DataFrame, registry: DataFrame, block: int = BLOCK) -> DataFrame:
    """(kind, name, entity_id) of the distinct names(kind, name) that mean a registered entity."""
    spark = names.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by number: else so few bytes would be put into one partition
    names = names.filter("trim(name) <> ''").select("kind", "name").distinct().repartitionByRange(shards, "kind", F.lower("name"), "name")
    registry = registry.filter("entity_id is not null and entity_kind is not null and trim(canonical_name) <> ''").select("entity_id", "entity_kind", "canonical_name").distinct()
    schema = "kind string, name string, entity_id bigint, d int, marked int"
    out = None
    for rows in blocks(registry, block):
        sent = spark.sparkContext.broadcast([tuple(r) for r in rows])

        def match(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            registered = Registry(sent.value)
            for b in batches:
                for kind, part in b.groupby("kind"):
                    own = part["name"].tolist()
                    for i in range(0, len(own), CHUNK):
                        yield pd.DataFrame([(kind, *x) for x in registered.look_up(kind, own[i : i + CHUNK])], columns=["kind", "name", "entity_id", "d", "marked"])

        one = names.mapInPandas(match, schema)
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "kind string, name string, entity_id bigint")
    best = out.withColumn("rank", F.expr("rank() over (partition by kind, name order by d, marked)")).filter("rank = 1")
    return best.groupBy("kind", "name").agg(F.min("entity_id").alias("entity_id"), F.countDistinct("entity_id").alias("entities")).filter("entities = 1").select("kind", "name", "entity_id")


def blocks(registry: DataFrame, block: int) -> Iterator[list]:
    """The registry in pieces of at most about block rows, so that what is sent at once is bounded."""
    few = small_rows(registry, block)
    if few is not None:
        if few:
            yield few
        return
    k = -(-registry.count() // block)
    for i in range(k):
        yield registry.filter(F.pmod(F.xxhash64("entity_id"), F.lit(k)) == i).collect()


def typed(spark: SparkSession, sf: str) -> DataFrame:
    """(field_name, uid, kind, name), one row per uid and field."""
    out = None
    for table, column, kind in FIELDS:
        one = read(spark, sf, table).select(F.lit(f"{table}.{column}").alias("field_name"), "uid", F.lit(kind).alias("kind"), F.col(column).alias("name")).filter("name is not null and uid is not null")
        one = one.groupBy("field_name", "uid", "kind").agg(F.min("name").alias("name"))
        out = one if out is None else out.unionByName(one)
    return out


@F.pandas_udf(StringType())
def _form(s: pd.Series) -> pd.Series:
    return s.map(consistent, na_action="ignore")


def p4_links(spark: SparkSession, sf: str) -> DataFrame:
    """(field_name, uid, name, entity_id, canonical_name): every typed name with its entity, null where it means none."""
    names, registry = typed(spark, sf), read(spark, sf, "name_registry")
    linked = links(names, registry).join(registry.select("entity_id", "canonical_name").distinct(), "entity_id")
    return names.join(linked, ["kind", "name"], "left").select("field_name", "uid", "name", "entity_id", "canonical_name")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_links(spark, sf).filter("entity_id is not null").filter(_form("name") != F.col("canonical_name")).select("field_name", "uid", "entity_id").distinct()
