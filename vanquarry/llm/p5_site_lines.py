"""P5: lines repeated across one site's documents.

Method: each text, in consistent form without digits, letter case and white space, is one stream of characters that
content-defined chunking cuts where a rolling hash of the last WINDOW characters has its top bits zero; line ends play no
part. Documents are counted per chunk and site. A line all of whose chunks are counted often enough is a candidate (a
line too short to hold a whole chunk counts as a chunk of its own); on the candidates, which are few, the exact rule is
checked: distinct uids per wording and site, both marks, at most two sites.
`passages` does the same without lines: runs of chunks that are repeated excessively, each counted over distinct uids, are found
however the documents wrap them.
The chunk count is of rows, so never less than that of uids; hence every line that meets the rule is a candidate.

Defined results: null and empty texts have no lines; a null uid or an address without a host leaves the row out (it belongs to no
site); equal rows, and rows with the same uid, count once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import BLANK, Memo, consistent, cut, host, lower_codes, mix, polynomial, read, small_rows, spans

TABLES = ("legal_docs", "court_cases")
LEAST_DOCS, LEAST_SHARE, MOST_HOSTS, LEAST_WORDS = 5, 0.1, 2, 3
WINDOW, BITS, RUN = 4, 4, 4  # a cut after every 2**BITS characters on average
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")

_ENOUGH = Memo(lambda line: len(_WORDS.findall(line)) >= LEAST_WORDS, 100_000)


class Scan:
    """A text as code points: text (consistent, lower case) and their kinds, the line of each, and of the stream without digits and white space the characters, where lines end in it, and the hash of each line's wording (0 for none)."""

    def __init__(self, text: str):
        self.string, self.text, self.kinds = lower_codes(text)
        self.end = np.flatnonzero(self.text == 10)
        kept = np.flatnonzero(self.kinds & BLANK == 0)
        self.kept, self.stream = kept, self.text[kept]
        self.upto = np.searchsorted(kept, np.append(self.end, len(self.text)))
        self.first = np.concatenate([[0], self.upto[:-1]])
        self.sums, self.inverse = polynomial(self.stream)
        self.wording = self.hashes(self.first, self.upto)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of stretches of the stream; 0 for those of no length."""
        n = ends - starts
        return np.where(n > 0, mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + n.astype(np.uint64)), np.uint64(0)).view(np.int64)

    def line(self, places: np.ndarray) -> np.ndarray:
        """The line of characters of the text, from 0."""
        return np.searchsorted(self.end, places, side="left")

    def cuts(self) -> np.ndarray:
        """Where content-defined chunks of the stream end; what follows the last is no chunk."""
        c, m = self.stream, len(self.stream) - WINDOW + 1
        if m < 1:
            return np.zeros(0, np.int64)
        # the rolling hash of WINDOW characters, from the prefix sums
        roll = (self.sums[WINDOW:] - self.sums[:m]) * self.inverse[:m]
        return np.flatnonzero(roll * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS) == 0) + WINDOW

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of all chunks of the stream, whatever lines they lie in, but what is before the first cut."""
        ends = self.cuts()
        starts, ends = ends[:-1], ends[1:]
        return self.hashes(starts, ends), starts, ends

    def places(self) -> np.ndarray:
        """Where each character of the stream is in the string."""
        if len(self.text) == len(self.string):
            return self.kept
        return np.repeat(np.arange(len(self.string)), [len(c.lower()) for c in self.string])[self.kept]

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and line of each chunk that lies in one line and doesn't depend on what is before it, and the lines that hold no such chunk."""
        ends = self.cuts()
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        line = np.searchsorted(self.upto, starts, side="right")
        at = np.minimum(line, len(self.upto) - 1)
        # a cut is settled by the WINDOW characters before it
        inside = (ends <= self.upto[at]) & (starts >= self.first[at] + WINDOW)
        without = self.upto > self.first
        without[line[inside]] = False
        return self.hashes(starts[inside], ends[inside]), line[inside], np.flatnonzero(without)


def wording(line: str) -> int:
    """Hash of a line's wording, as in Scan."""
    return int(Scan(line.replace("\n", " ")).wording[0])


def _count(batches: Iterator[pd.DataFrame], of) -> Iterator[pd.DataFrame]:
    for b in batches:
        for (name, site), part in b.groupby(["table_name", "host"]):
            chunk, n = np.unique(np.concatenate([np.unique(of(Scan(t))) for t in part["raw_text"]]), return_counts=True)
            yield pd.DataFrame({"table_name": name, "host": site, "chunk": chunk, "n": n.astype(np.int64)})


def _within_lines(scan: Scan) -> np.ndarray:
    hashes, _, short = scan.chunks()
    return np.concatenate([hashes, scan.wording[short]])


def _all(scan: Scan) -> np.ndarray:
    return scan.stretches()[0]


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """(table_name, uid, host, raw_text) of both tables, the rows as they are."""
    return both(*[read(spark, sf, t) for t in TABLES])


def both(docs: DataFrame, cases: DataFrame) -> DataFrame:
    one = [d.select(F.lit(t).alias("table_name"), "uid", host().alias("host"), "raw_text") for t, d in zip(TABLES, (docs, cases))]
    return one[0].unionByName(one[1])


def marks(rows: DataFrame, least_docs: int, least_share: float) -> DataFrame:
    """(table_name, host, least): the number of uids that a wording needs at each host."""
    uids = rows.select("table_name", "host", "uid").distinct().groupBy("table_name", "host").agg(F.count("*").alias("uids"))
    return uids.select("table_name", "host", F.greatest(F.lit(least_docs), F.ceil(F.col("uids") * F.lit(least_share) - 1e-9)).alias("least"))


def chunk_counts(rows: DataFrame, of=_within_lines) -> DataFrame:
    """(table_name, host, chunk, n): rows per chunk (those that `of` gives of a Scan) and site, counted within each batch before anything is shuffled."""
    count = lambda batches: _count(batches, of)
    return rows.select("table_name", "host", "raw_text").mapInPandas(count, "table_name string, host string, chunk bigint, n bigint").groupBy("table_name", "host", "chunk").agg(F.sum("n").alias("n"))


def with_chunks(rows: DataFrame, hot: DataFrame, broadcast_limit: int):
    """rows, and a function that gives of a batch the chunks in hot(table_name, host, chunk) of each row's site: broadcast if few, else joined as a list per site, which is bounded by the share."""
    few = small_rows(hot, broadcast_limit)
    if few is None:
        lists = hot.groupBy("table_name", "host").agg(F.collect_list("chunk").alias("chunks"))
        return rows.join(lists, ["table_name", "host"]), lambda b: b["chunks"]
    by: dict = {}
    for r in few:
        by.setdefault((r["table_name"], r["host"]), []).append(r["chunk"])
    sent = rows.sparkSession.sparkContext.broadcast({k: np.array(sorted(v), np.int64) for k, v in by.items()})
    return rows, lambda b: [sent.value.get(k, np.zeros(0, np.int64)) for k in zip(b["table_name"], b["host"])]


def candidates(rows: DataFrame, hot: DataFrame, broadcast_limit: int) -> DataFrame:
    """(table_name, host, uid, line_no, wording) of the lines all of whose chunks are in hot(table_name, host, chunk)."""
    schema = "table_name string, host string, uid string, line_no bigint, wording bigint"
    rows, chunks_of = with_chunks(rows, hot, broadcast_limit)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, site, uid, text, chunk in zip(b["table_name"], b["host"], b["uid"], b["raw_text"], chunks_of(b)):
                scan = Scan(text)
                hashes, line, short = scan.chunks()
                often = np.isin(hashes, chunk)
                hit = np.concatenate([np.setdiff1d(line[often], line[~often]), short[np.isin(scan.wording[short], chunk)]])
                if len(hit):
                    lines = scan.string.split("\n")
                    out += [(name, site, uid, int(i) + 1, int(scan.wording[i])) for i in hit if _ENOUGH[lines[i]]]
            yield pd.DataFrame(out, columns=["table_name", "host", "uid", "line_no", "wording"])

    return rows.mapInPandas(mark, schema)


def repeated(rows: DataFrame, least_docs: int = LEAST_DOCS, least_share: float = LEAST_SHARE, most_hosts: int = MOST_HOSTS, broadcast_limit: int = 200_000) -> DataFrame:
    """(table_name, host, uid, line_no, wording): the repeated lines of rows(table_name, uid, host, raw_text); wording is a hash."""
    rows = rows.filter("uid is not null and host <> '' and raw_text is not null").select("table_name", "uid", "host", "raw_text")
    least = cut(marks(rows, least_docs, least_share))  # used three times
    hot = chunk_counts(rows).join(least, ["table_name", "host"]).filter("n >= least").select("table_name", "host", "chunk")
    some = cut(candidates(rows, hot, broadcast_limit).distinct())  # used twice
    counted = some.select("table_name", "host", "wording", "uid").distinct().groupBy("table_name", "host", "wording").agg(F.count("*").alias("n"))
    often = counted.join(least, ["table_name", "host"]).filter("n >= least")
    keep = often.join(often.groupBy("table_name", "wording").agg(F.count("*").alias("hosts")).filter(F.col("hosts") <= most_hosts), ["table_name", "wording"], "left_semi")
    return some.join(keep.select("table_name", "host", "wording"), ["table_name", "host", "wording"])


def passages(rows: DataFrame, least_docs: int = LEAST_DOCS, least_share: float = LEAST_SHARE, most_hosts: int = MOST_HOSTS, broadcast_limit: int = 200_000) -> DataFrame:
    """(table_name, uid, start, end): the stretches, as places in the consistent form of rows' texts, of at least RUN chunks on end that go over a line end and are each in enough uids of the site, and not in more hosts than most_hosts. So a text is found that sites wrap differently in each document; at each end less than a chunk stays."""
    rows = rows.filter("uid is not null and host <> '' and raw_text is not null").select("table_name", "uid", "host", "raw_text")
    least = cut(marks(rows, least_docs, least_share))
    near = chunk_counts(rows, _all).join(least, ["table_name", "host"]).filter("n >= least").select("table_name", "host", "chunk")
    some, chunks_of = with_chunks(rows, near, broadcast_limit)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [np.unique(np.intersect1d(_all(Scan(t)), c)) for t, c in zip(b["raw_text"], chunks_of(b))]
            n = list(map(len, found))
            yield pd.DataFrame({k: np.repeat(b[k].to_numpy(), n) for k in ("table_name", "host", "uid")} | {"chunk": np.concatenate([*found, np.zeros(0, np.int64)])})

    uids = some.mapInPandas(mark, "table_name string, host string, uid string, chunk bigint").distinct().groupBy("table_name", "host", "chunk").agg(F.count("*").alias("n"))
    often = cut(uids.join(least, ["table_name", "host"]).filter("n >= least").select("table_name", "host", "chunk"))
    hot = often.join(often.groupBy("table_name", "chunk").agg(F.count("*").alias("hosts")).filter(F.col("hosts") <= most_hosts), ["table_name", "chunk"], "left_semi")
    every, hot_of = with_chunks(rows, hot, broadcast_limit)

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, uid, text, chunk in zip(b["table_name"], b["uid"], b["raw_text"], hot_of(b)):
                scan = Scan(text)
                hashes, starts, ends = scan.stretches()
                first, last = spans(np.isin(hashes, chunk))
                for i, j in zip(first.tolist(), last.tolist()):
                    if j - i >= RUN and np.searchsorted(scan.upto, starts[i], side="right") < np.searchsorted(scan.upto, ends[j - 1], side="left"):
                        place = scan.places()
                        out.append((name, uid, int(place[starts[i]]), int(place[ends[j - 1] - 1]) + 1))
            yield pd.DataFrame(out, columns=["table_name", "uid", "start", "end"])

    return every.mapInPandas(runs, "table_name string, uid string, start bigint, end bigint").distinct()


def without_lines(text: str, line_nos: set[int]) -> str:
    return "\n".join(x for i, x in enumerate(text.split("\n"), 1) if i not in line_nos)


def without(text: str, line_nos: set[int], stretches: list[tuple[int, int]]) -> str:
    """The text without lines and, in its consistent form then, without stretches of characters."""
    if not stretches:
        return without_lines(text, line_nos)
    text = consistent(text)
    out, at = [], 0
    for line_no, line in enumerate(text.split("\n"), 1):
        if line_no not in line_nos:
            inside = [(max(0, a - at), b - at) for a, b in stretches if a < at + len(line) and b > at]
            rest, upto = [], 0
            for a, b in sorted(inside):
                rest.append(line[upto:a])
                upto = max(upto, b)
            rest.append(line[upto:])
            left = "".join(rest)
            if not inside or left.strip():
                out.append(left)
        at += len(line) + 1
    return "\n".join(out)


def cleaned(rows: DataFrame, **marks_) -> DataFrame:
    """(table_name, uid, raw_text, lines_removed, passages_removed): each uid's text without the repeated lines and the repeated passages over several lines."""

    @F.pandas_udf(StringType())
    def remove(text: pd.Series, nos: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        each = lambda x: [] if x is None else [int(i) for i in x]
        return pd.Series([t if t is None or n is None and a is None else without(t, set(each(n)), list(zip(each(a), each(b)))) for t, n, a, b in zip(text, nos, starts, ends)])

    found = repeated(rows, **marks_).groupBy("table_name", "uid").agg(F.collect_set("line_no").alias("nos"))
    spread = passages(rows, **marks_).groupBy("table_name", "uid").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cut"))
    once = rows.groupBy("table_name", "uid").agg(F.min("raw_text").alias("raw_text"))
    both_ = once.join(found, ["table_name", "uid"], "left").join(spread, ["table_name", "uid"], "left")
    return both_.select("table_name", "uid", remove("raw_text", "nos", "cut.start", "cut.end").alias("raw_text"), F.coalesce(F.size("nos"), F.lit(0)).alias("lines_removed"), F.coalesce(F.size("cut"), F.lit(0)).alias("passages_removed"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return repeated(texts(spark, sf)).select("table_name", "uid", "line_no")


def p5_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(texts(spark, sf))
