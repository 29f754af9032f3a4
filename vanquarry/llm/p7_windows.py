"""Filling fixed-capacity containers with items.

Method: the histogram of item lengths (in units of a bounded number per container, rounded up) is covered by configurations,
that is sets of lengths that fit into one container. The linear program over all configurations, to use the fewest
containers, is solved by multiplicative weights: lengths not yet covered weigh more; the configuration of the greatest weight
is priced by knapsack dynamic programming. The fractional counts are rounded down, and what is left is filled by further
configurations, priced the same way with the lengths themselves as weights. As the histogram has at most UNITS
entries however many items there are, each container's program is one task; the items are then numbered within their length in salted
groups and meet their containers by arithmetic.

Defined results: an item is split only if it alone exceeds the capacity, into full containers and a rest; null texts are no
items; an empty text has 0 tokens and takes one unit; repeated rows of an id count once (the least text); documents with equal
texts are different items; an empty table gives an empty result; a capacity below 1 raises ValueError; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, parameters, read, small_rows

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
UNITS, ROUNDS, RATE, GROUP = 1024, 300, 0.15, 500_000
# Fixed value: the pattern that splits text before the merges of the rank file, part of the tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODINGS: dict = {}


def encoding(path: str):
    """One tokenizer per process."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of docs(doc_id, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoding(tokenizer)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [len(e.encode_ordinary(t)) for t in b["text"]]})

    rows = docs.select("doc_id", "text").filter("doc_id is not null and text is not null").mapInPandas(count, "doc_id bigint, n_tokens bigint")
    return rows.groupBy("doc_id").agg(F.min("n_tokens").alias("n_tokens"))


def knapsack(sizes: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """A set of items {index: times} that fits, of the greatest value (any number of each, cut down to most)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    s, v = sizes[order], values[order]
    upto = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], k = best[c - 1], upto[c]
        if k:
            x = best[c - s[:k]] + v[:k]
            i = int(x.argmax())
            if x[i] > best[c] + 1e-15:
                best[c], pick[c] = x[i], order[i]
    out, c = Counter(), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
            continue
        i = int(pick[c])
        out[i] += 1
        c -= int(sizes[i])
    out = {i: min(n, int(most[i])) for i, n in out.items() if most[i] > 0}
    # room that the cut leaves goes to the largest items that fit
    left = capacity - sum(int(sizes[i]) * n for i, n in out.items())
    for i in order[::-1]:
        n = min(left // int(sizes[i]), int(most[i]) - out.get(int(i), 0))
        if n > 0:
            out[int(i)] = out.get(int(i), 0) + int(n)
            left -= int(n) * int(sizes[i])
    return out


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS, rate: float = RATE) -> list[tuple[int, dict[int, int]]]:
    """(number of containers, {length: items in each}): together exactly the items of the histogram {length: items}."""
    if capacity < 1 or any(not 0 < s <= capacity for s in histogram):
        raise ValueError("lengths must be from 1 to the capacity")
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    if not len(sizes):
        return []
    # multiplicative weights for the covering program, begun at the dual solution "value = length": coverage is the share of each
    # length's items in the configurations so far, and what is covered more than others loses value
    use: Counter = Counter()
    coverage = np.zeros(len(sizes))
    step = max(1.0, float((sizes * counts).sum()) / capacity) / rounds
    for _ in range(rounds):
        weight = np.exp(-rate * rounds / 10 * (coverage - coverage.mean())) * sizes
        found = knapsack(sizes, weight, counts, capacity)
        amount = min([step, *(counts[i] / n for i, n in found.items())])
        use[tuple(sorted(found.items()))] += amount
        for i, n in found.items():
            coverage[i] += amount * n / counts[i]
    # rounding: of the configurations, those at least so full, in order of their counts; the best division is kept
    return min((_round(sizes, counts, capacity, use, least) for least in (0.0, 0.99, 0.998, 1.0)), key=lambda p: sum(t for t, _ in p))


def _round(sizes: np.ndarray, counts: np.ndarray, capacity: int, use: Counter, least: float) -> list[tuple[int, dict[int, int]]]:
    """The configurations' counts rounded down, and what is left filled by further configurations."""
    left, out = counts.copy(), []

    def take(found, times: int) -> None:
        times = min([times, *(int(left[i]) // n for i, n in found)])
        if times > 0:
            for i, n in found:
                left[i] -= times * n
            out.append((times, {int(sizes[i]): n for i, n in found}))

    for found, x in use.most_common():
        if sum(int(sizes[i]) * n for i, n in found) >= least * capacity:
            take(found, int(x))
    # the fullest configuration with the largest item left
    while left.any():
        on = np.flatnonzero(left)
        big = on[-1]
        room = capacity - int(sizes[big])
        found = Counter({int(big): 1})
        fit = on[sizes[on] <= room]
        if len(fit):
            for i, n in knapsack(sizes[fit], sizes[fit].astype(float), left[fit] - (fit == big), room).items():
                found[int(fit[i])] += n
        take(sorted(found.items()), int(left.max()))
    return out


def items(counts: DataFrame, windows: list[tuple[str, int]]) -> DataFrame:
    """(window_name, capacity, unit, doc_id, piece_no, start_token, n_tokens, length): the pieces for each window; length is in units."""
    out = None
    for name, capacity in windows:
        unit = -(-capacity // UNITS)
        one = counts.select(
            F.lit(name).alias("window_name"),
            F.lit(capacity).cast("bigint").alias("capacity"),
            "doc_id",
            F.posexplode(F.expr(f"transform(sequence(0L, greatest(0L, (n_tokens - 1) div {capacity})), k -> least({capacity}L, n_tokens - k * {capacity}L))")).alias("piece_no", "n_tokens"),
        ).withColumn("length", F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / unit)).cast("int"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("start_token", F.col("piece_no") * F.col("capacity"))


def solve(spark: SparkSession, histogram: list, windows: list[tuple[str, int]]) -> DataFrame:
    """(window_name, length, ends, first, n): of each length the containers with n items of it from number first on, up to the item number in ends; one task per window. Lengths and configurations are bounded by UNITS and ROUNDS."""
    of: dict[str, list] = {name: [] for name, _ in windows}
    for r in histogram:
        of[r["window_name"]].append((r["length"], r["n"]))
    rows = [(name, capacity // -(-capacity // UNITS), [x for x, _ in of[name]], [n for _, n in of[name]]) for name, capacity in windows]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, room, lengths, ns in zip(b["window_name"], b["room"], b["lengths"], b["ns"]):
                table: dict[int, list] = {}
                first = 0
                for times, found in plan(dict(zip(map(int, lengths), map(int, ns))), int(room)):
                    for length, n in found.items():
                        table.setdefault(length, []).append((times * n, first, n))
                    first += times
                for length, parts in table.items():
                    a = np.array(parts, np.int64)
                    out.append((name, length, np.cumsum(a[:, 0]), a[:, 1], a[:, 2]))
            yield pd.DataFrame(out, columns=["window_name", "length", "ends", "first", "n"])

    df = spark.createDataFrame(rows, "window_name string, room bigint, lengths array<bigint>, ns array<bigint>").repartition(len(rows))
    return df.mapInPandas(work, "window_name string, length int, ends array<bigint>, first array<bigint>, n array<bigint>")


def fill(counts: DataFrame, windows: list[tuple[str, int]]) -> DataFrame:
    """(window_name, window_no, doc_id, piece_no, start_token, n_tokens) of counts(doc_id, n_tokens)."""
    if any(c < 1 for _, c in windows):
        raise ValueError("a capacity below 1")
    spark = counts.sparkSession
    schema = "window_name string, window_no bigint, doc_id bigint, piece_no int, start_token bigint, n_tokens bigint"
    if not windows:
        return spark.createDataFrame([], schema)
    pieces = items(counts, windows)
    histogram = small_rows(pieces.groupBy("window_name", "length").agg(F.count("*").alias("n")), (UNITS + 1) * len(windows))
    slots = {(r["window_name"], r["length"]): tuple(np.array(r[c], np.int64) for c in ("ends", "first", "n")) for r in solve(spark, histogram, windows).collect()}
    sent = spark.sparkContext.broadcast(slots)
    total = sum(r["n"] for r in histogram)
    salts = max(8, total // GROUP)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(salts)).cast("int"))
    before = (
        salted.groupBy("window_name", "length", "salt").agg(F.count("*").alias("n"))
        .withColumn("before", F.expr("sum(n) over (partition by window_name, length order by salt rows between unbounded preceding and 1 preceding)"))
        .select("window_name", "length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    ranked = salted.withColumn("row", F.expr("row_number() over (partition by window_name, length, salt order by doc_id, piece_no)")).join(before, ["window_name", "length", "salt"])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.reset_index(drop=True)
            no = np.zeros(len(b), np.int64)
            rank = (b["before"] + b["row"] - 1).to_numpy(np.int64)
            for k, at in b.groupby(["window_name", "length"]).indices.items():
                ends, first, n = sent.value[k]
                i = np.searchsorted(ends, rank[at], side="right")
                no[at] = first[i] + (rank[at] - np.where(i > 0, ends[i - 1], 0)) // n[i]
            yield pd.DataFrame({"window_name": b["window_name"], "window_no": no, "doc_id": b["doc_id"], "piece_no": b["piece_no"], "start_token": b["start_token"], "n_tokens": b["n_tokens"]})

    return ranked.select("window_name", "length", "before", "row", "doc_id", "piece_no", "start_token", "n_tokens").mapInPandas(place, schema)


def windows_of(spark: SparkSession, sf: str) -> list[tuple[str, int]]:
    """The parameter table, checked to hold at most 1,000 rows."""
    return sorted({(r["window_name"], r["capacity_tokens"]) for r in parameters(read(spark, sf, "context_windows")) if r["window_name"] and r["capacity_tokens"] is not None})


def p7_windows(spark: SparkSession, sf: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return fill(cut(token_counts(read(spark, sf, "documents"), tokenizer)), windows_of(spark, sf))


def p7_report(spark: SparkSession, sf: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(window_name, windows, items, tokens, filled, bound): how many windows each capacity takes, the share of their room that is used, and the windows that the tokens alone need, below which nothing can go."""
    size = dict(windows_of(spark, sf))
    names = F.create_map(*[F.lit(x) for kv in size.items() for x in kv])
    return p7_windows(spark, sf, tokenizer).groupBy("window_name").agg(
        F.countDistinct("window_no").alias("windows"), F.count("*").alias("items"), F.sum("n_tokens").alias("tokens")
    ).withColumn("filled", F.round(F.col("tokens") / (F.col("windows") * names[F.col("window_name")]), 4)).withColumn("bound", F.ceil(F.col("tokens") / names[F.col("window_name")]))
