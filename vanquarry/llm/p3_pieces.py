"""Splitting oversized items at natural boundaries, with a given overlap.

Method: prefix sums of the token lengths give every token's end; the ends that are natural places (end of paragraph, of
sentence, of word) form sorted arrays; each cut is the last boundary within the limit, found by binary search, of the
strongest kind present in the last half of the piece; the next piece starts `overlap` characters before the cut; a text
without any boundary there is cut hard (not before a combining mark, if that can be avoided).

Defined results: null and empty values and those within the limit give no pieces (with oversized=False one piece each,
empty values none); a field without a limit, or with a null limit, gives none; every piece but the first begins exactly
`overlap` characters before the end of the one before; a limit below 1, or an overlap not below the limit, raises
ValueError; rows with the same id count once; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parameters, read

IDS = {"legal_docs": "uid", "court_cases": "uid", "legal_articles": "article_uid"}
SCHEMA = "field_name string, item_id string, piece_no int, start_char int, end_char int, piece string"
_TOKEN = re.compile(r"\S+\s*|\s+")


def offsets(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of text."""
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError(f"limit {limit}, overlap {overlap}")
    n = len(text)
    if n <= limit:
        return [(0, n)] if n else []
    tokens = _TOKEN.findall(text)
    ends = np.cumsum([len(t) for t in tokens])
    bare = [t.rstrip() for t in tokens]
    paragraph = ends[[("\n" in t[len(b) :]) for t, b in zip(tokens, bare)]]
    sentence = ends[[b[-1:] in tuple(".;:!?…。；！？") and b[-1:] != "" for b in bare]]
    out, start = [], 0
    while n - start > limit:
        least, most, cut = start + overlap, start + limit, 0
        for kind, floor in ((paragraph, max(least, start + limit // 2)), (sentence, max(least, start + limit // 2)), (ends, least)):
            i = int(np.searchsorted(kind, most, side="right")) - 1
            if i >= 0 and kind[i] > floor:
                cut = int(kind[i])
                break
        if not cut:
            cut = most
            while cut > least + 1 and unicodedata.combining(text[cut]):
                cut -= 1
        out.append((start, cut))
        start = cut - overlap
    out.append((start, n))
    return out


def pieces(df: DataFrame, limit: int, overlap: int, oversized: bool = True) -> DataFrame:
    """SCHEMA from df(field_name, item_id, value)."""
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError(f"limit {limit}, overlap {overlap}")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(f, i, k, s, e, v[s:e]) for f, i, v in zip(b["field_name"], b["item_id"], b["value"]) for k, (s, e) in enumerate(offsets(v, limit, overlap), 1)]
            yield pd.DataFrame(rows, columns=["field_name", "item_id", "piece_no", "start_char", "end_char", "piece"])

    rows = df.filter(F.char_length("value") > (limit if oversized else 0)).select("field_name", "item_id", "value")
    return rows.dropDuplicates(["field_name", "item_id"]).mapInPandas(split, SCHEMA)


def all_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of every field named in size_limits (a parameter table, checked to hold at most 1,000 rows)."""
    out = spark.createDataFrame([], SCHEMA)
    for r in parameters(read(spark, sf, "size_limits")):
        if r["field_name"] and r["max_chars"] is not None:
            table, column = r["field_name"].split(".")
            rows = read(spark, sf, table).select(F.lit(r["field_name"]).alias("field_name"), F.col(IDS[table]).alias("item_id"), F.col(column).alias("value"))
            out = out.unionByName(pieces(rows, r["max_chars"], r["overlap_chars"] or 0))
    return out


def p3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return all_pieces(spark, sf)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return all_pieces(spark, sf).filter("piece_no = 2").select("field_name", "item_id")
