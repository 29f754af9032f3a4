"""Answer metrics. The arguments are in loose form already, so that it is computed once per row."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda x: x != "")


def token_f1(prediction: Column, gold: Column) -> Column:
    """M1: F1 of the two multisets of tokens; 1 if both are empty, 0 if one is.

    The counts come from sorted copies: with the tokens sorted, what two multisets share is the number of (token, k-th
    occurrence) pairs that both hold.
    """

    def numbered(c: Column) -> Column:
        s = F.array_sort(_tokens(c))
        return F.transform(s, lambda x, i: F.concat_ws(" ", x, (i - F.array_position(s, x)).cast("string")))

    p, g = numbered(prediction), numbered(gold)
    same, np_, ng = F.size(F.array_intersect(p, g)), F.size(p), F.size(g)
    return F.when((np_ == 0) & (ng == 0), 1.0).when((np_ == 0) | (ng == 0) | (same == 0), 0.0).otherwise(2.0 * same / (np_ + ng))


def length_ratio(prediction: Column, gold: Column) -> Column:
    """M3: the shorter length over the longer; 1 if both are empty."""
    p, g = F.char_length(prediction), F.char_length(gold)
    return F.when((p == 0) & (g == 0), 1.0).when((p == 0) | (g == 0), 0.0).otherwise(F.least(p, g) / F.greatest(p, g))


@F.pandas_udf(DoubleType())
def char_similarity(prediction: pd.Series, gold: pd.Series) -> pd.Series:
    """M2: Ratcliff-Obershelp ratio with popular characters of long gold texts ignored; not symmetric, so the order matters."""
    return pd.Series([None if p is None or g is None else difflib.SequenceMatcher(None, p, g).ratio() for p, g in zip(prediction, gold)], dtype="float64")
