"""Visually identical text with different characters.

Method: the words of all values that hold a suspect character are mapped by a look-alike table and grouped, in SQL, under
the accent-sensitive Unicode collation (which takes composed and decomposed letters and invisible characters for equal);
of each equivalence class a canonical member is chosen (the least among the members in consistent form) and joined back.
"Word" here: a run of characters other than ASCII white space, so that wide spaces and punctuation are parts of words.

Defined results: null values and values without suspect characters give no rows in `variants` and come out of `apply_form`
unchanged (null stays null); an empty table gives an empty result; repeated rows count once; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import consistent, cut, odd, read

FIELDS = (("legal_docs", "raw_text"), ("legal_docs", "title"), ("court_cases", "court_name"), ("court_cases", "raw_text"))
WORD = re.compile(r"[^ \t\r\n\f]+")


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(consistent, na_action="ignore")


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = [(f, i, w) for f, i, v in zip(b["field_name"], b["item_id"], b["value"]) if odd(v) for w in set(WORD.findall(v)) if odd(w)]
        yield pd.DataFrame(out, columns=["field_name", "item_id", "word"])


def values(spark: SparkSession, sf: str, fields=FIELDS) -> DataFrame:
    """(field_name, item_id, value) of the fields, all rows."""
    out = None
    for table, column in fields:
        one = read(spark, sf, table).select(F.lit(f"{table}.{column}").alias("field_name"), F.col("uid").alias("item_id"), F.col(column).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def variants(df: DataFrame) -> DataFrame:
    """(field_name, item_id, word, canonical): each word of df(field_name, item_id, value) that differs from its class's canonical member, once per item."""
    spark = df.sparkSession
    rows = df.filter("value is not null").select("field_name", "item_id", "value")
    words = cut(rows.mapInPandas(_words, "field_name string, item_id string, word string").distinct())  # used three times
    vocabulary = cut(words.select("word").distinct().withColumn("mapped", _fold("word")))  # used twice
    classes = spark.sql(
        """
        SELECT key, min(member) AS canonical
        FROM (SELECT collate(mapped, 'UNICODE') AS key, mapped AS member FROM {v})
        GROUP BY key
        """,
        v=vocabulary,
    )
    canonical = spark.sql("SELECT v.word, CAST(c.canonical AS STRING) AS canonical FROM {v} v JOIN {c} c ON collate(v.mapped, 'UNICODE') = c.key WHERE v.word <> c.canonical", v=vocabulary, c=classes)
    return words.join(canonical, "word").select("field_name", "item_id", "word", "canonical")


@F.pandas_udf(StringType())
def _replace(value: pd.Series, words: pd.Series) -> pd.Series:
    def one(v, w):
        if v is None or w is None:
            return v
        to = {x["word"]: x["canonical"] for x in w}
        return WORD.sub(lambda m: to.get(m.group(), m.group()), v)

    return pd.Series([one(v, w) for v, w in zip(value, words)])


def apply_form(df: DataFrame) -> DataFrame:
    """(field_name, item_id, value, n_words): every value in consistent form, once per item, with the number of distinct words replaced."""
    found = variants(df).groupBy("field_name", "item_id").agg(F.collect_list(F.struct("word", "canonical")).alias("words"))
    once = df.groupBy("field_name", "item_id").agg(F.min("value").alias("value"))
    return once.join(found, ["field_name", "item_id"], "left").select(
        "field_name", "item_id", F.when(F.col("words").isNull(), F.col("value")).otherwise(_replace("value", "words")).alias("value"), F.coalesce(F.size("words"), F.lit(0)).alias("n_words")
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return variants(values(spark, sf)).select("field_name", "item_id").distinct()


def p1_values(spark: SparkSession, sf: str) -> DataFrame:
    return apply_form(values(spark, sf))
