"""Legal documents: title, record and articles from the text."""

from __future__ import annotations

import itertools
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vanquarry.functions import dates, ids, text

# Words that begin the line of a document's type.
TITLE_WORDS = ("BỘ LUẬT", "LUẬT", "NGHỊ ĐỊNH", "NGHỊ QUYẾT", "THÔNG TƯ", "QUYẾT ĐỊNH", "HIẾN PHÁP", "LỆNH", "SẮC LỆNH")
_STOP = re.compile(r"căn\s+cứ\b|(?:chương|mục|điều)\s|(?:nơi nhận|tm\.|kt\.|thủ tướng|bộ trưởng|chủ tịch)\b", re.I)
_TYPE_LINE = re.compile(rf"^(?:(?i:B\nỘ)\nLUẬT$|(?:{'|'.join(TITLE_WORDS)}).*)", re.M)
#: A line that begins an article, up to its end.
HEADING = rf"[\t ]*Điều[{text.SPACE}]+([0-9]+[a-z]?)(?![{text.WORD}])(?:[{text.SPACE}]*\.)?[\t ]*([^\n]*)"
CONNECTIVES = r"(?iu)\A(và|hoặc|của|theo|tại|khoản|điểm)(?![\p{L}\p{N}_])"
LEAST_WORDS = 15


def title_of(t: str) -> str | None:
    """The line of the type, found in the first 50 lines, and the lines of the name after it (of the 12 from there on), as one line.

    The name goes on up to a line that begins something else or, if it stands in capitals, up to a line with small letters. The word
    for a code may be spelt out letter by letter over three lines.
    """
    rows = [x.strip() for x in unicodedata.normalize("NFC", t).split("\n")]
    top = "\n".join(rows[:50])
    found = _TYPE_LINE.search(top)
    if not found:
        return None
    at = top.count("\n", 0, found.end()) + 1
    near = [c for x in itertools.islice(filter(None, rows[at : at + 5]), 1) for c in x if c.isalpha()]
    in_capitals = bool(near) and sum(map(str.isupper, near)) >= 0.8 * len(near)
    name = itertools.takewhile(lambda x: not (_STOP.match(x) or in_capitals and any(map(str.islower, x))), filter(None, rows[at : at + 11]))
    return " ".join(" ".join(["BỘ LUẬT" if "\n" in found.group() else found.group(), *name]).split())


@F.pandas_udf(StringType())
def document_title(s: pd.Series) -> pd.Series:
    return s.map(title_of, na_action="ignore")


def parsed(raw_text: Column, doc_id: Column, doc_type: Column, title_web: Column, issue_date: Column, effective_date: Column, issuing_body: Column, summary: Column, status: Column | None) -> list[Column]:
    """Columns uid, doc_id, title, doc_type, issuing_body, issue_date, effective_date, status, is_amendment, raw_text of a document.

    status is null where none is delivered (as for one of the two sources, P9).
    """
    body = text.nfc(raw_text)
    number = text.strip(text._text(doc_id))
    kind = F.coalesce(doc_type, F.lit("Văn bản"))
    web = text._text(title_web)
    found = document_title(body)
    title = text.strip(F.when((F.coalesce(text.is_weak_title(found), F.lit(True))) & (web != ""), web).otherwise(F.coalesce(found, F.nullif(web, F.lit("")), F.concat_ws(" ", kind, number))))
    issued = dates.vn_date(issue_date)
    effective = F.coalesce(dates.vn_date(effective_date), dates.effective_date(issued, effective_date, summary, body))
    named = F.lower(F.concat_ws(" ", title, web, text._text(summary)))
    return [
        ids.doc_uid(kind, number, F.coalesce(F.nullif(web, F.lit("")), title), issued).alias("uid"), number.alias("doc_id"), title.alias("title"), kind.alias("doc_type"),
        F.coalesce(F.nullif(issuing_body, F.lit("")), text.issuing_body(number)).alias("issuing_body"), issued.alias("issue_date"), effective.alias("effective_date"),
        (F.lit(None).cast("string") if status is None else text.status(status)).alias("status"), (named.contains("sửa đổi") | named.contains("bổ sung")).alias("is_amendment"), body.alias("raw_text"),
    ]


def refine(raw: DataFrame, keep_status: bool) -> DataFrame:
    """Documents from raw records (url, title_web, raw_text, summary, attrs map); the source without status also has its texts cleaned."""
    at = lambda *keys: F.coalesce(*[F.col("attrs")[k] for k in keys])
    clean = (lambda c: c) if keep_status else text.clean_missing
    body = F.col("raw_text") if keep_status else text.clean_crawled("raw_text")
    number = text._text(clean(at("Số hiệu")))
    rows = raw.filter((text.strip(text._text("raw_text")) != "") & text.is_valid_doc("title_web", number))
    columns = parsed(body, number, clean(at("Loại văn bản")), clean(F.col("title_web")), clean(at("Ngày ban hành")), clean(at("Ngày hiệu lực", "Ngày có hiệu lực")), clean(at("Cơ quan ban hành")), F.col("summary"), at("Tình trạng hiệu lực") if keep_status else None)
    return rows.select(*columns, clean(at("Lĩnh vực")).alias("legal_field"), clean(at("Người ký")).alias("signer"), "url", "summary")


def split_articles(docs: DataFrame, raw: str = "raw_text") -> DataFrame:
    """(doc_uid, doc_id, article_id, article_uid, article_number, heading, title, content, is_amendment) from docs(uid, doc_id, is_amendment, raw).

    The text is cut before every line that looks like a heading. A fold over the cuts, which holds their places and numbers only,
    keeps those that are no quotation, read as a heading and continue the numbering from 1; an article then is the text from its
    heading to the next one kept, so that what is cut off elsewhere stays as it was written. A heading
    without a name is dropped likewise if its article is short. Articles without text are left out. The name after the number is the
    column heading; title is '' as it is in the delivered data. Documents without text, number or uid give nothing.
    """
    body = F.concat(F.lit("\n"), text.nfc(F.col(raw)))  # so that something comes before the first heading
    cuts = F.split(body, rf"(?miu)^(?={HEADING})", -1)
    get = lambda s, i: F.regexp_extract(s, rf"(?iu)\A{HEADING}", i)

    # names a value for what follows, so that it is worked out once: a one-element array is transformed
    let = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)

    def describe(a: Column, i: Column) -> Column:
        """Of the cut at place i (from 1; the first is what comes before any heading)."""
        s = F.get(a, i - 1)
        back = lambda k: F.coalesce(F.right(F.get(a, i - 1 - k), F.lit(10)), F.lit(""))
        before = F.right(F.concat(back(3), back(2), back(1)), F.lit(10))
        whole, number = get(s, 0), get(s, 1)
        tail, following = text.strip(get(s, 2)), text.strip(F.substring(s, F.char_length(whole) + 1, F.lit(200)))
        fits = F.when(tail == "", ~following.rlike(CONNECTIVES)).otherwise(~tail.contains("."))
        return F.struct(
            i.alias("i"), number.alias("number"), F.when(number.rlike(r"\A[0-9]+[a-z]?\z"), F.regexp_extract(number, r"\A([0-9]+)", 1).try_cast("int")).alias("n"), tail.alias("tail"),
            F.char_length(whole).alias("skip"), (fits & ~before.contains("“") & ~before.contains('"')).alias("valid"),
        )

    kept = "array<struct<i:int,number:string,n:int,tail:string,skip:int,valid:boolean>>"
    step = lambda acc, x: F.when(F.coalesce(x["valid"] & (x["n"] == F.size(acc) + 1), F.lit(False)), F.concat(acc, F.array(x))).otherwise(acc)

    def numbered(a: Column) -> Column:
        parts = F.when(F.size(a) > 1, F.transform(F.sequence(F.lit(2), F.greatest(F.size(a), F.lit(2))), lambda i: describe(a, i))).otherwise(F.array().cast(kept))
        return F.aggregate(parts, F.array().cast(kept), step)

    def bodies(a: Column, k: Column) -> Column:
        upto = lambda n: F.coalesce(F.get(k, n + 1)["i"], F.size(a) + 1)
        of = lambda x, n: F.array_join(F.slice(a, x["i"], upto(n) - x["i"]), "")
        return F.transform(k, lambda x, n: F.struct(*[x[c].alias(c) for c in ("i", "number", "tail", "skip")], F.substring(of(x, n), x["skip"] + 1, F.lit(2147483647)).alias("body")))

    words = lambda x: F.size(F.regexp_extract_all(text.clean_crawled(x["body"]), F.lit(rf"[{text.WORD}]+"), F.lit(0)))
    long = lambda b: F.filter(b, lambda x, n: (n == 0) | (x["tail"] != "") | (words(x) >= LEAST_WORDS))
    found = let(cuts, lambda a: let(let(let(numbered(a), lambda k: bodies(a, k)), long), lambda k: bodies(a, k)))
    rows = docs.filter((text._text("uid") != "") & (text._text("doc_id") != "") & (text.strip(text._text(raw)) != "")).select(F.col("uid").alias("doc_uid"), "doc_id", "is_amendment", F.explode(found).alias("a"))
    content = text.strip(text.clean_crawled("a.body"))
    return rows.select(
        "doc_uid", "doc_id", F.concat_ws("/", "a.number", "doc_id").alias("article_id"), F.concat(F.lit("dieu-"), F.lower("a.number"), F.lit("-"), "doc_uid").alias("article_uid"),
        F.col("a.number").alias("article_number"), F.col("a.tail").alias("heading"), F.lit("").alias("title"), content.alias("content"), "is_amendment",
    ).filter("content <> ''")
