"""Identifiers of cases and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, _text, slug, strip

# Words that a court's short name leaves out.
COURT_WORDS = ("Tòa án nhân dân", "Tòa án", "tỉnh", "thành phố", "TP", "Quận", "Huyện", "Thị xã")


def court_acronym(c) -> Column:
    """T13: 'TAND' and the initials; numbers, words in capitals and KV are kept whole."""
    t = F.regexp_replace(_text(c), rf"(?iu)khu[{SPACE}]*vực", "KV")
    t = strip(F.regexp_replace(t, "(?iu)" + "|".join(COURT_WORDS), ""))
    whole = lambda w: w.rlike(r"\p{L}") & (w == F.upper(w)) | w.rlike(r"\A[0-9]+\z")
    parts = F.transform(F.split(t, rf"[{SPACE}]+"), lambda w: F.when(whole(w), w).otherwise(F.upper(F.left(w, F.lit(1)))))
    short = F.regexp_replace(F.concat(F.lit("TAND"), F.array_join(parts, "")), r"[^A-Z0-9]", "")
    return F.when(F.char_length(_text(c)) < 5, "TAND").otherwise(F.replace(short, F.lit("KVKV"), F.lit("KV")))


def case_uid(case_no: Column, court: Column, date: Column) -> Column:
    """Number-court-date; a missing number leaves an N, a missing date eight zeros."""
    number = F.regexp_replace(F.coalesce(case_no, F.lit("None")), r"[^A-Z0-9]", "")
    day = F.when(_text(date) == "", "00000000").otherwise(F.replace(date, F.lit("-"), F.lit("")))
    return F.concat_ws("-", number, court_acronym(court), day)


def doc_uid(doc_type: Column, doc_id: Column, title: Column, issue_date: Column) -> Column:
    """Type, number, title and date as slugs; parts that come out empty are left out."""
    parts = [slug(x) for x in (doc_type, doc_id, title, F.coalesce(issue_date.cast("string"), F.lit("unknown")))]
    return F.concat_ws("-", *[F.nullif(p, F.lit("")) for p in parts])
