"""Dates in the formats of the sources. Invalid calendar dates give null or fall through to the next format, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PLACEHOLDERS, SPACE, _text, match_form, strip

DMY = r"([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})"
YMD = r"([0-9]{4})[/-]([0-9]{1,2})[/-]([0-9]{1,2})"
WORDED = rf"ngày[{SPACE}]+([0-9]{{1,2}})[{SPACE}]+tháng[{SPACE}]+([0-9]{{1,2}})[{SPACE}]+năm[{SPACE}]+([0-9]{{4}})"


def _date(t: Column, pattern: str, y: int, m: int, d: int) -> Column:
    part = [F.regexp_extract(t, pattern, i) for i in (y, m, d)]
    return F.when(part[0] != "", F.try_to_date(F.concat_ws("-", part[0], F.lpad(part[1], 2, "0"), F.lpad(part[2], 2, "0")), "yyyy-MM-dd"))


def vn_date(c) -> Column:
    """day/month/year, else year/month/day, else in words; the first that is a real date."""
    t = F.lower(strip(_text(c)))
    return F.when(~t.isin(*PLACEHOLDERS), F.coalesce(_date(t, DMY, 3, 2, 1), _date(t, YMD, 1, 2, 3), _date(t, WORDED, 3, 2, 1)))


def effective_date(issue_date: Column, *texts, worded: bool = False) -> Column:
    """The date from which the first text that tells it says the document is in force; "from promulgation" means issue_date.

    As observed, a date in words isn't read: what follows the word for day is looked at, and a worded date without it is none. With worded=True it is.
    """
    lead = rf"(?:có[{SPACE}]+)?hiệu[{SPACE}]+lực(?:[{SPACE}]+thi[{SPACE}]+hành)?[{SPACE}]+(?:kể[{SPACE}]+)?từ[{SPACE}]+"
    out = []
    for x in texts:
        t = F.lower(_text(x))
        out.append(_date(t, rf"{lead}ngày[{SPACE}]+{DMY}", 3, 2, 1))
        if worded:
            out.append(_date(t, rf"{lead}{WORDED}", 3, 2, 1))
        out.append(F.when(t.rlike(rf"{lead}(?:ngày[{SPACE}]+)?ban[{SPACE}]+hành"), issue_date))
    return F.coalesce(*out)


def case_date(c) -> Column:
    """ISO text of a strict day/month/year with any of - – . / and spaces between."""
    t = F.regexp_replace(F.btrim(F.regexp_replace(_text(c), rf"[{SPACE}]+", ""), F.lit(".")), r"[-–.]", "/")
    return F.when(t.rlike(r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"), F.date_format(_date(t, DMY, 3, 2, 1), "yyyy-MM-dd"))


def iso_date(c) -> Column:
    """An ISO date, else null."""
    t = _text(c)
    return F.when(t.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.try_to_date(t, "yyyy-MM-dd"))


def answer_date(c) -> Column:
    """DD/MM/YYYY of an answer, unchecked, else the answer in match form."""
    t = match_form(c)
    dmy = [F.regexp_extract(t, DMY, i) for i in (1, 2, 3)]
    ymd = [F.regexp_extract(t, YMD, i) for i in (3, 2, 1)]
    out = lambda p: F.concat(F.lpad(p[0], 2, "0"), F.lit("/"), F.lpad(p[1], 2, "0"), F.lit("/"), p[2])
    return F.when(dmy[0] != "", out(dmy)).when(ymd[2] != "", out(ymd)).otherwise(t)
