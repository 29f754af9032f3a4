"""Court cases: metadata and sections from the text (P4-P7, P11), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanquarry.functions import dates, ids, text

S = rf"[{text.SPACE}]"
END = rf"(?![{text.WORD}])"
# Patterns of the headings of a judgment, with the spellings that occur.
HEADINGS = {
    "content": rf"N[ỘÔO]{S}*I{S}*DUNG{S}+V{S}*[ỤU]{S}*[ÁA]{S}*N",
    "reasoning": rf"(?:NH[ẬẠÂA]{S}*N{S}*[ĐD]{S}*[ỊI]{S}*NH{S}+C[ỦU]A{S}+(?:HỘI{S}+ĐỒNG{S}+XÉT{S}+XỬ|T[ÒO]A{S}*[ÁA]N|TO[ÀA]N?{S}*[ÁA]N)|NH[ẬẠÂA]{S}*N{S}+TH[ẤA]{S}*Y)",
    "decision": rf"QUY[ẾÊE]{S}*T{S}*[ĐD]{S}*[ỊI]{S}*NH",
}
PARTIES = rf"(?iu)(?<![{text.WORD}])(?:Nguy[êe]n{S}*đơn|B[ịi]{S}*đơn|Người{S}+có{S}+quyền|Tại{S}+đơn|Theo{S}+đơn){END}"
NUMBER = rf"(?iu)(?:Bản{S}+án{S}+số|Số){S}*[:\s]*([0-9]+/[0-9]{{4}}/[A-ZĐ\-\s]+ST|PT|GĐT|TT)"
DAY = rf"(?iu)Ngày{S}*[:\s]*([0-9{text.SPACE}/\-–.]+)(?:{S}|\z)"
MATTER = rf'(?isu)(?:Về{S}+việc|V/v){S}*[:"]?{S}*(.+?)(?=\n\n|\n{S}*(?:NỘI{S}+DUNG|NHẬN{S}+ĐỊNH|QUYẾT{S}+ĐỊNH|NHÂN{S}+DANH|HỘI{S}+ĐỒNG|VỚI{S}+THÀNH|C[ỘÔO]NG{S}+H[ÒO]A|ĐỘC{S}+LẬP)|\z)'


def case_number(c: Column) -> Column:
    """The number in the first 1,000 characters; only numbers of first instance match in full, see the README."""
    return F.nullif(text.strip(F.regexp_extract(F.left(c, F.lit(1000)), NUMBER, 1)), F.lit(""))


def case_day(c: Column) -> Column:
    """ISO text of the date; a date that is found but can't be read keeps the worded form from being tried."""
    head = F.left(c, F.lit(1000))
    worded = [F.regexp_extract(head, rf"(?iu)ngày{S}+([0-9]+){S}+tháng{S}+([0-9]+){S}+năm{S}+([0-9]+)", i) for i in (3, 2, 1)]
    return F.when(head.rlike(DAY), dates.case_date(text.strip(F.regexp_extract(head, DAY, 1)))).when(worded[0] != "", F.concat_ws("-", worded[0], F.lpad(worded[1], 2, "0"), F.lpad(worded[2], 2, "0")))


def case_title(c: Column) -> Column:
    """What the case is about, on one line."""
    t = F.regexp_extract(F.left(c, F.lit(1000)), MATTER, 1)
    return F.nullif(text.spaces(F.btrim(text.strip(t), F.lit('"“”'))), F.lit(""))


def case_court(c: Column) -> Column:
    """Always null, as no pattern for it matches real texts; the court comes from the web record."""
    return F.lit(None).cast("string")


def sections(c: Column) -> Column:
    """P5: struct of introduction, content, reasoning, decision.

    Of each heading the last occurrence counts; a section goes up to the next heading in the text. Without a heading for the
    content, but with one for the reasoning, a long introduction is divided at the first line that names a party.
    """
    at = {k: F.char_length(F.regexp_extract(c, rf"(?msiu)\A(.*)^{S}*{h}{S}*:?{S}*$", 1)) for k, h in HEADINGS.items()}
    has = {k: c.rlike(rf"(?miu)^{S}*{h}{S}*:?{S}*$") for k, h in HEADINGS.items()}
    start = {k: F.when(has[k], at[k]) for k in HEADINGS}
    n = F.char_length(c)
    first = F.least(*start.values())

    def part(k: str) -> Column:
        later = F.least(*[F.when(start[o] > start[k], start[o]) for o in HEADINGS if o != k])
        span = F.substring(c, start[k] + 1, F.coalesce(later, n) - start[k])
        return F.when(has[k], text.strip(F.regexp_replace(span, rf"(?iu)\A{S}*{HEADINGS[k]}{S}*:?[{text.SPACE}&&[^\n]]*", ""))).otherwise("")

    intro = F.when(first.isNull(), c).otherwise(text.strip(F.substring(c, F.lit(1), first)))
    content, reasoning, decision = (part(k) for k in HEADINGS)
    move = (content == "") & (reasoning != "") & (F.char_length(intro) > 500) & (start["reasoning"] > 0)
    rows = text.lines(intro)
    party = F.coalesce(F.array_position(F.transform(rows, lambda x: x.rlike(PARTIES)), True), F.lit(0))
    line = F.greatest(party - 1, F.lit(0)).cast("int")
    return F.struct(
        F.when(move, text.strip(F.array_join(F.slice(rows, F.lit(1), line), "\n"))).otherwise(intro).alias("introduction"),
        F.when(move, text.strip(F.array_join(F.slice(rows, line + 1, F.greatest(F.size(rows), F.lit(1))), "\n"))).otherwise(content).alias("content"),
        reasoning.alias("reasoning"),
        decision.alias("decision"),
    )


def legal_bases(c: Column) -> Column:
    """What a decision says before the word of judgment, without its heading; '' where there is no such word."""
    anchor = rf"(?isu)\A(.*?)(?<![{text.WORD}])(?:X[ửư]{S}*|Tuy[êe]n{S}*x[ửư])(?<=[{text.WORD}]|[{text.SPACE}])(?:{S}*:)?"
    return text.strip(F.regexp_replace(text.strip(F.regexp_extract(c, anchor, 1)), rf"(?iu)\AQUY[ẾÊE]T{S}+Đ[ỊI]NH{S}*:?{S}*", ""))


def refine(raw: DataFrame) -> DataFrame:
    """Cases from raw records (url, raw_text, metadata map): the parsed value, else that of the web record; rejected titles and empty texts left out."""
    web = lambda *k: F.coalesce(*[F.col("metadata")[x] for x in k])
    rows = raw.filter(text._text("raw_text") != "").withColumns({
        "day": case_day(F.col("raw_text")), "no": F.coalesce(case_number(F.col("raw_text")), web("Số hiệu")), "court": F.coalesce(case_court(F.col("raw_text")), web("Tòa án xét xử")),
        "title_parsed": F.coalesce(case_title(F.col("raw_text")), F.lit("")), "s": sections(F.col("raw_text")),
    }).filter(~text.is_rejected_case_title("title_parsed"))
    return rows.select(
        ids.case_uid(F.col("no"), F.col("court"), F.col("day")).alias("uid"), "url", F.col("no").alias("case_number"), F.col("court").alias("court_name"),
        F.coalesce("day", dates.case_date(web("Ngày ban hành"))).alias("issuance_date"), web("Tên Bản án").alias("title_web"), "title_parsed", web("Quan hệ pháp luật").alias("legal_relation"),
        web("Cấp xét xử").alias("court_level"), web("Lĩnh vực").alias("case_type"), web("Thông tin về vụ/việc").alias("case_info"), legal_bases(F.col("s.decision")).alias("legal_bases"),
        web("docx_url", "pdf_url").alias("source_doc_url"), web("summary").alias("summary"), "raw_text", F.col("s.introduction").alias("section_introduction"),
        F.col("s.content").alias("section_content"), F.col("s.reasoning").alias("section_reasoning"), F.col("s.decision").alias("section_decision"),
    )
