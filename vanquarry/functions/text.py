"""Text scalars as Column -> Column functions; everything but Unicode normalisation runs inside the JVM.

White space means Unicode white space throughout, and \\w letters, digits and the underscore of any script. Null gives null unless
a function says otherwise.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Inside a class, white space as Unicode has it; valid for java.util.regex and RE2.
SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
#: Line ends that end a line for `lines`.
LINE = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
# Texts that stand for a missing value.
PLACEHOLDERS = ("đã biết", "đang cập nhật", "chưa rõ")
FIELD_PLACEHOLDERS = ("đang cập nhật", "không xác định", "none")
DRAFT_WORDS = ("dự thảo", "dự kiến", "góp ý")
NOISE_LINES = ("đang theo dõi", "bổ sung")
NOISE_MARKUP = ("data-href=", "docitem-view-change-content")
GENERIC_TITLES = ("LUẬT", "BỘ LUẬT", "NGHỊ ĐỊNH", "NGHỊ QUYẾT", "THÔNG TƯ", "QUYẾT ĐỊNH", "HIẾN PHÁP", "LỆNH", "SẮC LỆNH")
STOP_KEYWORDS = ("luật", "bộ luật", "nghị định", "nghị quyết", "hiến pháp", "năm")
#: In this order: the first that occurs in the text decides.
TYPE_ALIASES = (("bộ luật", "Bộ luật"), ("luật sửa đổi", "Luật"), ("luật", "Luật"), ("nghị định", "Nghị định"), ("nghị quyết", "Nghị quyết"), ("hiến pháp", "Hiến pháp"))
REASONING_MARKERS = ("NHẬN ĐỊNH CỦA TÒA", "NHẬN XÉT CỦA TÒA", "XÉT THẤY:", "Căn cứ vào tài liệu, chứng cứ đã được xem xét", "Hội đồng xét xử nhận định")
ISSUE_LABELS = (
    "Hôn nhân và Gia đình", "Giao thông và Vận tải", "Thuế, Phí và Lệ phí", "Đất đai và Nhà ở", "Lao động và Bảo hiểm xã hội", "Kinh doanh, đầu tư, thương mại",
    "Tài chính, vay nợ, tín dụng", "Sở hữu trí tuệ", "Môi trường và Tài nguyên", "Trật tự, An toàn xã hội và Ma túy", "Xâm phạm tính mạng, sức khỏe, danh dự, nhân phẩm",
    "Xâm phạm sở hữu tài sản", "Hành chính và Quản lý nhà nước", "Tư pháp, Tố tụng và Thi hành án", "Dân sự, Hợp đồng và Nghĩa vụ",
)
OTHER_LABEL = "Các vấn đề pháp lý khác"


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; Spark has no function for it."""
    return s.map(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(StringType())
def ascii_letters(s: pd.Series) -> pd.Series:
    """Compatibility decomposition with everything but ASCII dropped."""
    return s.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), na_action="ignore")


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _sub(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, pattern, by)


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return _sub(c, rf"\A[{SPACE}]+|[{SPACE}]+\z")


def spaces(c) -> Column:
    """Runs of white space become one space, none at the ends; null gives ''."""
    return F.trim(_sub(_text(c), rf"[{SPACE}]+", " "))


def match_form(c) -> Column:
    """Composed, spaced as by `spaces`, without quotes and light punctuation at the ends; case kept; null gives ''."""
    return F.btrim(spaces(nfc(_text(c))), F.lit(" \"'`.,;:"))


def loose_form(c) -> Column:
    """match_form in lower case, everything but letters, digits, '/' and '-' as spaces."""
    return spaces(_sub(F.lower(match_form(c)), r"[^0-9a-zA-ZÀ-ỹ/\- ]+", " "))


def article_form(c) -> Column:
    """Text of an article without list markers and punctuation; case kept."""
    t = _sub(nfc(_text(c)), r"[\r\n\t]+", " ")
    t = _sub(t, rf"(?<![{WORD}])([0-9]+|[a-zA-Zà-ỹđĐ])[{SPACE}]*[.)\-][{SPACE}]+", " ")
    return spaces(_sub(t, rf"[^0-9a-zA-ZÀ-ỹ{SPACE}]", " "))


def slug(c) -> Column:
    """T1: 'unknown' for null and ''; signs other than '-' are dropped, not replaced."""
    t = ascii_letters(F.translate(_text(c), "đĐ", "dD"))
    t = _sub(F.lower(strip(_sub(t, r"[^A-Za-z0-9_\s-]", ""))), r"[-\s]+", "-")
    return F.when(_text(c) == "", "unknown").otherwise(t)


def crawl_slug(c) -> Column:
    """The slug of crawl files, with '_'; a đ is lost; 'empty' for null and ''."""
    t = _sub(F.lower(strip(_sub(ascii_letters(_text(c)), r"[^A-Za-z0-9_\s-]", ""))), r"[-\s]+", "_")
    return F.when(_text(c) == "", "empty").otherwise(t)


def lines(c: Column) -> Column:
    """The lines of a text; a line end at the very end begins no further line."""
    a = F.split(c, LINE, -1)
    return F.when(F.element_at(a, -1) == "", F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a)


def clean_crawled(c) -> Column:
    """Without invisible characters, interface lines and lines of markup; null gives ''."""
    t = _sub(_text(c), r"[\x{200b}\x{200c}\x{200d}\x{feff}\x{ad}]")
    keep = F.filter(lines(t), lambda x: ~(F.lower(strip(x)).isin(*NOISE_LINES) | x.contains(NOISE_MARKUP[0]) | x.contains(NOISE_MARKUP[1])))
    return F.array_join(keep, "\n")


def clean_missing(c) -> Column:
    """T4: spaced text; placeholders and '' become null."""
    t = spaces(c)
    return F.when((t != "") & ~F.lower(t).isin(*PLACEHOLDERS), t)


def clean_label(c) -> Column:
    """Spaced text; the first two placeholders and '' become null."""
    t = spaces(c)
    return F.when((t != "") & ~F.lower(t).isin(*PLACEHOLDERS[:2]), t)


def is_valid_doc(title, doc_id) -> Column:
    """T5: not a draft, and with a real number."""
    t, n = F.lower(_text(title)), _text(doc_id)
    draft = t.contains(DRAFT_WORDS[0]) | t.contains(DRAFT_WORDS[1]) | t.contains(DRAFT_WORDS[2])
    return ~draft & (F.char_length(n) >= 3) & ~F.lower(n).isin(*PLACEHOLDERS[1:])


def is_caps_line(c) -> Column:
    """At least four fifths of the letters are capitals."""
    letters = F.char_length(_sub(_text(c), r"\P{L}"))
    return (letters > 0) & (F.char_length(_sub(_text(c), r"\P{Lu}")) * 5 >= letters * 4)


def legal_plain(c) -> Column:
    """Without list markers at line starts, line ends and punctuation."""
    t = _sub(_text(c), rf"(?im)^[{SPACE}]*([0-9]+|[a-z]+|[ivxldm]+)[.)][{SPACE}]*", " ")
    t = _sub(t, rf"(?m)^[{SPACE}]*-[{SPACE}]*", " ")
    return spaces(_sub(F.replace(t, F.lit("\n"), F.lit(" ")), rf"[^{WORD}{SPACE}]"))


def article_int(c) -> Column:
    """Leading digits of an article number."""
    return F.regexp_extract(strip(_text(c)), r"\A([0-9]+)", 1).try_cast("bigint")


def article_value(c) -> Column:
    """(number, suffix in lower case) of a number with an optional suffix, else null."""
    t = strip(_text(c))
    return F.when(t.rlike(r"\A[0-9]+[a-zA-Z]*\z"), F.struct(F.regexp_extract(t, r"\A([0-9]+)", 1).try_cast("bigint").alias("number"), F.lower(F.regexp_extract(t, r"([a-zA-Z]*)\z", 1)).alias("suffix")))


def doc_type(c) -> Column:
    """The type that the text names, by ordered aliases."""
    t, out = F.lower(strip(_text(c))), F.lit(None).cast("string")
    for alias, name in reversed(TYPE_ALIASES):
        out = F.when(t.contains(alias), name).otherwise(out)
    return out


def doc_number(c) -> Column:
    """Capital letters and digits of a document number, Đ as D; null for null and ''."""
    t = _sub(F.translate(F.upper(_text(c)), "Đ", "D"), r"[^A-Z0-9]")
    return F.when(_text(c) != "", t)


def doc_numbers(*texts) -> Column:
    """The distinct document numbers in the texts, in order, as by doc_number."""
    found = [F.regexp_extract_all(_text(t), F.lit(rf"(?i)(?<![{WORD}])[0-9]{{1,4}}/[0-9]{{4}}/[A-ZĐđ0-9/-]+(?![{WORD}])(?<=[{WORD}])"), F.lit(0)) for t in texts]
    return F.array_distinct(F.filter(F.transform(F.concat(*found), doc_number), lambda x: x != ""))


def keywords(c) -> Column:
    """Stripped keywords longer than a character and no stop words, the first of each up to case; null gives []."""
    a = F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), strip), lambda x: (F.char_length(x) > 1) & ~F.lower(x).isin(*STOP_KEYWORDS))
    return F.filter(a, lambda x, i: F.array_position(F.transform(a, F.lower), F.lower(x)) == i + 1)


def year(c) -> Column:
    """A year from 1800 to 2100, else null."""
    n = (F.col(c) if isinstance(c, str) else c).try_cast("int")
    return F.when(n.between(1800, 2100), n)


def number_patterns(c: Column) -> Column:
    """The fragments by which a document number, as by doc_number, may be stored."""
    number, at, suffix = (F.regexp_extract(c, r"\A([0-9]+)([0-9]{4})([A-Z0-9]+)\z", i) for i in (1, 2, 3))
    stem = F.concat(number, F.lit("/"), at)
    full = suffix != ""
    some = [
        c, F.when(full, stem), F.when(full, F.concat(stem, F.lit("/"), suffix)), F.when(full & suffix.startswith("NDCP"), F.concat(stem, F.lit("/NĐ-CP"))),
        F.when(full & suffix.startswith("NDCP"), F.concat(stem, F.lit("/ND-CP"))), F.when(full & suffix.startswith("QH"), F.concat(stem, F.lit("/QH"))),
    ]
    return F.when(c != "", F.array_distinct(F.array_compact(F.array(*some)))).otherwise(F.array().cast("array<string>"))


def clean_article_number(c) -> Column:
    """Without the word for article, and only what is before the first comma."""
    t = strip(F.replace(F.replace(_text(c), F.lit("Điều"), F.lit("")), F.lit("điều"), F.lit("")))
    return strip(F.split_part(t, F.lit(","), F.lit(1)))


def clean_field(c) -> Column:
    """Stripped field of law; placeholders and '' become null."""
    t = strip(_text(c))
    return F.when((t != "") & ~F.lower(t).isin(*FIELD_PLACEHOLDERS), t)


def excerpt(c, n: int = 2) -> Column:
    """The first n sentences that aren't blank, ending in a full stop; null gives ''."""
    parts = F.filter(F.transform(F.split(F.replace(_text(c), F.lit("\n"), F.lit(" ")), r"\."), strip), lambda x: x != "")
    t = F.array_join(F.slice(parts, 1, n), ". ")
    return F.when(t == "", "").otherwise(F.concat(t, F.lit(".")))


def before_reasoning(c) -> Column:
    """A case's facts up to the first marker, in order of the markers, that is found after the 200th character."""
    t = strip(_text(c))
    out = t
    for marker in reversed(REASONING_MARKERS):
        at = F.instr(t, marker)
        out = F.when(at > 201, strip(F.substring(t, F.lit(1), at - 1))).otherwise(out)
    return out


def article_label(number, doc_id) -> Column:
    """T33."""
    return F.format_string("Điều %s %s", number, doc_id)


def answer_label(number, doc_id) -> Column:
    """T33."""
    return F.format_string("Điều %s của %s", number, doc_id)


def options_block(options: Column) -> Column:
    """Lettered lines; more options than letters raise an error."""
    letters = F.array(*map(F.lit, "ABCD"))
    return F.when(F.size(options) > 4, F.raise_error(F.lit("more than four options"))).otherwise(F.array_join(F.transform(options, lambda x, i: F.concat(F.element_at(letters, i + 1), F.lit(". "), x)), "\n"))


# Default instructions of prompts; a user passes others to `prompt`.
CHOICE_NOTE = "Chỉ trả về một đáp án duy nhất, không giải thích."
RECALL_NOTES = {"task_2_1": "Chỉ trả về nguyên văn định nghĩa.", "task_2_2": "Chỉ trả về nội dung điều luật.", "task_2_3": "Chỉ trả về đúng thông tin được hỏi."}
REASONED_NOTE = 'Trả về một JSON: {"answer": "...", "explanation": "..."}'


def prompt(task_id: Column, question: Column, options: Column, choice: str = CHOICE_NOTE, recall: dict[str, str] | None = None, reasoned: str = REASONED_NOTE) -> Column:
    """The question with options and instructions, by task: reasoned choice, choice, exact recall, or the question alone."""
    has = F.coalesce(F.size(options), F.lit(0)) > 0
    block = F.when(has, F.concat(F.lit("\n\nCác phương án:\n"), options_block(options))).otherwise("")
    out = question
    for task, note in (recall or RECALL_NOTES).items():
        out = F.when(task_id == task, F.concat(question, F.lit("\n\n" + note))).otherwise(out)
    out = F.when(has, F.concat(question, block, F.lit("\n\n" + choice))).otherwise(out)
    return F.when(task_id == "task_3_1", F.concat(question, block, F.lit("\n\n" + reasoned))).otherwise(out)


def choice_index(c) -> Column:
    """0 to 3 for an answer that begins with a letter from a to d alone, else null."""
    letter = F.regexp_extract(F.lower(match_form(c)), rf"\A([abcd])(?:[.){SPACE}]|\z)", 1)
    return F.when(letter != "", F.instr(F.lit("abcd"), letter) - 1)


def json_object(c) -> Column:
    """The text from the first { to the last } if that is valid JSON, else null."""
    t = _text(c)
    found = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when((found != "") & F.try_parse_json(found).isNotNull(), found)


def model_dir(c) -> Column:
    """A model's name as a directory name."""
    return F.translate(_sub(c, r"[/\\]", "__"), ": ", "__")


def issue_label(c, labels: tuple[str, ...] = ISSUE_LABELS, other: str = OTHER_LABEL) -> Column:
    """The label meant by an answer: equal up to case, else by its number, else contained in the answer, else `other`."""
    t = F.btrim(F.btrim(strip(_text(c)), F.lit('"')), F.lit("'"))
    equal, number, inside = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, x in reversed(list(enumerate(labels, 1))):
        equal = F.when(F.lower(t) == x.lower(), x).otherwise(equal)
        number = F.when((t == str(i)) | t.startswith(f"{i}."), x).otherwise(number)
        inside = F.when(F.lower(t).contains(x.lower()), x).otherwise(inside)
    return F.coalesce(equal, number, inside, F.lit(other))


def question_type(uid) -> Column:
    """T41."""
    u, out = _text(uid), F.lit("metadata_exact")
    for part, name in (("signer", "signer_from_doc_id"), ("effective", "effective_date_from_doc_id"), ("article", "article_from_excerpt"), ("docid", "doc_id_from_excerpt")):
        out = F.when(u.contains(f"bench_2_3_{part}_"), name).otherwise(out)
    return out


def is_weak_title(c) -> Column:
    """Missing, too short, too long or only a type."""
    t = F.upper(spaces(c))
    return (F.char_length(t) < 5) | (F.char_length(t) > 350) | t.isin(*GENERIC_TITLES)


def is_rejected_case_title(c) -> Column:
    """T43."""
    t = F.lower(_text(c))
    return t.contains("án lệ") | t.contains("đính chính")


def left_part(c: Column, n: int) -> Column:
    """The first n characters, for prompts."""
    return F.left(c, F.lit(n))


def file_slug(c) -> Column:
    """The first line with everything but letters and digits as '_'."""
    return _sub(F.element_at(F.split(_text(c), r"\n"), 1), r"[^\p{L}\p{N}]", "_")


def status(c) -> Column:
    """From the words before the first digit."""
    s = strip(F.element_at(F.split(F.lower(_text(c)), r"[0-9]"), 1))
    has = lambda *xs: F.array_contains(F.array(*[s.contains(x) for x in xs]), True)
    return (
        F.when(has("hết hiệu lực một phần", "sửa đổi", "bổ sung"), "Hết hiệu lực một phần")
        .when(has("hết hiệu lực", "bị hủy bỏ", "bị bãi bỏ"), "Hết hiệu lực")
        .when(has("còn hiệu lực", "đang áp dụng"), "Còn hiệu lực")
        .otherwise("Không xác định")
    )


def issuing_body(doc_id) -> Column:
    """By the letters of the number."""
    n = F.upper(_text(doc_id))
    return (
        F.when(n.rlike(r"/QH[0-9]*\z") | n.contains("/NQ-QH"), "Quốc hội")
        .when(n.rlike(r"/(TVQH|UBTVQH)[0-9]*\z"), "Ủy ban Thường vụ Quốc hội")
        .when(n.contains("/NĐ-CP") | n.contains("/NQ-CP"), "Chính phủ")
        .when(n.contains("/QĐ-TTG") | n.contains("/CT-TTG"), "Thủ tướng Chính phủ")
        .when(n.contains("/L-CTN") | n.contains("/QĐ-CTN") | n.contains("/SL"), "Chủ tịch nước")
    )
