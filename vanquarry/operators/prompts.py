"""Prompts of the generators and of the search, one Column each. The wording is a template that a user may replace; the JSON keys asked for are those that the generators read."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vanquarry.functions import text

ISSUE = "Hãy xếp bản án sau vào đúng một nhãn.\n\nTên: {title}\nQuan hệ pháp luật: {relation}\nLoại án: {kind}\n\nCác nhãn:\n{labels}\n\nChỉ ghi tên nhãn."
CHOICE = (
    "Bản án: {title}\n\nPhần quyết định (rút gọn):\n{decision}\n\nHãy nêu vấn đề pháp lý cốt lõi theo tên bản án và ba vấn đề sai nhưng gần với quyết định, cùng kiểu câu.\n"
    'Ghi đúng một JSON: {"correct": "...", "distractors": ["...", "...", "..."]}'
)
DEFINITION = (
    "Điều {number}. {name}\n{document} (năm {year})\n\n{content}\n\nĐiều này có định nghĩa một khái niệm pháp lý hay không? Điều về phạm vi, hiệu lực hay tổ chức thực hiện thì không.\n"
    'Ghi đúng một JSON: {"co": "co", "ten_khai_niem": "...", "giai_thich": "nguyên văn định nghĩa"} hoặc {"co": "khong"}'
)
AMENDMENT = (
    "Điều khoản sửa đổi sau đây sửa điều nào của văn bản nào?\n\n{content}\n\n"
    'Ghi đúng một JSON: {"original_article_number": "...", "search_hint": "...", "title_keywords": ["..."], "doc_type": "...", "year": 2000, "doc_id": null}; không rõ thì null.'
)
REFERENCES = (
    "Liệt kê mọi văn bản và điều luật được viện dẫn trong căn cứ sau, trừ nghị quyết về án phí.\n\n{bases}\n\n"
    'Ghi đúng một JSON: {"refs": [{"title_keywords": ["..."], "doc_type": "Luật", "year": 2000, "doc_id": null, "article_numbers": ["1"]}]}; không rõ thì null.'
)
DECISION = (
    "Quyết định của Tòa án:\n{decision}\n\n{block}\n\nHãy tóm tắt phán quyết chính và ba phán quyết sai cùng loại, cùng độ dài; bỏ qua án phí và quyền kháng cáo.\n"
    'Ghi đúng một JSON: {"correct": "...", "distractors": ["...", "...", "..."]}'
)
SEARCH = (
    "Đoạn sau nói đến văn bản pháp luật nào?\n\n{hint}\n\n"
    'Ghi đúng một JSON: {"title_keywords": ["..."], "doc_type": "Luật", "year": 2000, "doc_id": null}; không rõ thì null.'
)
CANDIDATES = 'Chọn đúng một văn bản trong danh sách, hoặc null nếu không có.\n\nĐiều cần tìm: {numbers}\nCăn cứ:\n{hint}\n\nDanh sách:\n{lines}\n\nGhi đúng một JSON: {"uid": "..."} hoặc {"uid": null}'


def fill(template: str, **values: Column) -> Column:
    """The template with {name} replaced by the values; null counts as ''."""
    parts = re.split(r"\{(" + "|".join(values) + r")\}", template)
    return F.concat(*[F.lit(x) if i % 2 == 0 else F.coalesce(values[x].cast("string"), F.lit("")) for i, x in enumerate(parts)])


def _cut(c: str | Column, n: int) -> Column:
    return text.left_part(text._text(c), n)


def numbered_labels(labels: tuple[str, ...] = text.ISSUE_LABELS) -> Column:
    return F.lit("\n".join(f"{i}. {x}" for i, x in enumerate(labels, 1)))


def issue(title: Column, relation: Column, kind: Column, template: str = ISSUE) -> Column:
    return fill(template, title=title, relation=relation, kind=kind, labels=numbered_labels())


def choice(title: Column, decision: Column, template: str = CHOICE) -> Column:
    return fill(template, title=title, decision=_cut(decision, 1500))


def definition(number: Column, name: Column, document: Column, year: Column, content: Column, template: str = DEFINITION) -> Column:
    return fill(template, number=number, name=name, document=document, year=year, content=_cut(content, 2000))


def amendment(content: Column, template: str = AMENDMENT) -> Column:
    return fill(template, content=_cut(content, 2000))


def references(bases: Column, template: str = REFERENCES) -> Column:
    return fill(template, bases=_cut(bases, 2000))


def decision(decision_: Column, block: Column, template: str = DECISION) -> Column:
    return fill(template, decision=text.strip(text._text(decision_)), block=block)


def search(hint: Column, template: str = SEARCH) -> Column:
    """For a hint from which no keyword, type, year or number is known."""
    return fill(template, hint=_cut(hint, 1500))


def candidates(lines: Column, hint: Column, numbers: Column, template: str = CANDIDATES) -> Column:
    """Asks for one of the ranked candidates."""
    return fill(template, lines=F.array_join(lines, "\n"), hint=_cut(hint, 1200), numbers=F.array_join(numbers, ", "))
