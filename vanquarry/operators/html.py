"""Extraction from stored pages (H1-H17): structure by an Arrow function with the standard parser, everything after it as columns."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from vanquarry.functions import text

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
LINK = StructType([StructField(n, StringType()) for n in ("href", "label", "title")])
# Words of titles that are no official ones, and markers of links.
UNOFFICIAL = ("dự thảo", "dự kiến", "góp ý", "sửa đổi", "bổ sung", "quy định về", "về việc")
DOWNLOADS = ("pdf", "doc", "word", "tai-file", "tải")
# Labels of the overview that are no attributes.
EXCLUDED = ("Tình trạng hiệu lực", "Áp dụng")


class Node:
    def __init__(self, tag: str, attrs: dict, parent=None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def strings(self):
        for c in self.children:
            if isinstance(c, str):
                if c.strip():
                    yield c.strip()
            elif c.tag not in ("script", "style"):
                yield from c.strings()

    def text(self, sep: str = " ") -> str:
        return sep.join(self.strings())

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def first(self, test):
        return next((n for n in self.walk() if test(n)), None)


class Tree(HTMLParser):
    """A tolerant tree: an end tag closes the nearest open element of its name, and cells, rows, items and paragraphs close those before them."""

    CLOSES = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "li": {"li"}, "p": {"p"}, "option": {"option"}}

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {})
        self.feed(page or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in self.CLOSES:
            n = self.at
            while n.parent is not None and n.tag not in ("table", "ul", "ol", "div"):
                if n.tag in self.CLOSES[tag]:
                    self.at = n.parent
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _box(root: Node, id_: str | None) -> Node:
    return (root.first(lambda n: n.attrs.get("id") == id_) if id_ else None) or root


def _rows(table: Node):
    for tr in (n for n in table.walk() if n.tag == "tr"):
        yield [c for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")]


def table_fields(page: str | None, classes: tuple[str, ...] = (), within: str | None = None, pairs: bool = False, anchors: tuple[str, ...] = (), prefer_anchor: bool = False, without: tuple[str, ...] = ()) -> dict[str, str]:
    """H1-H3: label (but those in `without`, as EXCLUDED for the overview) to value of the first table (of the first class found, else any), one pair per row or several; for some labels the anchors joined."""
    root = _box(Tree(page).root, within)
    tables = [n for n in root.walk() if n.tag == "table"]
    table = next((t for c in classes for t in tables if c in t.classes()), tables[0] if tables else None)
    out: dict[str, str] = {}
    for cells in _rows(table) if table else ():
        for i in range(0, len(cells) - 1, 2) if pairs else [0] * (len(cells) >= 2):
            label = " ".join(cells[i].text().replace(":", "").split())
            links = [a.text() for a in cells[i + 1].walk() if a.tag == "a" and a.text()]
            value = ", ".join(links) if links and label in anchors else links[0] if links and prefer_anchor else cells[i + 1].text()
            if label and label not in without and value.strip():
                out[label] = " ".join(value.split())
    return out


def fields(page: str, **options) -> Column:
    """H1-H3 as a column: map<string,string>."""

    @F.pandas_udf(MapType(StringType(), StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda p: table_fields(p, **options), na_action="ignore")

    return run(page)


def _anchors(node: Node) -> list[dict]:
    return [{"href": a.attrs["href"], "label": a.text(), "title": a.attrs.get("title", "")} for a in node.walk() if a.tag == "a" and a.attrs.get("href")]


def links(page: str | Column, within: str | None = None) -> Column:
    """All anchors with an address, of the page or of the element with the id `within` if there is one: href, label and title."""

    @F.pandas_udf(ArrayType(LINK))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda p: _anchors(_box(Tree(p).root, within)), na_action="ignore")

    return run(page)


@F.pandas_udf(ArrayType(LINK))
def result_links(s: pd.Series) -> pd.Series:
    """H8: the links of a page of search results: the first anchor of each entry's title, or, if none leads to a case, the anchors in the headings of document items."""

    def one(page):
        root = Tree(page).root
        entries = [n for n in root.walk() if n.tag == "h3" and "entry-title" in n.classes()]
        found = [x[0] for n in entries if (x := _anchors(n))]
        if not any("/ban-an/" in x["href"] for x in found):
            items = [n for n in root.walk() if n.tag == "div" and "doc-item" in n.classes()]
            found = [x for n in items for h in n.walk() if h.tag == "h3" for x in _anchors(h)]
        return found

    return s.map(one, na_action="ignore")


def summary(page: str | Column) -> Column:
    """H4: the summary element, else the body after a heading for it, else the description in the head; as a clean label."""
    return text.clean_label(_summary(page))


@F.pandas_udf(StringType())
def _summary(s: pd.Series) -> pd.Series:
    def one(page):
        root = Tree(page).root
        box = _box(root, "tomtat")
        found = box.first(lambda n: "doc-summary" in n.classes())
        if not found:
            nodes = list(box.walk())
            at = next((i for i, n in enumerate(nodes) if n.tag in ("h2", "h3", "div") and "tóm tắt" in n.text().lower()), None)
            found = at is not None and next((n for n in nodes[at + 1 :] if n.tag == "div" and {"document-body", "doc-summary"} & set(n.classes())), None)
        if found:
            return found.text("\n")
        meta = root.first(lambda n: n.tag == "meta" and n.attrs.get("name") == "description")
        return meta.attrs.get("content") if meta else None

    return s.map(one, na_action="ignore")


@F.pandas_udf(StringType())
def heading(s: pd.Series) -> pd.Series:
    """The text of the first h1."""
    return s.map(lambda p: (lambda n: n.text() if n else None)(Tree(p).root.first(lambda n: n.tag == "h1")), na_action="ignore")


@F.pandas_udf(StringType())
def canonical_url(s: pd.Series) -> pd.Series:
    """The address that the page calls its own."""
    return s.map(lambda p: (lambda n: n.attrs.get("href") if n else None)(Tree(p).root.first(lambda n: n.tag == "link" and n.attrs.get("rel") == "canonical")), na_action="ignore")


def element_text(page: str, element_id: str) -> Column:
    """The text of the element with an id, its strings on lines of their own."""

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda p: (lambda n: n.text("\n") if n else None)(Tree(p).root.first(lambda n: n.attrs.get("id") == element_id)), na_action="ignore")

    return run(page)


def full_url(href: Column, base: str) -> Column:
    """An absolute address; null for null, '' and page-internal ones."""
    h = text.strip(text._text(href))
    return F.when(h.rlike("(?i)^https?://"), h).when(h.startswith("//"), F.concat(F.lit("https:"), h)).when(h.startswith("/"), F.concat(F.lit(base), h)).when(h != "", F.concat(F.lit(base + "/"), h))


def distinct_by(a: Column, key) -> Column:
    """The elements of an array whose key hasn't come before."""
    return F.filter(a, lambda x, i: F.array_position(F.transform(a, key), key(x)) == i + 1)


def downloads(found: Column, base: str) -> Column:
    """H5: links to files as struct(file_type, label, title, url), the first of each address."""

    def one(x: Column) -> Column:
        url = full_url(x["href"], base)
        label, title = text.spaces(x["label"]), text.spaces(x["title"])
        mark = F.lower(F.concat_ws(" ", label, title, url))
        kind = F.when(mark.contains("pdf"), "pdf").when(mark.contains("doc") | mark.contains("word"), "doc").otherwise("unknown")
        is_file = mark.contains(DOWNLOADS[0]) | mark.contains(DOWNLOADS[1]) | mark.contains(DOWNLOADS[2]) | mark.contains(DOWNLOADS[3]) | mark.contains(DOWNLOADS[4])
        return F.when(url.isNotNull() & is_file, F.struct(kind.alias("file_type"), label.alias("label"), title.alias("title"), url.alias("url")))

    return distinct_by(F.array_compact(F.transform(found, one)), lambda x: x["url"])


def body_text(doc: Column, pdf: Column, page: Column, least: int = 200) -> Column:
    """H6: struct(text, format): the word file if it has text, else the PDF, else the page, if long enough; null if none is."""
    pick = lambda c, cond, name: F.when(cond, F.struct(c.alias("text"), F.lit(name).alias("format")))
    return F.coalesce(pick(doc, text.strip(text._text(doc)) != "", "doc"), pick(pdf, F.char_length(pdf) >= least, "pdf"), pick(page, F.char_length(page) >= least, "html"))


def case_text(doc: Column, pdf: Column, least: int = 1000) -> Column:
    """H7."""
    return F.coalesce(F.when(F.char_length(doc) >= least, doc), F.when(F.char_length(pdf) >= least, pdf))


def case_links(found: Column, base: str) -> Column:
    """H8: addresses of cases, once each."""
    return F.array_distinct(F.array_compact(F.transform(found, lambda x: F.when(x["href"].contains("/ban-an/"), full_url(x["href"], base)))))


def doc_links(found: Column, base: str) -> Column:
    """H9: addresses of documents, once each."""
    ok = lambda h: ~h.contains("/ban-an/") & (h.contains("-d1.html") | h.contains("-d10.html"))
    return F.array_distinct(F.array_compact(F.transform(found, lambda x: F.when(ok(x["href"]), full_url(x["href"], base)))))


def is_first_instance(level: Column) -> Column:
    """Kept unless a level is given that isn't the first."""
    return (text._text(level) == "") | level.contains("Sơ thẩm")


def is_official_title(c) -> Column:
    """A type and a number, and no words of description."""
    t = text._text(c)
    bad = F.lit(False)
    for w in UNOFFICIAL:
        bad |= F.lower(t).contains(w)
    parts = F.split(text.spaces(t), " ")
    rest = F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ")
    return ~bad & F.size(parts).isin(2, 3) & rest.rlike(r"[0-9/\-]")


def page_key(href: Column, base: str) -> Column:
    """An address in one form, for telling which were seen."""
    h = F.regexp_replace(F.lower(text.strip(text._text(href))), "/+$", "")
    return F.when(h.startswith("http"), h).when(h.startswith("/"), F.concat(F.lit(base), h)).when(h != "", F.concat(F.lit(base + "/"), h))


def listed(found: Column, base: str) -> Column:
    """Of a page's links array<struct(href, label, ...)>, those with an official title, once per address, as struct(url, title)."""
    rows = F.transform(F.filter(found, lambda x: is_official_title(x["label"])), lambda x: F.struct(page_key(x["href"], base).alias("url"), x["label"].alias("title")))
    return distinct_by(F.filter(rows, lambda x: x["url"].isNotNull()), lambda x: x["url"])


def is_kept(number: Column, title: Column) -> Column:
    """A record is kept if its page told a number, or its title holds one."""
    return (text._text(number) != "") | text._text(title).contains("/")


def is_challenge(page: Column) -> Column:
    """A page that only asks whether a person is there."""
    return page.rlike(r"(?i)just a moment|cf-challenge|captcha")
