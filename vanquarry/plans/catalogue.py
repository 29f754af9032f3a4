"""Named queries over the test tables, each (spark, sf_dir) -> DataFrame, with the same in SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanquarry.functions import dates, ids, metrics, text
from vanquarry.operators import cases, documents, generators, html, scoring
from vanquarry.operators import relational as rel
from vanquarry.sources import files
from vanquarry.sources.tables import read

_Q: dict = {}
_SQL: dict[str, str] = {}
# Fragments of the SQL: white space and word characters as in functions/text.py.
S = text.SPACE.replace("\\", "\\")
WS = f"[{S}]"
STRIP = lambda x: f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"
SPACES = lambda x: f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"
MATCH = lambda x: f"""trim({SPACES(f"nfc_normalize({x})")}, ' "''`.,;:')"""
LOOSE = lambda x: SPACES(f"regexp_replace(lower({MATCH(x)}), '[^0-9a-zA-ZÀ-ỹ/\\- ]+', ' ', 'g')")
ONE_DOC = "(SELECT uid, any_value(doc_id) doc_id, any_value(title) title, any_value(doc_type) doc_type, any_value(issuing_body) issuing_body, any_value(legal_field) legal_field, any_value(signer) signer, any_value(issue_date) issue_date, any_value(effective_date) effective_date, any_value(url) url, any_value(raw_text) raw_text FROM legal_docs GROUP BY uid)"
ONE_ARTICLE = "(SELECT DISTINCT article_uid, article_id, doc_id, doc_uid, article_number, title, content, is_amendment FROM legal_articles)"
ONE_CASE = "(SELECT uid, any_value(case_number) case_number, any_value(court_name) court_name, any_value(issuance_date) issuance_date, any_value(court_level) court_level, any_value(legal_bases) legal_bases, any_value(raw_text) raw_text, any_value(section_content) section_content, any_value(section_reasoning) section_reasoning, any_value(section_decision) section_decision, coalesce(nullif(any_value(title_parsed), ''), nullif(any_value(title_web), '')) title FROM court_cases GROUP BY uid)"


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def docs(spark: SparkSession, sf: str, *columns: str | Column) -> DataFrame:
    """One row per document, of the columns (or what is made of them) that don't change between crawls."""
    return read(spark, sf, "legal_docs").select("uid", *columns).dropDuplicates(["uid"])


def articles(spark: SparkSession, sf: str, *columns: str | Column) -> DataFrame:
    """One row per article, of the columns named (all by default); what is made of a text is best named here as an expression, so that it and not the text is shuffled."""
    a = read(spark, sf, "legal_articles")
    return (a.select("article_uid", *columns) if columns else a).dropDuplicates(["article_uid"])


def one_case(spark: SparkSession, sf: str, *columns: str | Column) -> DataFrame:
    return read(spark, sf, "court_cases").select("uid", *columns).dropDuplicates(["uid"])


def typed_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf, "doc_id", "title", "doc_type", "legal_field", "signer", "issue_date", "effective_date")
    return d.withColumns({"issue_date": dates.iso_date("issue_date"), "effective_date": dates.iso_date("effective_date")})


TYPED_DOC = f"(SELECT * REPLACE (try_cast(issue_date AS DATE) AS issue_date, try_cast(effective_date AS DATE) AS effective_date) FROM {ONE_DOC})"


# --- scalars -------------------------------------------------------------------------------------------------------------
@query(f"SELECT doc_id, {MATCH('text')} AS matched, {LOOSE('text')} AS loose FROM documents")
def norm_loose_documents(spark, sf):
    return read(spark, sf, "documents").select("doc_id", text.match_form("text").alias("matched"), text.loose_form("text").alias("loose"))


_PLAIN = SPACES(f'''regexp_replace(replace(regexp_replace(regexp_replace(content, '(?im)^{WS}*([0-9]+|[a-z]+|[ivxldm]+)[.)]{WS}*', ' ', 'g'), '(?m)^{WS}*-{WS}*', ' ', 'g'), chr(10), ' '), '[^\\p{{L}}\\p{{N}}_{S}]', '', 'g')''')


@query(f"SELECT article_uid, {_PLAIN} AS plain FROM {ONE_ARTICLE}")
def norm_legal_text(spark, sf):
    return articles(spark, sf, text.legal_plain("content").alias("plain"))


@query(
    f"SELECT uid, CASE WHEN coalesce(signer, '') = '' THEN 'unknown' ELSE regexp_replace(lower({STRIP('''regexp_replace(strip_accents(regexp_replace(translate(nfc_normalize(signer), 'đĐ', 'dD'), '[^\\p{Latin}\\p{M}0-9_\\s-]', '', 'g')), '[^A-Za-z0-9_\\s-]', '', 'g')''')}), '[-\\s]+', '-', 'g') END AS slug FROM {ONE_DOC}"
)
def slug_key(spark, sf):
    return docs(spark, sf, "signer").select("uid", text.slug("signer").alias("slug"))


@query(
    f"""SELECT uid, count(*) AS n_lines, count(*) FILTER (letters > 0 AND caps * 5 >= letters * 4) AS n_caps FROM (
    SELECT uid, length(regexp_replace(line, '[^\\p{{L}}]', '', 'g')) letters, length(regexp_replace(line, '[^\\p{{Lu}}]', '', 'g')) caps
    FROM (SELECT uid, unnest(string_split(raw_text, chr(10))) line FROM {ONE_DOC})) GROUP BY uid"""
)
def caps_ratio_lines(spark, sf):
    lines = F.split("raw_text", "\n", -1)
    return docs(spark, sf, F.size(lines).cast("bigint").alias("n_lines"), F.size(F.filter(lines, lambda x: text.is_caps_line(x))).cast("bigint").alias("n_caps"))


@query(
    f"""SELECT uid, coalesce(string_agg(line, chr(10) ORDER BY i), '') AS cleaned FROM (
    SELECT uid, i, p[i] AS line, len(p) AS n FROM (SELECT uid, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT uid, regexp_split_to_array(regexp_replace(raw_text, '[\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x{{feff}}\\x{{ad}}]', '', 'g'), '{text.LINE}') AS p FROM {ONE_DOC})))
    WHERE NOT (i = n AND line = '') AND lower({STRIP('line')}) NOT IN ('đang theo dõi', 'bổ sung') AND NOT contains(line, 'data-href=') AND NOT contains(line, 'docitem-view-change-content') GROUP BY uid"""
)
def noise_line_clean(spark, sf):
    return docs(spark, sf, text.clean_crawled("raw_text").alias("cleaned"))


_SENTENCES = f"list_filter(list_transform(string_split(replace(content, chr(10), ' '), '.'), lambda x: {STRIP('x')}), lambda x: x <> '')"
_EXCERPT = "CASE WHEN len(p) = 0 THEN '' ELSE array_to_string(p[1:2], '. ') || '.' END"


@query(f"SELECT article_uid, {_EXCERPT} AS excerpt FROM (SELECT article_uid, {_SENTENCES} p FROM {ONE_ARTICLE})")
def excerpt_two_sentences(spark, sf):
    return articles(spark, sf, text.excerpt("content").alias("excerpt"))


_DAY = "strftime(try_cast(issue_date AS DATE), '{f}')"


@query(
    f"""SELECT uid, try_cast(issue_date AS DATE) AS from_dmy, try_cast(issue_date AS DATE) AS from_ymd, try_cast(issue_date AS DATE) AS from_words, try_cast(issue_date AS DATE) AS from_iso,
    CASE WHEN try_cast(issue_date AS DATE) IS NULL THEN NULL ELSE strftime(try_cast(issue_date AS DATE), '%d/%m/%Y') END AS answer, CASE WHEN try_cast(issue_date AS DATE) IS NULL THEN NULL ELSE strftime(try_cast(issue_date AS DATE), '%Y-%m-%d') END AS of_case FROM {ONE_DOC}"""
)
def date_parse_formats(spark, sf):
    d = docs(spark, sf, "issue_date").withColumn("d", F.try_to_date("issue_date", "yyyy-MM-dd"))
    of = lambda p: F.date_format("d", p)
    words = F.concat(F.lit("Hà Nội, ngày "), of("d"), F.lit(" tháng "), of("M"), F.lit(" năm "), of("yyyy"))
    has = lambda c: F.when(F.col("d").isNotNull(), c)
    return d.select(
        "uid", dates.vn_date(of("d/M/yyyy")).alias("from_dmy"), dates.vn_date(of("yyyy-M-d")).alias("from_ymd"), dates.vn_date(words).alias("from_words"), dates.iso_date("issue_date").alias("from_iso"),
        has(dates.answer_date(of("d-M-yyyy"))).alias("answer"), dates.case_date(of("d - M - yyyy")).alias("of_case"),
    )


@query(
    f"""SELECT uid, n_doc, CASE WHEN contains(k, 'bộ luật') THEN 'Bộ luật' WHEN contains(k, 'luật') THEN 'Luật' WHEN contains(k, 'nghị định') THEN 'Nghị định' WHEN contains(k, 'nghị quyết') THEN 'Nghị quyết' WHEN contains(k, 'hiến pháp') THEN 'Hiến pháp' END AS kind,
    CASE WHEN regexp_matches(upper(doc_id), '/QH[0-9]*$') OR contains(upper(doc_id), '/NQ-QH') THEN 'Quốc hội' WHEN regexp_matches(upper(doc_id), '/(TVQH|UBTVQH)[0-9]*$') THEN 'Ủy ban Thường vụ Quốc hội' WHEN contains(upper(doc_id), '/NĐ-CP') OR contains(upper(doc_id), '/NQ-CP') THEN 'Chính phủ'
    WHEN contains(upper(doc_id), '/QĐ-TTG') OR contains(upper(doc_id), '/CT-TTG') THEN 'Thủ tướng Chính phủ' WHEN contains(upper(doc_id), '/L-CTN') OR contains(upper(doc_id), '/QĐ-CTN') OR contains(upper(doc_id), '/SL') THEN 'Chủ tịch nước' END AS body
    FROM (SELECT uid, doc_id, lower(coalesce(doc_type, '')) k, CASE WHEN coalesce(doc_id, '') <> '' THEN regexp_replace(replace(upper(doc_id), 'Đ', 'D'), '[^A-Z0-9]', '', 'g') END AS n_doc FROM {ONE_DOC})"""
)
def type_alias(spark, sf):
    return docs(spark, sf, "doc_id", "doc_type").select("uid", text.doc_number("doc_id").alias("n_doc"), text.doc_type("doc_type").alias("kind"), text.issuing_body("doc_id").alias("body"))


@query(
    """SELECT status_in, CASE WHEN contains(s, 'hết hiệu lực một phần') OR contains(s, 'sửa đổi') OR contains(s, 'bổ sung') THEN 'Hết hiệu lực một phần' WHEN contains(s, 'hết hiệu lực') OR contains(s, 'bị hủy bỏ') OR contains(s, 'bị bãi bỏ') THEN 'Hết hiệu lực'
    WHEN contains(s, 'còn hiệu lực') OR contains(s, 'đang áp dụng') THEN 'Còn hiệu lực' ELSE 'Không xác định' END AS bucket, n FROM (SELECT status AS status_in, lower(regexp_extract(coalesce(status, ''), '^[^0-9]*')) s, count(*) n FROM legal_docs GROUP BY 1, 2)"""
)
def status_bucket(spark, sf):
    d = read(spark, sf, "legal_docs").groupBy(F.col("status").alias("status_in")).agg(F.count("*").alias("n"))
    return d.select("status_in", text.status("status_in").alias("bucket"), "n")


@query(
    f"""SELECT uid, CASE WHEN length(coalesce(court_name, '')) < 5 THEN 'TAND' ELSE replace(regexp_replace('TAND' || array_to_string(list_transform(string_split_regex({STRIP(f'''regexp_replace(regexp_replace(court_name, '(?i)khu{WS}*vực', 'KV', 'g'), '(?i){"|".join(ids.COURT_WORDS)}', '', 'g')''')}, '{WS}+'),
    lambda w: CASE WHEN (regexp_matches(w, '\\p{{L}}') AND w = upper(w)) OR regexp_matches(w, '^[0-9]+$') THEN w ELSE upper(left(w, 1)) END), ''), '[^A-Z0-9]', '', 'g'), 'KVKV', 'KV') END AS acronym FROM {ONE_CASE}"""
)
def court_acronyms(spark, sf):
    return one_case(spark, sf, "court_name").select("uid", ids.court_acronym("court_name").alias("acronym"))


@query(
    f"""SELECT article_uid, try_cast(regexp_extract({STRIP('article_number')}, '^([0-9]+)', 1) AS BIGINT) AS n, CASE WHEN regexp_matches({STRIP('article_number')}, '^[0-9]+[a-zA-Z]*$') THEN lower(regexp_extract({STRIP('article_number')}, '([a-zA-Z]*)$', 1)) END AS suffix,
    format('Điều {{}} {{}}', article_number, doc_id) AS label, format('Điều {{}} của {{}}', article_number, doc_id) AS answer FROM {ONE_ARTICLE}"""
)
def article_labels(spark, sf):
    return articles(spark, sf, "article_number", "doc_id").select("article_uid", text.article_int("article_number").alias("n"), text.article_value("article_number")["suffix"].alias("suffix"), text.article_label("article_number", "doc_id").alias("label"), text.answer_label("article_number", "doc_id").alias("answer"))


# --- parsers -------------------------------------------------------------------------------------------------------------
@query(
    """WITH n AS (SELECT doc_uid, content, row_number() OVER (PARTITION BY doc_uid ORDER BY article_uid) AS k FROM (SELECT DISTINCT doc_uid, article_uid, regexp_replace(nfc_normalize(content), '[^\\p{L}\\p{N} ,]', '', 'g') AS content FROM legal_articles))
    SELECT doc_uid, k || '/T' AS article_id, k::VARCHAR AS article_number, 'Mục ' || k AS heading, trim(content) AS content FROM n WHERE trim(content) <> ''"""
)
def skeleton_split(spark, sf):
    """A round trip: texts put together from the articles, with headings and a quoted one between, are split again."""
    a = articles(spark, sf, "doc_uid", F.regexp_replace(text.nfc("content"), r"[^\p{L}\p{N} ,]", "").alias("content"))
    a = a.withColumn("k", F.row_number().over(Window.partitionBy("doc_uid").orderBy("article_uid")))
    part = F.concat(F.lit("Điều "), F.col("k").cast("string"), F.lit(". Mục "), F.col("k").cast("string"), F.lit("\n"), F.col("content"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", part.alias("t")))), lambda x: x["t"]), "\n")
    made = a.groupBy("doc_uid").agg(body.alias("raw_text")).select(F.col("doc_uid").alias("uid"), F.lit("T").alias("doc_id"), F.lit(False).alias("is_amendment"), "raw_text")
    return documents.split_articles(made).select("doc_uid", "article_id", "article_number", "heading", F.trim("content").alias("content"))


@query()
def document_articles(spark, sf):
    """All articles of all documents, from their texts."""
    return documents.split_articles(read(spark, sf, "legal_docs").select("uid", "doc_id", "is_amendment", "raw_text").dropDuplicates(["uid"]))


@query()
def document_titles(spark, sf):
    return docs(spark, sf, documents.document_title("raw_text").alias("title"))


@query(
    f"""WITH c AS (SELECT uid, coalesce(section_content, '') a, coalesce(section_reasoning, '') b, coalesce(section_decision, '') d FROM {ONE_CASE})
    SELECT uid, 'Mở đầu' AS introduction, {STRIP('a')} AS content, {STRIP('b')} AS reasoning, {STRIP('d')} AS decision FROM c WHERE {STRIP('a')} <> ''"""
)
def case_sections(spark, sf):
    """A round trip: texts put together from the sections are taken apart again."""
    c = one_case(spark, sf, "section_content", "section_reasoning", "section_decision").filter(text.strip(text._text("section_content")) != "")
    made = F.concat(F.lit("Mở đầu\nNỘI DUNG VỤ ÁN:\n"), text._text("section_content"), F.lit("\nNHẬN ĐỊNH CỦA TÒA ÁN\n"), text._text("section_reasoning"), F.lit("\nQUYẾT ĐỊNH:\n"), text._text("section_decision"))
    return c.select("uid", cases.sections(made).alias("s")).select("uid", "s.*")


@query()
def case_metadata(spark, sf):
    """What the texts of the cases say of themselves."""
    t = F.col("raw_text")
    return one_case(spark, sf, cases.case_number(t).alias("case_number"), cases.case_day(t).alias("case_date"), cases.case_title(t).alias("title"), cases.legal_bases(cases.sections(t)["decision"]).alias("legal_bases"))


@query(
    f"""SELECT uid, kind, url FROM (SELECT uid, x.url AS url, i, CASE WHEN contains(m, 'pdf') THEN 'pdf' WHEN contains(m, 'doc') OR contains(m, 'word') THEN 'doc' ELSE 'unknown' END AS kind, m, row_number() OVER (PARTITION BY uid, x.url ORDER BY i) AS r
    FROM (SELECT uid, i, l[i] AS x, lower(concat_ws(' ', {SPACES('l[i].label')}, {SPACES('l[i].title')}, l[i].url)) AS m FROM (SELECT uid, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT uid, any_value(download_links) l FROM legal_docs WHERE download_links IS NOT NULL GROUP BY uid))) WHERE contains(m, 'pdf') OR contains(m, 'doc') OR contains(m, 'word') OR contains(m, 'tai-file') OR contains(m, 'tải')) WHERE r = 1"""
)
def link_dedupe_classify(spark, sf):
    d = read(spark, sf, "legal_docs").filter("download_links is not null").groupBy("uid").agg(F.first("download_links").alias("l"))
    found = html.downloads(F.transform("l", lambda x: F.struct(x["url"].alias("href"), x["label"].alias("label"), x["title"].alias("title"))), "https://example")
    return d.select("uid", F.explode(found).alias("x")).select("uid", F.col("x.file_type").alias("kind"), "x.url")


@query(
    f"""SELECT uid, title, NOT regexp_matches(lower(title), 'dự thảo|dự kiến|góp ý|sửa đổi|bổ sung|quy định về|về việc') AND len(string_split(t, ' ')) IN (2, 3) AND regexp_matches(array_to_string(string_split(t, ' ')[2:], ' '), '[0-9/-]') AS official FROM (
    SELECT uid, title, {SPACES('title')} t FROM (SELECT uid, title FROM {ONE_DOC} UNION ALL SELECT uid || '#', doc_type || ' ' || doc_id FROM {ONE_DOC} WHERE doc_type IS NOT NULL))"""
)
def strict_title_filter(spark, sf):
    d = docs(spark, sf, "title", "doc_type", "doc_id")
    both = d.select("uid", "title").union(d.filter("doc_type is not null").select(F.concat("uid", F.lit("#")), F.concat_ws(" ", "doc_type", "doc_id")))
    return both.select("uid", "title", html.is_official_title("title").alias("official"))


@query(
    f"""SELECT uid, len(p) AS n_pages, len(p) < 1 OR list_sum(list_transform(p[1:5], lambda x: length({STRIP('x')}))) < 50 * len(p[1:5]) AS scanned FROM (SELECT uid, list_filter(list_transform(string_split(raw_text, chr(10) || chr(10) || chr(10)), lambda x: {STRIP('x')}), lambda x: x <> '') p FROM {ONE_CASE})"""
)
def scanned_detector(spark, sf):
    p = files.pages(F.col("raw_text"))
    return one_case(spark, sf, F.size(p).cast("bigint").alias("n_pages"), files.is_scanned(p).alias("scanned"))


# --- relational ----------------------------------------------------------------------------------------------------------
@query(
    """SELECT uid, arg_min(doc_id, (scraped_at, coalesce(summary, ''), coalesce(status, ''))) AS doc_id, arg_max_null(status, (scraped_at, coalesce(summary, ''), coalesce(status, ''))) AS status, arg_max_null(summary, (scraped_at, coalesce(summary, ''), coalesce(status, ''))) AS summary FROM legal_docs WHERE coalesce(title, '') <> '' AND coalesce(doc_id, '') <> '' GROUP BY uid"""
)
def upsert_last_wins(spark, sf):
    """Crawls of a document, out of order: the last one's status and summary, the first one's number."""
    accepted, _ = rel.required(read(spark, sf, "legal_docs"), ["uid", "doc_id", "title"])
    rows = accepted.select("uid", "doc_id", "status", "summary", "scraped_at", text._text("summary").alias("o1"), text._text("status").alias("o2"))
    return rel.upsert(None, rows, "uid", ["status", "summary"], ["scraped_at", "o1", "o2"])


@query(
    """WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS k, count(*) AS n, min(l_returnflag) AS f FROM lineitem GROUP BY 1), t AS (SELECT * FROM a WHERE k % 3 <> 0), s AS (SELECT k, n + 1 AS n, 'X' AS f FROM a WHERE k % 2 = 0)
    SELECT coalesce(t.k, s.k) AS k, coalesce(s.n, t.n) AS n, CASE WHEN t.k IS NULL THEN s.f ELSE t.f END AS f FROM t FULL JOIN s ON t.k = s.k"""
)
def upsert_merge(spark, sf):
    """A batch merged into a table: n is updated, f is frozen."""
    a = read(spark, sf, "lineitem").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k")).agg(F.count("*").alias("n"), F.min("l_returnflag").alias("f"))
    target, source = a.filter("k % 3 <> 0"), a.filter("k % 2 = 0").select("k", (F.col("n") + 1).alias("n"), F.lit("X").alias("f"), F.lit(1).alias("o"))
    return rel.upsert(target, source, "k", ["n"], ["o"])


@query(f"SELECT a.article_uid, a.doc_uid FROM {ONE_ARTICLE} a WHERE EXISTS (SELECT 1 FROM legal_docs d WHERE d.uid = a.doc_uid AND d.legal_field IS NOT NULL)")
def fk_semi(spark, sf):
    return rel.with_parent(articles(spark, sf, "doc_uid"), read(spark, sf, "legal_docs").filter("legal_field is not null"), "doc_uid", "uid").select("article_uid", "doc_uid")


@query("SELECT DISTINCT uid FROM court_cases WHERE uid NOT IN (SELECT refer_uid FROM bench_items WHERE refer_uid IS NOT NULL)")
def exclude_anti(spark, sf):
    return rel.excluding(read(spark, sf, "court_cases").select("uid").distinct(), read(spark, sf, "bench_items").select(F.col("refer_uid").alias("uid")), "uid")


_YEAR = "coalesce(year(d.issue_date)::VARCHAR, 'không xác định')"
_CORE = f"""(SELECT * FROM (SELECT *, try_cast(regexp_extract({STRIP('article_number')}, '^([0-9]+)', 1) AS BIGINT) AS n, min(n) OVER (PARTITION BY doc_uid) AS lo, max(n) OVER (PARTITION BY doc_uid) AS hi FROM {ONE_ARTICLE}) WHERE length({STRIP('content')}) >= 80 AND hi - lo + 1 >= 4 AND n BETWEEN lo + 1 AND hi - 1)"""


@query(f"SELECT article_uid, doc_uid, article_number FROM {_CORE}")
def core_articles(spark, sf):
    a = articles(spark, sf, "doc_uid", "article_number", rel.long_enough().alias("long"))
    return rel.core_articles(a, 4, 1, F.col("long")).select("article_uid", "doc_uid", "article_number")


@query(
    """SELECT uid, doc_type FROM (SELECT *, row_number() OVER (PARTITION BY doc_type ORDER BY md5('7|' || uid), uid) AS r FROM (SELECT DISTINCT uid, doc_type FROM legal_docs)) WHERE r <= CASE doc_type WHEN 'Luật' THEN 40 WHEN 'Nghị định' THEN 9 WHEN 'Thông tư' THEN 1 ELSE 0 END"""
)
def stratified_sample(spark, sf):
    return rel.stratified(docs(spark, sf, "doc_type"), "doc_type", "uid", dict(zip(("Luật", "Nghị định", "Thông tư"), rel.quotas(50).values())), 7).select("uid", "doc_type")


@query("SELECT uid FROM (SELECT DISTINCT uid FROM court_cases) ORDER BY md5('3|' || uid), uid LIMIT 25")
def random_topk(spark, sf):
    return rel.sample(read(spark, sf, "court_cases").select("uid").distinct(), "uid", 25, 3)


@query(f"SELECT article_uid, doc_uid FROM (SELECT *, row_number() OVER (PARTITION BY doc_uid ORDER BY article_number, article_uid) AS r FROM {ONE_ARTICLE}) WHERE r <= 5")
def per_doc_top5(spark, sf):
    return rel.per_group(articles(spark, sf, "doc_uid", "article_number"), "doc_uid", [F.col("article_number"), F.col("article_uid")], 5).select("article_uid", "doc_uid")


@query(
    f"""WITH a AS (SELECT doc_uid, article_uid, article_number, CASE WHEN regexp_matches({STRIP('article_number')}, '^[0-9]+[a-zA-Z]*$') THEN try_cast(regexp_extract(article_number, '([0-9]+)', 1) AS BIGINT) END AS n, lower(regexp_extract(article_number, '([a-zA-Z]*)$', 1)) AS s FROM {ONE_ARTICLE})
    SELECT target, article_uid, article_number, r AS rank FROM (SELECT t.article_uid AS target, a.article_uid, a.article_number, row_number() OVER (PARTITION BY t.article_uid ORDER BY CASE WHEN t.n IS NULL THEN 0 ELSE coalesce(abs(a.n - t.n), 10000) END, CASE WHEN t.n IS NULL THEN '' WHEN a.n IS NULL THEN a.article_number ELSE a.s END, a.article_uid)::INT AS r
    FROM a t JOIN a ON t.doc_uid = a.doc_uid AND t.article_uid <> a.article_uid) WHERE r <= 3"""
)
def neighbor_topk(spark, sf):
    a = articles(spark, sf, "doc_uid", "article_number")
    return rel.neighbours(a, a, 3)


@query(
    """SELECT uid, doc_type, issue_date FROM (SELECT DISTINCT uid, doc_type, try_cast(issue_date AS DATE) AS issue_date FROM legal_docs WHERE contains(lower(title), 'giấy phép') OR contains(lower(title), 'tài sản')) ORDER BY issue_date DESC NULLS LAST, uid LIMIT 300"""
)
def keyword_newest(spark, sf):
    d = docs(spark, sf, "title", "doc_type", "issue_date").filter(rel.any_like(["title"], F.array(F.lit("giấy phép"), F.lit("Tài sản"))))
    return d.select("uid", "doc_type", dates.iso_date("issue_date").alias("issue_date")).orderBy(F.desc_nulls_last("issue_date"), "uid").limit(300)


def _searches(spark: SparkSession, sf: str) -> DataFrame:
    """Searches from the benchmark items: their document number, else words of their question."""
    b = read(spark, sf, "bench_items").select("uid", "refer_doc_id", "question")
    ws = F.slice(F.filter(F.split(text.spaces("question"), " "), lambda x: F.char_length(x) > 4), 1, 2)
    numbers = F.when(F.col("refer_doc_id").isNotNull(), F.array(text.doc_number("refer_doc_id"))).otherwise(F.array().cast("array<string>"))
    return b.select(F.col("uid").alias("search_id"), text.keywords(ws).alias("keywords"), F.lit("Luật").alias("doc_type"), F.lit(2015).alias("year"), numbers.alias("doc_numbers"))


@query()
def candidate_rank(spark, sf):
    return rel.search(typed_docs(spark, sf), _searches(spark, sf)).withColumn("line", rel.candidate_line())


@query(
    f"""WITH k AS (SELECT DISTINCT p_type AS keyword FROM part), t AS (SELECT DISTINCT p_name AS title FROM part), w AS (SELECT keyword, title, list_distinct(list_filter(string_split({SPACES('lower(keyword)')}, ' '), lambda x: x <> '')) a, list_distinct(string_split({SPACES('lower(title)')}, ' ')) b FROM k, t)
    SELECT keyword, title, len(list_intersect(a, b)) / len(a) AS share FROM w WHERE len(list_intersect(a, b)) / len(a) >= 0.3"""
)
def keyword_title_overlap(spark, sf):
    p = read(spark, sf, "part")
    return rel.keyword_titles(p.select(F.col("p_type").alias("keyword")), p.select(F.col("p_name").alias("title")), 0.3)


@query(
    """WITH e AS (SELECT user_id, event_id, event_type = 'purchase' AS hit, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events), g AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - CASE WHEN run > 0 THEN 1 ELSE 0 END AS k FROM e),
    s AS (SELECT user_id, min(event_id) AS stop FROM g WHERE k >= 3 GROUP BY user_id) SELECT g.user_id, count(*) AS kept FROM g LEFT JOIN s USING (user_id) WHERE stop IS NULL OR event_id <= stop GROUP BY g.user_id"""
)
def gap_stop(spark, sf):
    e = read(spark, sf, "events").select("user_id", "event_id", (F.col("event_type") == "purchase").alias("hit"))
    return rel.until_gap(e, "user_id", "event_id", "hit", 3).groupBy("user_id").agg(F.count("*").alias("kept"))


@query(
    """WITH e AS (SELECT l_orderkey AS case_uid, count(*) AS expected FROM lineitem GROUP BY 1), f AS (SELECT l_orderkey AS case_uid, count(DISTINCT l_partkey) AS found FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1) SELECT case_uid, expected, found FROM e JOIN f USING (case_uid) WHERE found >= expected"""
)
def ref_completeness(spark, sf):
    l = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("case_uid"), F.col("l_partkey").alias("article_uid"), "l_returnflag")
    return rel.complete(l, l.filter("l_returnflag <> 'A'"))


@query("SELECT legal_field, count(*) AS n, list_sort(list(DISTINCT doc_uid)) AS doc_uids FROM (SELECT DISTINCT a.article_uid, a.doc_uid, d.legal_field FROM legal_articles a JOIN legal_docs d ON d.uid = a.doc_uid WHERE trim(coalesce(d.legal_field, '')) <> '' AND lower(d.legal_field) NOT IN ('đang cập nhật', 'không xác định', 'none')) GROUP BY 1")
def articles_by_field(spark, sf):
    rows = generators.with_docs(articles(spark, sf, "doc_uid"), docs(spark, sf, "legal_field")).withColumn("legal_field", text.clean_field("d_legal_field")).filter("legal_field is not null")
    return rows.groupBy("legal_field").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("doc_uid")).alias("doc_uids"))


# --- generators ----------------------------------------------------------------------------------------------------------
# Core articles as the generators take them (8 articles, 2 at each end), or (by _FEW) with the lower bounds of the small test tables; with their documents in the strata.
_CORE8 = _CORE.replace(">= 4", ">= 8").replace("BETWEEN lo + 1 AND hi - 1", "BETWEEN lo + 2 AND hi - 2")
_FEW = f"""(SELECT c.article_uid, c.article_number, c.content, c.doc_uid, d.doc_id AS d_doc_id, coalesce(nullif(d.title, ''), d.doc_id) AS name, {_YEAR} AS y, CASE WHEN c.doc_uid = 'HP2013' OR d.doc_id = 'HP2013' THEN 'special' WHEN d.doc_type IN ('Luật', 'Nghị định') THEN d.doc_type END AS stratum FROM {_CORE} c JOIN {TYPED_DOC} d ON d.uid = c.doc_uid)"""


@query(
    f"""SELECT 'bench_2_2_' || article_uid AS uid, article_uid AS refer_uid, 'article' AS refer_type, 'Hãy cho biết nội dung của Điều ' || article_number || ' của ' || name || ' (' || y || ').' AS question, answer FROM (SELECT *, {_PLAIN} AS answer FROM (
    SELECT c.article_uid, c.article_number, c.content, coalesce(nullif(d.title, ''), d.doc_id) AS name, {_YEAR} AS y, row_number() OVER (PARTITION BY c.doc_uid ORDER BY c.article_number, c.article_uid) AS r FROM {_CORE8} c JOIN {TYPED_DOC} d ON d.uid = c.doc_uid) WHERE r <= 5) WHERE answer <> ''"""
)
def article_recall_items(spark, sf):
    return generators.recall_items(articles(spark, sf), typed_docs(spark, sf), None)


@query(
    f"""SELECT 'bench_2_3_' || CASE WHEN coin THEN 'docid' ELSE 'article' END || '_' || article_uid AS uid, article_uid AS refer_uid, 'Đoạn trích dưới đây thuộc văn bản nào?' || chr(10) || chr(10) || '"' || excerpt || '"' AS question, CASE WHEN coin THEN d_doc_id ELSE 'Điều ' || article_number || ' ' || d_doc_id END AS answer, 'article' AS refer_type
    FROM (SELECT *, {_EXCERPT} AS excerpt, left(md5('coin0|' || article_uid), 1) < '8' AS coin FROM (SELECT *, {_SENTENCES} AS p FROM {_FEW} WHERE stratum IS NOT NULL AND d_doc_id IS NOT NULL) WHERE len(p) > 0 ORDER BY md5('0|' || article_uid), article_uid LIMIT 50)
    UNION ALL (SELECT 'bench_2_3_effective_' || uid, uid, 'Văn bản số ' || doc_id || ' có hiệu lực từ ngày nào?', strftime(effective_date, '%d/%m/%Y'), 'doc' FROM {TYPED_DOC} WHERE doc_id IS NOT NULL AND effective_date IS NOT NULL ORDER BY md5('date0|' || uid), uid LIMIT 25)
    UNION ALL (SELECT 'bench_2_3_signer_' || uid, uid, 'Ai ký văn bản số ' || doc_id || '?', signer, 'doc' FROM {TYPED_DOC} WHERE doc_id IS NOT NULL AND coalesce(signer, '') <> '' ORDER BY md5('signer0|' || uid), uid LIMIT 25)"""
)
def metadata_recall_items(spark, sf):
    return generators.metadata_items(articles(spark, sf), typed_docs(spark, sf), 100, least=4, margin=1)


@query(
    f"""WITH a AS (SELECT field, article_uid, label, row_number() OVER (PARTITION BY field ORDER BY md5('0|' || article_uid), article_uid) AS r, count(*) OVER (PARTITION BY field) AS size FROM (SELECT {STRIP('d.legal_field')} AS field, c.article_uid, 'Điều ' || c.article_number || ' ' || d.doc_id AS label FROM {_CORE8} c JOIN {TYPED_DOC} d ON d.uid = c.doc_uid WHERE d.doc_id IS NOT NULL)
    WHERE field <> '' AND lower(field) NOT IN ('{"', '".join(text.FIELD_PLACEHOLDERS)}')), f AS (SELECT field, any_value(size) AS size, row_number() OVER (ORDER BY md5('0|' || field), field) - 1 AS g, count(*) OVER () AS n FROM a GROUP BY field),
    t AS (SELECT k, s, f.g, f.n FROM f, range(1, 101) x(k), range(0, (SELECT count(*) FROM f)) y(s) WHERE f.n >= 4 AND f.g = (k - 1 + s) % f.n),
    m AS (SELECT k, list(struct_pack(s := t.s, field := f.field, article_uid := a.article_uid, label := a.label) ORDER BY t.s) AS met FROM t JOIN f ON f.g = t.g JOIN a ON a.field = f.field AND a.r = ((t.k - 1) // t.n + t.s) % f.size + 1 GROUP BY k),
    o AS (SELECT met[1] AS c, list_transform(met, lambda x: x.label) AS ls FROM m), q AS (SELECT c, list_filter(ls, lambda x, i: list_position(ls, x) = i)[1:4] AS four FROM o)
    SELECT 'bench_2_6_' || c.article_uid AS uid, c.article_uid AS refer_uid, 'article' AS refer_type, c.field AS legal_field, 'Điều khoản nào dưới đây liên quan trực tiếp nhất đến chủ đề pháp lý: ''' || c.field || '''?{generators.PICK_TAIL}' AS question,
    list_transform(list_sort(list_transform(four, lambda x: md5(c.article_uid || '|' || x) || x)), lambda x: substr(x, 33)) AS options, c.label AS answer FROM q WHERE len(four) = 4"""
)
def mcq_distractors(spark, sf):
    return generators.field_items(articles(spark, sf), typed_docs(spark, sf), 100)


@query(
    """SELECT uid, CASE WHEN task_id = 'task_3_1' THEN question || b || chr(10) || chr(10) || '{"answer": "...", "explanation": "..."}' WHEN options IS NOT NULL AND len(options) > 0 THEN question || b || chr(10) || chr(10) || 'Một đáp án.' WHEN task_id IN ('task_2_1', 'task_2_2', 'task_2_3') THEN question || chr(10) || chr(10) || task_id ELSE question END AS prompt
    FROM (SELECT *, CASE WHEN options IS NOT NULL AND len(options) > 0 THEN chr(10) || chr(10) || 'Các phương án:' || chr(10) || array_to_string(list_transform(options, lambda x, i: substr('ABCD', i, 1) || '. ' || x), chr(10)) ELSE '' END AS b FROM bench_items)"""
)
def prompt_render(spark, sf):
    made = text.prompt(F.col("task_id"), F.col("question"), F.col("options"), "Một đáp án.", {t: t for t in ("task_2_1", "task_2_2", "task_2_3")}, '{"answer": "...", "explanation": "..."}')
    return read(spark, sf, "bench_items").select("uid", made.alias("prompt"))


# --- scoring -------------------------------------------------------------------------------------------------------------
MODELS = ("copy", "shout", "letter", "other")
_OTHER = "lead(answer, 1, answer) OVER (PARTITION BY task_id ORDER BY uid)"
RESPONSES = f"""(SELECT b.uid, task_id, options, answer, m.model, CASE m.model WHEN 'copy' THEN 'Đáp án: ' || answer || '.' WHEN 'shout' THEN '"' || upper(answer) || '"' WHEN 'letter' THEN substr('ABCD', 1 + (length(b.uid) % 4)::INT, 1) || '.' ELSE other END AS model_answer
    FROM (SELECT *, {_OTHER} AS other FROM bench_items) b, (VALUES ('copy'), ('shout'), ('letter'), ('other')) m(model) WHERE answer IS NOT NULL)"""


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Made-up answers of four models to the items: the gold text within a sentence, in capitals, a letter, and another item's answer."""
    b = read(spark, sf, "bench_items").withColumn("other", F.lead("answer", 1).over(Window.partitionBy("task_id").orderBy("uid"))).filter("answer is not null")
    b = b.withColumn("other", F.coalesce("other", "answer"))
    b = b.withColumn("model", F.explode(F.array(*map(F.lit, MODELS))))
    made = F.when(F.col("model") == "copy", F.concat(F.lit("Đáp án: "), "answer", F.lit("."))).when(F.col("model") == "shout", F.concat(F.lit('"'), F.upper("answer"), F.lit('"'))).when(
        F.col("model") == "letter", F.concat(F.substring(F.lit("ABCD"), 1 + F.char_length("uid") % 4, F.lit(1)), F.lit("."))
    ).otherwise(F.col("other"))
    return b.withColumn("model_answer", made)


_F1 = """CASE WHEN len(p) = 0 AND len(g) = 0 THEN 1.0 WHEN len(p) = 0 OR len(g) = 0 THEN 0.0 ELSE 2.0 * list_sum(list_transform(list_distinct(p), lambda x: least(len(list_filter(p, lambda y: y = x)), len(list_filter(g, lambda y: y = x))))) / (len(p) + len(g)) END"""
_SHORT = f"""SELECT uid, model, task_id, pm = gm AS exact_match, pl = gl AS loose_exact_match, pm = gm OR pl = gl AS is_correct, round({_F1}, 4)::DOUBLE AS token_f1,
    round(CASE WHEN length(pl) = 0 AND length(gl) = 0 THEN 1.0 WHEN length(pl) = 0 OR length(gl) = 0 THEN 0.0 ELSE least(length(pl), length(gl)) / greatest(length(pl), length(gl)) END, 4)::DOUBLE AS length_ratio
    FROM (SELECT *, list_filter(string_split(pl, ' '), lambda x: x <> '') p, list_filter(string_split(gl, ' '), lambda x: x <> '') g FROM (SELECT uid, model, task_id, {MATCH('model_answer')} pm, {MATCH('answer')} gm, {LOOSE('model_answer')} pl, {LOOSE('answer')} gl FROM {RESPONSES}))"""


@query(_SHORT)
def score_short_answer(spark, sf):
    return scoring.short_answer(responses(spark, sf), similarity=False).select("uid", "model", "task_id", "exact_match", "loose_exact_match", "is_correct", "token_f1", "length_ratio")


@query(
    f"""SELECT uid, model, selected AS selected_answer, source AS match_source, coalesce({LOOSE('selected')}, '') = gl AS is_correct FROM (SELECT *, CASE WHEN len(hits) = 1 THEN hits[1] WHEN gl <> '' AND contains(pl, gl) THEN answer WHEN pl = gl THEN answer WHEN i IS NOT NULL AND i < len(options) THEN options[i + 1] END AS selected,
    CASE WHEN len(hits) = 1 THEN 'option_text' WHEN gl <> '' AND contains(pl, gl) THEN 'gold_text' WHEN pl = gl THEN 'exact_text' WHEN i IS NOT NULL AND i < len(options) THEN 'choice_letter' END AS source FROM (
    SELECT *, list_filter(options, lambda o: {LOOSE('o')} <> '' AND contains(pl, {LOOSE('o')})) AS hits, CASE WHEN regexp_matches(lower(pm), '^[abcd]([.)\\s]|$)') THEN instr('abcd', left(lower(pm), 1)) - 1 END AS i FROM (SELECT uid, model, options, answer, {MATCH('model_answer')} pm, {LOOSE('model_answer')} pl, {LOOSE('answer')} gl FROM {RESPONSES} WHERE options IS NOT NULL)))"""
)
def score_mcq(spark, sf):
    return scoring.choice(responses(spark, sf).filter("options is not null")).select("uid", "model", "selected_answer", "match_source", "is_correct")


@query(
    f"""SELECT uid, model, q AS question_type, CASE q WHEN 'effective_date_from_doc_id' THEN d(pm) = d(gm) ELSE contains(pl, gl) END AS is_correct FROM (SELECT uid, model, q, {MATCH('pa')} pm, {MATCH('ga')} gm, {LOOSE('pa')} pl, {LOOSE('ga')} gl FROM (
    SELECT uid AS u, 'signer_from_doc_id' AS q, 'bench_2_3_signer_' || uid AS uid, model, ga, CASE model WHEN 'full' THEN 'Ông ' || ga ELSE left(ga, 5) END AS pa FROM (SELECT uid, signer AS ga FROM {ONE_DOC} WHERE signer IS NOT NULL), (VALUES ('full'), ('part')) m(model)
    UNION ALL SELECT uid, 'effective_date_from_doc_id', 'bench_2_3_effective_' || uid, model, strftime(e, '%d/%m/%Y'), CASE model WHEN 'full' THEN strftime(e, '%Y-%m-%d') ELSE strftime(e, '%m/%Y') END FROM (SELECT uid, try_cast(effective_date AS DATE) AS e FROM {ONE_DOC} WHERE effective_date IS NOT NULL), (VALUES ('full'), ('part')) m(model)))""".replace(
        "d(pm) = d(gm)", "CASE WHEN regexp_matches(pm, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN regexp_replace(pm, '^([0-9]{4})-([0-9]{2})-([0-9]{2})$', '\\3/\\2/\\1') ELSE pm END = gm"
    )
)
def score_metadata(spark, sf):
    d = docs(spark, sf, "signer", "effective_date").withColumn("e", dates.iso_date("effective_date")).withColumn("model", F.explode(F.array(F.lit("full"), F.lit("part"))))
    full = F.col("model") == "full"
    a = d.filter("signer is not null").select(F.concat(F.lit("bench_2_3_signer_"), "uid").alias("uid"), "model", F.col("signer").alias("answer"), F.when(full, F.concat(F.lit("Ông "), "signer")).otherwise(F.left("signer", F.lit(5))).alias("model_answer"))
    b = d.filter("effective_date is not null").select(F.concat(F.lit("bench_2_3_effective_"), "uid").alias("uid"), "model", F.date_format("e", "dd/MM/yyyy").alias("answer"), F.when(full, F.date_format("e", "yyyy-MM-dd")).otherwise(F.date_format("e", "MM/yyyy")).alias("model_answer"))
    return scoring.metadata(a.unionByName(b)).select("uid", "model", "question_type", "is_correct")


@query(
    """SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS judge_score, json_extract_string(props, '$.k') AS answer FROM events"""
)
def judge_json(spark, sf):
    """JSON within chatter: a judge's total, and an answer."""
    e = read(spark, sf, "events").withColumn("raw", F.concat(F.lit("Kết quả:\n"), F.replace(F.col("props"), F.lit('"k"'), F.lit('"total_score"')), F.lit("\nHết.")))
    e = e.withColumns({"raw_judge_output": F.col("raw"), "uid": F.col("event_id").cast("string"), "task_id": F.lit("task_3_1"), "options": F.array().cast("array<string>"), "answer": F.lit("x"), "model_answer": F.replace(F.col("raw"), F.lit('"total_score"'), F.lit('"answer"'))})
    return scoring.judged(e).select("event_id", "judge_score", F.col("model_answer").alias("answer"))


@query()
def char_similarity(spark, sf):
    return scoring.short_answer(responses(spark, sf)).select("uid", "model", "char_similarity")


@query()
def score_all_tasks(spark, sf):
    return scoring.score(responses(spark, sf))


_LABELS = "CASE " + " ".join(f"WHEN lower(t) = '{x.lower()}' THEN '{x}'" for x in text.ISSUE_LABELS) + " " + " ".join(f"WHEN t = '{i}' OR starts_with(t, '{i}.') THEN '{x}'" for i, x in enumerate(text.ISSUE_LABELS, 1)) + " " + " ".join(f"WHEN contains(lower(t), '{x.lower()}') THEN '{x}'" for x in text.ISSUE_LABELS) + f" ELSE '{text.OTHER_LABEL}' END"


@query(f"SELECT uid, {_LABELS} AS label FROM (SELECT uid, trim(trim({STRIP('answer')}, '\"'), '''') AS t FROM bench_items WHERE answer IS NOT NULL UNION ALL SELECT 'e' || event_id, (event_id % 17)::VARCHAR || '. x' FROM events)")
def label_match(spark, sf):
    b = read(spark, sf, "bench_items").filter("answer is not null").select("uid", "answer")
    e = read(spark, sf, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("uid"), F.concat((F.col("event_id") % 17).cast("string"), F.lit(". x")).alias("answer"))
    return b.union(e).select("uid", text.issue_label("answer").alias("label"))


@query(f"SELECT model, task_id, count(*) AS num_samples, round(avg(is_correct::INT), 4)::DOUBLE AS accuracy, round(avg(token_f1), 4)::DOUBLE AS avg_token_f1, round(avg(length_ratio), 4)::DOUBLE AS avg_length_ratio FROM ({_SHORT}) GROUP BY 1, 2")
def summary_by_model_task(spark, sf):
    """Flagship: answers, normal forms, scores and the summary of each model and task."""
    s = scoring.short_answer(responses(spark, sf), similarity=False)
    s = s.withColumns({"char_similarity": F.lit(None).cast("double"), "judge_score": F.lit(None).cast("double"), "judge_acceptable": F.lit(None).cast("boolean")})
    return scoring.summarize(s).select("model", "task_id", "num_samples", "accuracy", "avg_token_f1", "avg_length_ratio")
