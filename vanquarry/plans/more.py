"""Further queries: identifiers, extraction round trips, candidate search and the generators that ask a model (with made-up completions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanquarry.functions import dates, ids, text
from vanquarry.operators import cases, documents, generators, html, scoring
from vanquarry.operators import relational as rel
from vanquarry.plans.catalogue import _CORE8, _FEW, _YEAR, ONE_ARTICLE, ONE_CASE, ONE_DOC, SPACES, STRIP, TYPED_DOC, articles, docs, one_case, query, typed_docs
from vanquarry.sources.tables import read


# --- identifiers and texts -----------------------------------------------------------------------------------------------
@query(
    """SELECT uid, upper(replace(n, 'đ', 'Đ')) AS raw, [regexp_replace(replace(upper(n), 'Đ', 'D'), '[^A-Z0-9]', '', 'g')] AS found, regexp_extract(n, '^([0-9]+)/([0-9]{4})/', 1) || '/' || regexp_extract(n, '^([0-9]+)/([0-9]{4})/', 2) AS stem
    FROM (SELECT uid, any_value(doc_id) n FROM legal_docs GROUP BY uid) WHERE regexp_matches(n, '^[0-9]{1,4}/[0-9]{4}/[A-ZĐa-z0-9-]+$')"""
)
def number_search(spark, sf):
    """Document numbers found in a sentence, and the fragments by which they are looked up."""
    d = docs(spark, sf, "doc_id").filter(F.col("doc_id").rlike(r"\A[0-9]{1,4}/[0-9]{4}/[A-ZĐa-z0-9-]+\z"))
    d = d.withColumn("found", text.doc_numbers(F.concat(F.lit("Căn cứ văn bản số "), "doc_id", F.lit(", và "), "doc_id", F.lit("; "))))
    return d.select("uid", F.upper("doc_id").alias("raw"), "found", F.get(text.number_patterns(F.get("found", F.lit(0))), F.lit(1)).alias("stem"))


@query(
    f"""SELECT p_partkey, list_filter(k, lambda x, i: list_position(list_transform(k, lambda y: lower(y)), lower(x)) = i) AS words, CASE WHEN 1790 + p_size * 7 BETWEEN 1800 AND 2100 THEN 1790 + p_size * 7 END::INT AS year FROM (
    SELECT p_partkey, p_size, list_filter(list_transform(string_split(p_name || ' Luật năm ' || p_type || ' ' || upper(p_name), ' '), lambda x: {STRIP('x')}), lambda x: length(x) > 1 AND lower(x) NOT IN ('luật', 'bộ luật', 'nghị định', 'nghị quyết', 'hiến pháp', 'năm')) AS k FROM part)"""
)
def search_keywords(spark, sf):
    p = read(spark, sf, "part")
    words = F.split(F.concat_ws(" ", "p_name", F.lit("Luật năm"), "p_type", F.upper("p_name")), " ")
    return p.select("p_partkey", text.keywords(words).alias("words"), text.year(1790 + F.col("p_size") * 7).cast("int").alias("year"))


@query(
    f"""SELECT uid, e AS numeric, e AS worded, NULL::DATE AS worded_as_observed, i AS promulgated, NULL::DATE AS silent FROM (SELECT uid, effective_date e, issue_date i FROM {TYPED_DOC})"""
)
def effective_dates(spark, sf):
    """The date of effect as texts tell it: in figures, in words, or as that of promulgation."""
    d = typed_docs(spark, sf)
    say = lambda t: F.concat(F.lit("Luật này "), t, F.lit("."))
    figures = F.concat(F.lit("có hiệu lực thi hành kể từ ngày "), F.date_format("effective_date", "d/M/yyyy"))
    words = F.concat(F.lit("có HIỆU LỰC từ ngày "), F.date_format("effective_date", "d"), F.lit(" tháng "), F.date_format("effective_date", "M"), F.lit(" năm "), F.date_format("effective_date", "yyyy"))
    i = F.col("issue_date")
    return d.select("uid", dates.effective_date(i, say(figures)).alias("numeric"), dates.effective_date(i, F.lit("x"), say(words), worded=True).alias("worded"), dates.effective_date(i, say(words)).alias("worded_as_observed"), dates.effective_date(i, F.lit("có hiệu lực kể từ ngày ban hành")).alias("promulgated"), dates.effective_date(i, F.lit("ban hành ngày 1/1/2020")).alias("silent"))


@query(f"SELECT uid, regexp_replace(coalesce(case_number, 'None'), '[^A-Z0-9]', '', 'g') AS number, CASE WHEN coalesce(issuance_date, '') = '' THEN '00000000' ELSE replace(issuance_date, '-', '') END AS day FROM {ONE_CASE}")
def case_uids(spark, sf):
    c = one_case(spark, sf, "case_number", "court_name", "issuance_date")
    made = F.split(ids.case_uid(F.col("case_number"), F.col("court_name"), F.col("issuance_date")), "-")
    return c.select("uid", F.element_at(made, 1).alias("number"), F.element_at(made, -1).alias("day"))


@query(f"SELECT uid, {STRIP('b')} AS bases FROM (SELECT uid, regexp_replace(coalesce(legal_bases, ''), '(?i)xử|xư', '', 'g') AS b FROM {ONE_CASE})")
def case_bases(spark, sf):
    """A round trip: what a decision says before the word of judgment."""
    c = one_case(spark, sf, "legal_bases").withColumn("b", F.regexp_replace(text._text("legal_bases"), "(?iu)xử|xư", ""))
    return c.select("uid", cases.legal_bases(F.concat(F.lit("QUYẾT ĐỊNH:\n"), "b", F.lit("\nXử: bác yêu cầu."))).alias("bases"))


@query(f"SELECT uid, {STRIP('facts')} AS facts FROM (SELECT uid, CASE WHEN length(t) >= 201 THEN t ELSE t || ' XÉT THẤY: không.' END AS facts FROM (SELECT uid, {STRIP('''replace(coalesce(section_content, ''), 'XÉT THẤY:', '')''')} AS t FROM {ONE_CASE}))")
def case_facts(spark, sf):
    """Facts of a case up to the marker of the reasoning, if that isn't among the first 200 characters."""
    c = one_case(spark, sf, "section_content").withColumn("t", text.strip(F.replace(text._text("section_content"), F.lit("XÉT THẤY:"), F.lit(""))))
    return c.select("uid", text.before_reasoning(F.concat("t", F.lit(" XÉT THẤY: không."))).alias("facts"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(p_brand || '/' || p_name, '[/\\\\]', '__', 'g'), '[: ]', '_', 'g') AS dir, regexp_replace(p_name, '[^\\p{L}\\p{N}]', '_', 'g') AS file FROM part")
def result_names(spark, sf):
    return read(spark, sf, "part").select("p_partkey", text.model_dir(F.concat_ws("/", "p_brand", "p_name")).alias("dir"), text.file_slug("p_name").alias("file"))


@query(f"SELECT uid, NOT regexp_matches(lower(coalesce(title, '')), 'dự thảo|dự kiến|góp ý') AND length(coalesce(doc_id, '')) >= 3 AND lower(coalesce(doc_id, '')) NOT IN ('đang cập nhật', 'chưa rõ') AS valid, regexp_matches(lower(coalesce(title, '')), 'án lệ|đính chính') AS rejected FROM {ONE_DOC}")
def valid_documents(spark, sf):
    return docs(spark, sf, "title", "doc_id").select("uid", text.is_valid_doc("title", "doc_id").alias("valid"), text.is_rejected_case_title("title").alias("rejected"))


# --- pages ---------------------------------------------------------------------------------------------------------------
def pages(spark, sf) -> DataFrame:
    """Pages made of the documents' fields."""
    d = docs(spark, sf, "doc_id", "title", "signer", "legal_field", "url")
    safe = lambda c: F.replace(F.replace(F.replace(text.spaces(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return d.withColumn("page", F.concat(
        F.lit("<html><body><h1>"), safe("title"), F.lit("</h1><div id='tomtat'><table><tr><td>Số hiệu:</td><td>"), safe("doc_id"), F.lit("<td>Lĩnh vực</td><td><a href='/x'>"), safe("legal_field"), F.lit("</a><a href='/y'>Khác</a></td></tr><tr><td>Người ký:<td>"), safe("signer"),
        F.lit("</table></div><div id='full'><p>"), safe("title"), F.lit("<p>hết</div><a href='/tai-file/"), "uid", F.lit(".pdf'>Tải PDF</a><a href='/ban-an/"), "uid", F.lit("'>x</a><a href='/luat-"), "uid", F.lit("-d1.html'>y</a></body></html>"),
    ))


@query(
    f"""SELECT uid, nullif({SPACES('doc_id')}, '') AS number, coalesce(nullif({SPACES('legal_field')}, '') || ', ', '') || 'Khác' AS field, nullif({SPACES('signer')}, '') AS signer, {SPACES('title')} AS heading, {SPACES('title')} || chr(10) || 'hết' AS body FROM {ONE_DOC}"""
)
def html_fields(spark, sf):
    p = pages(spark, sf).withColumn("f", html.fields("page", within="tomtat", pairs=True, anchors=("Lĩnh vực",)))
    return p.select("uid", F.col("f")["Số hiệu"].alias("number"), F.col("f")["Lĩnh vực"].alias("field"), F.col("f")["Người ký"].alias("signer"), html.heading("page").alias("heading"), html.element_text("page", "full").alias("body"))


@query(f"SELECT uid, 'https://h/tai-file/' || uid || '.pdf' AS pdf, ['https://h/ban-an/' || uid] AS cases, ['https://h/luat-' || uid || '-d1.html'] AS docs FROM {ONE_DOC}")
def html_links(spark, sf):
    p = pages(spark, sf).withColumn("l", html.links("page"))
    base = "https://h"
    return p.select("uid", F.get(F.filter(html.downloads(F.col("l"), base), lambda x: x["file_type"] == "pdf"), F.lit(0))["url"].alias("pdf"), html.case_links(F.col("l"), base).alias("cases"), html.doc_links(F.col("l"), base).alias("docs"))


@query(
    f"""SELECT uid, CASE WHEN trim(coalesce(signer, '')) <> '' THEN 'doc' WHEN length(title) >= 60 THEN 'pdf' WHEN length(raw_text) >= 60 THEN 'html' END AS source, length(raw_text) >= 3000 AS long_enough FROM {ONE_DOC}"""
)
def text_source(spark, sf):
    return docs(spark, sf, html.body_text(F.col("signer"), F.col("title"), F.col("raw_text"), 60)["format"].alias("source"), html.case_text(F.col("raw_text"), F.lit(None).cast("string"), 3000).isNotNull().alias("long_enough"))


# --- refinement ----------------------------------------------------------------------------------------------------------
@query()
def refined_documents(spark, sf):
    """Documents from raw records."""
    d = read(spark, sf, "legal_docs").select("uid", "url", "title", "raw_text", "doc_id", "doc_type", "issue_date", "issuing_body", "status", "summary", "scraped_at", text._text("summary").alias("o1"), text._text("status").alias("o2"))
    d = rel.upsert(None, d, "uid", ["status", "summary"], ["scraped_at", "o1", "o2"])  # of several crawls the last one's
    attrs = F.create_map(F.lit("Số hiệu"), F.col("doc_id"), F.lit("Loại văn bản"), F.col("doc_type"), F.lit("Ngày ban hành"), F.col("issue_date"), F.lit("Cơ quan ban hành"), F.col("issuing_body"), F.lit("Tình trạng hiệu lực"), F.col("status"))
    return documents.refine(d.select("url", F.col("title").alias("title_web"), "raw_text", "summary", attrs.alias("attrs")), True).drop("raw_text")


@query()
def refined_cases(spark, sf):
    """Cases from raw records."""
    c = read(spark, sf, "court_cases").dropDuplicates(["uid"])
    meta = F.create_map(F.lit("Số hiệu"), F.col("case_number"), F.lit("Tòa án xét xử"), F.col("court_name"), F.lit("Cấp xét xử"), F.col("court_level"), F.lit("Ngày ban hành"), F.col("issuance_date"))
    return cases.refine(c.select("url", "raw_text", meta.alias("metadata"))).drop("raw_text")


# --- candidate search ----------------------------------------------------------------------------------------------------
def numbered_searches(spark, sf) -> DataFrame:
    """A search for each item's document: its number and year, no type."""
    b = read(spark, sf, "bench_items").filter("refer_doc_id is not null").select("uid", "refer_doc_id")
    return b.select(F.col("uid").alias("search_id"), F.array(F.lit("tài sản"), F.lit("Giấy phép")).alias("keywords"), F.lit(None).cast("string").alias("doc_type"), F.regexp_extract("refer_doc_id", "/([0-9]{4})/", 1).try_cast("int").alias("year"), F.array(text.doc_number("refer_doc_id")).alias("doc_numbers"))


_N = "regexp_replace(replace(upper({x}), 'Đ', 'D'), '[^A-Z0-9]', '', 'g')"
_SEARCH = f"""WITH s AS (SELECT uid AS search_id, {_N.format(x='refer_doc_id')} AS n, try_cast(nullif(regexp_extract(refer_doc_id, '/([0-9]{{4}})/', 1), '') AS INT) AS y FROM bench_items WHERE refer_doc_id IS NOT NULL),
    d AS (SELECT uid, lower(title) AS title, issue_date, lower(doc_id) AS doc_id, coalesce({_N.format(x='doc_id')}, '') AS n FROM {TYPED_DOC}),
    e AS (SELECT s.search_id, s.y, s.n AS sn, d.* FROM s JOIN d ON contains(d.doc_id, lower(s.n)) OR (regexp_matches(s.n, '^[0-9]+[0-9]{{4}}[A-Z0-9]+$') AND contains(d.doc_id, regexp_replace(s.n, '^([0-9]+)([0-9]{{4}})([A-Z0-9]+)$', '\\1/\\2')))),
    w AS (SELECT s.search_id, s.y, s.n AS sn, d.* FROM s JOIN d ON contains(d.title, 'tài sản') OR contains(d.title, 'giấy phép') OR contains(d.doc_id, s.y::VARCHAR) WHERE s.search_id NOT IN (SELECT search_id FROM e)),
    p AS (SELECT *, row_number() OVER (PARTITION BY search_id ORDER BY issue_date DESC NULLS LAST, uid) AS r FROM (SELECT * FROM e UNION ALL SELECT * FROM w))
    SELECT search_id, uid, score, row_number() OVER (PARTITION BY search_id ORDER BY score DESC, issue_date ASC NULLS FIRST, uid)::INT AS rank FROM (SELECT search_id, uid, issue_date, (CASE WHEN points = 0 AND NOT any_reason THEN -10 ELSE points END)::INT AS score FROM (
    SELECT *, CASE WHEN sn = n THEN 120 WHEN n <> '' AND (contains(n, sn) OR contains(sn, n)) THEN 90 ELSE 0 END + CASE WHEN y = year(issue_date) THEN 40 WHEN y IS NOT NULL AND contains(n, y::VARCHAR) THEN 15 WHEN y <> year(issue_date) THEN -20 ELSE 0 END
    + CASE WHEN contains(title, 'tài sản') THEN 15 ELSE 0 END + CASE WHEN contains(title, 'giấy phép') THEN 15 ELSE 0 END AS points, TRUE AS any_reason FROM p WHERE r <= 300)) WHERE score > 0"""


@query(f"SELECT search_id, uid, score, rank FROM ({_SEARCH}) WHERE rank <= 5")
def candidate_search(spark, sf):
    return rel.search(typed_docs(spark, sf), numbered_searches(spark, sf)).select("search_id", "uid", "score", "rank")


@query(f"SELECT search_id, uid, 'score' AS how FROM (SELECT *, coalesce(lead(score) OVER (PARTITION BY search_id ORDER BY rank), 0) AS next FROM ({_SEARCH}) WHERE rank <= 5) WHERE rank = 1 AND score >= 160 AND score - next >= 50")
def candidate_gate(spark, sf):
    return rel.decide(rel.search(typed_docs(spark, sf), numbered_searches(spark, sf)))


# --- generators ----------------------------------------------------------------------------------------------------------
def _case(spark, sf) -> DataFrame:
    return one_case(spark, sf, "section_content", "section_reasoning", "section_decision", "legal_bases", "court_level", "title_parsed", "title_web", "legal_relation", "case_type")


@query(
    f"""SELECT 'bench_1_1_' || uid AS uid, uid AS refer_uid, 'case' AS refer_type, '{generators.ISSUE_QUESTION[0].replace("'", "''")}{chr(10).join(f"{i}. {x}" for i, x in enumerate(text.ISSUE_LABELS, 1))}{generators.ISSUE_QUESTION[1]}' || section_content || '{generators.ISSUE_QUESTION[2].replace("'", "''")}' AS question, (['{"', '".join(text.ISSUE_LABELS)}'])[1 + length(uid) % 15] AS answer
    FROM (SELECT uid, section_content, title FROM {ONE_CASE} WHERE section_content IS NOT NULL ORDER BY md5('0|' || uid), uid LIMIT 60) WHERE section_content <> '' AND title IS NOT NULL"""
)
def issue_items(spark, sf):
    """G1, with the number of a label as the model's answer."""
    c = _case(spark, sf)
    said = c.select("uid", F.concat((1 + F.char_length("uid") % 15).cast("string"), F.lit(". vì")).alias("completion"))
    return generators.issue_items(c, said, 60)


_SAID = """'Đây: {{"correct": "' || {0} || ' đúng", "distractors": ["' || {0} || ' a", "b", "c", "d"]}}'"""


def _said(key: str) -> Column:
    return F.concat(F.lit('Đây: {"correct": "'), F.col(key), F.lit(' đúng", "distractors": ["'), F.col(key), F.lit(' a", "b", "c", "d"]}'))


_SHUFFLED = "list_transform(list_sort(list_transform([{0} || ' a', 'b', 'c', {0} || ' đúng'], lambda x: md5({0} || '|' || x) || x)), lambda x: substr(x, 33))"


@query(f"SELECT 'bench_1_2_' || c.uid AS uid, c.uid AS refer_uid, {_SHUFFLED.format('c.uid')} AS options, c.uid || ' đúng' AS answer FROM (SELECT uid, title FROM {ONE_CASE} WHERE coalesce(section_content, '') <> '' AND coalesce(section_decision, '') <> '' ORDER BY md5('0|' || uid), uid LIMIT 60) c WHERE title IS NOT NULL")
def choice_items(spark, sf):
    """G2."""
    c = _case(spark, sf)
    return generators.choice_items(c, c.select("uid", _said("uid").alias("completion")), 60).select("uid", "refer_uid", "options", "answer")


@query(
    f"""SELECT 'bench_2_1_' || article_uid AS uid, article_uid AS refer_uid, d_doc_id AS refer_doc_id, 'article' AS refer_type, 'Khái niệm ' || article_number AS concept, 'Trong ' || name || ' (ban hành năm ' || y || '), khái niệm ''Khái niệm ' || article_number || ''' được định nghĩa như thế nào?{generators.DEFINITION_TAIL}' AS question, 'là một điều' AS answer
    FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('0|' || article_uid), article_uid) AS r FROM {_FEW} WHERE stratum IS NOT NULL AND length(article_uid) % 2 = 0) WHERE r <= CASE stratum WHEN 'Luật' THEN 80 WHEN 'Nghị định' THEN 18 ELSE 2 END"""
)
def definition_items(spark, sf):
    """G3, with a made-up definition in every other article."""
    a = articles(spark, sf)
    said = a.select("article_uid", F.when(F.char_length("article_uid") % 2 == 0, F.concat(F.lit('{"co": "co", "ten_khai_niem": "Khái niệm '), "article_number", F.lit('", "giai_thich": "là một điều"}'))).otherwise('{"co": "khong"}').alias("completion"))
    return generators.definition_items(a, typed_docs(spark, sf), said.distinct(), 100, least=4, margin=1)


@query(
    f"""SELECT 'bench_2_2_' || article_uid AS uid, article_uid AS refer_uid FROM (SELECT *, row_number() OVER (PARTITION BY doc_uid ORDER BY article_number, article_uid) AS r FROM {_CORE8} c WHERE EXISTS (SELECT 1 FROM legal_docs d WHERE d.uid = c.doc_uid)) WHERE r <= 5"""
)
def recall_item_ids(spark, sf):
    """G4 of all documents."""
    return generators.recall_items(articles(spark, sf), typed_docs(spark, sf), None).select("uid", "refer_uid")


@query(
    f"""WITH a AS (SELECT *, CASE WHEN regexp_matches({STRIP('article_number')}, '^[0-9]+[a-zA-Z]*$') THEN try_cast(regexp_extract(article_number, '([0-9]+)', 1) AS BIGINT) END AS n, lower(regexp_extract(article_number, '([a-zA-Z]*)$', 1)) AS s FROM {ONE_ARTICLE}),
    b AS (SELECT uid, lag(uid) OVER (PARTITION BY doc_type ORDER BY uid) AS original_uid FROM {TYPED_DOC}),
    r AS (SELECT a.*, b.original_uid, d.doc_id AS d_doc_id FROM a JOIN b ON b.uid = a.doc_uid JOIN {TYPED_DOC} d ON d.uid = a.doc_uid WHERE a.is_amendment AND b.original_uid IS NOT NULL AND b.original_uid <> a.doc_uid),
    o AS (SELECT r.article_uid, min(x.article_uid) AS original FROM r JOIN a x ON x.doc_uid = r.original_uid AND lower(x.article_number) = lower({STRIP('r.article_number')}) GROUP BY 1),
    nb AS (SELECT target, list('Điều ' || article_number || ' của ' || d_doc_id ORDER BY k) AS near FROM (SELECT t.article_uid AS target, t.d_doc_id, x.article_number, row_number() OVER (PARTITION BY t.article_uid ORDER BY CASE WHEN t.n IS NULL THEN 0 ELSE coalesce(abs(x.n - t.n), 10000) END, CASE WHEN t.n IS NULL THEN '' WHEN x.n IS NULL THEN x.article_number ELSE x.s END, x.article_uid) AS k
    FROM r t JOIN a x ON t.doc_uid = x.doc_uid AND t.article_uid <> x.article_uid) WHERE k <= 4 GROUP BY 1, d_doc_id),
    w AS (SELECT r.*, o.original, 'Điều ' || r.article_number || ' của ' || r.d_doc_id AS answer, list_distinct(list_filter(list_append(coalesce(near, []), '{generators.NOT_AMENDED}'), lambda x: x <> 'Điều ' || r.article_number || ' của ' || r.d_doc_id)) AS wrong FROM r JOIN o USING (article_uid) LEFT JOIN nb ON nb.target = r.article_uid),
    z AS (SELECT *, list_append(list_transform(list_sort(list_transform(wrong, lambda x: md5(article_uid || '|' || x) || x))[1:3], lambda x: substr(x, 33)), answer) AS four FROM w WHERE len(wrong) >= 3)
    SELECT 'bench_2_4_' || original || '_' || article_uid AS uid, original AS refer_uid, 'article' AS refer_type, article_uid AS amendment_article_id, 'Điều ' || {STRIP('article_number')} || ' của ''' || d.title || ' (' || {_YEAR} || ')'' được sửa đổi, bổ sung bởi điều khoản nào sau đây?{generators.PICK_TAIL}' AS question,
    list_transform(list_sort(list_transform(four, lambda x: md5(article_uid || '|' || x) || x)), lambda x: substr(x, 33)) AS options, answer FROM z JOIN {TYPED_DOC} d ON d.uid = z.original_uid"""
)
def amendment_items(spark, sf):
    """Each amending article taken to amend the article of its number in the document before."""
    a = articles(spark, sf)
    d = typed_docs(spark, sf)
    before = d.select("uid", F.lag("uid").over(rel.Window.partitionBy("doc_type").orderBy("uid")).alias("original_uid")).filter("original_uid is not null")
    resolved = a.filter("is_amendment").join(before, F.col("doc_uid") == F.col("uid")).select("article_uid", "original_uid", F.concat(F.lit("Điều "), "article_number").alias("original_number")).distinct()
    return generators.amendment_items(a, d, resolved)


@query(
    f"""SELECT 'bench_3_1_' || c.uid AS uid, n AS num_articles_found, {_SHUFFLED.format('c.uid')} AS options, c.uid || ' đúng' AS answer, section_reasoning AS explanation FROM {ONE_CASE} c JOIN (SELECT refer_uid, count(DISTINCT uid) AS n FROM bench_items GROUP BY 1) b ON b.refer_uid = c.uid
    WHERE coalesce(section_content, '') <> '' AND coalesce(legal_bases, '') <> '' AND contains(lower(court_level), 'sơ thẩm') AND length({STRIP('''coalesce(section_decision, '')''')}) >= 100 AND length({STRIP('''section_content''')}) >= 100"""
)
def application_items(spark, sf):
    """G8, the block of law made of the items on the case."""
    c = _case(spark, sf)
    b = read(spark, sf, "bench_items").groupBy(F.col("refer_uid").alias("case_uid")).agg(F.countDistinct("uid").alias("found"), F.min("question").alias("block")).filter("case_uid is not null")
    said = c.select(F.col("uid").alias("case_uid")).withColumn("completion", _said("case_uid"))
    return generators.application_items(c, b, said).select("uid", "num_articles_found", "options", "answer", "explanation")


@query(
    f"""SELECT doc_uid AS case_uid, '[Các điều luật liên quan]' || chr(10) || string_agg(chr(10) || 'Điều ' || article_number || ' — ' || coalesce(nullif(d.title, ''), d.doc_id) || ' (' || coalesce(year(d.issue_date)::VARCHAR, 'không xác định') || '):' || chr(10) || left(coalesce(content, ''), 1500), chr(10) ORDER BY a.article_uid) AS block
    FROM {ONE_ARTICLE} a JOIN {TYPED_DOC} d ON d.uid = a.doc_uid GROUP BY doc_uid"""
)
def legal_blocks(spark, sf):
    """The articles of each document as one block."""
    rows = generators.with_docs(articles(spark, sf), typed_docs(spark, sf))
    rows = rows.select(F.col("doc_uid").alias("case_uid"), F.col("article_uid").alias("position"), "article_number", "content", F.col("d_title").alias("title"), F.col("d_doc_id").alias("doc_id"), F.col("d_issue_date").alias("issue_date"))
    return generators.legal_block(rows)


@query(
    f"""SELECT b.uid, b.refer_uid, strip AS answer, ok AS is_correct, total AS judge_score, verdict AS is_acceptable FROM (SELECT uid, refer_uid, answer AS strip, TRUE AS ok, (length(uid) % 6)::DOUBLE AS total, length(uid) % 2 = 0 AS verdict FROM bench_items WHERE task_id = 'task_3_1' AND answer IS NOT NULL) b"""
)
def judged_items(spark, sf):
    """M8: answers as JSON with a judge's verdict in chatter."""
    b = read(spark, sf, "bench_items").filter("task_id = 'task_3_1' and answer is not null")
    said = F.concat(F.lit("Trả lời: "), F.to_json(F.struct(F.col("answer").alias("answer"), F.lit("vì").alias("explanation"))))
    judge = F.concat(F.lit("Chấm:\n"), F.to_json(F.struct((F.char_length("uid") % 6).alias("total_score"), (F.char_length("uid") % 2 == 0).alias("is_acceptable"))))
    s = scoring.judged(b.withColumns({"model_answer": said, "raw_judge_output": judge}))
    return s.select("uid", "refer_uid", F.col("model_answer").alias("answer"), "is_correct", "judge_score", F.col("judge_result.is_acceptable").alias("is_acceptable"))


@query("SELECT uid, task_id FROM bench_items WHERE right(uid, 1) IN ('1', '3', '5', '7', '9')")
def not_yet_scored(spark, sf):
    b = read(spark, sf, "bench_items").select("uid", "task_id", F.lit("m").alias("model"))
    return scoring.not_scored(b, b.filter(~F.right("uid", F.lit(1)).isin(*"13579"))).select("uid", "task_id")


@query("WITH t AS (SELECT DISTINCT p_brand AS topic, p_type AS keyword FROM part), n AS (SELECT count(DISTINCT topic) + 1 AS n FROM t), k AS (SELECT topic, count(*) AS k FROM t GROUP BY 1) SELECT topic, keyword, (300 // n) // k AS quota FROM t JOIN k USING (topic), n")
def crawl_quota(spark, sf):
    return rel.crawl_quota(read(spark, sf, "part").select(F.col("p_brand").alias("topic"), F.col("p_type").alias("keyword")).distinct(), 300)
