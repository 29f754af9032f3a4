"""Benchmark items from the tables (G1-G9). Where a model is asked, the prompt is a column, its completions come as a table or by a function per batch, and the rest is a plan again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from vanquarry.functions import text
from vanquarry.operators import prompts
from vanquarry.operators import relational as rel

# What the questions of the items say around their content.
ISSUE_QUESTION = ("Đọc tình huống pháp lý dưới đây và xác định nó thuộc lĩnh vực pháp lý nào trong danh sách 15 nhãn sau.\n\nDanh sách nhãn:\n", "\n\nTình huống:\n", "\n\nYêu cầu: Chỉ trả về đúng tên nhãn phù hợp nhất (ví dụ: 'Hôn nhân và Gia đình').")
CHOICE_QUESTION = ("Đọc tình huống pháp lý dưới đây và chọn vấn đề pháp lý cốt lõi đúng nhất.\n\nTình huống:\n", "\n\nVấn đề pháp lý cốt lõi là gì?")
DEFINITION_TAIL = "\n\nYêu cầu: Chỉ trả lời bằng nội dung định nghĩa, trích nguyên văn từ luật, không thêm lời giải thích hay mở đầu."
PICK_TAIL = "\n\nChọn đáp án đúng (chỉ trả về nội dung đáp án):"
APPLICATION_TAIL = "\n\nCâu hỏi: Dựa trên tình tiết vụ án và các điều luật được cung cấp, Tòa án đã đưa ra quyết định như thế nào?\n\nYêu cầu: Chỉ trả về nội dung đáp án đúng."
UNKNOWN_YEAR, NOT_AMENDED = "không xác định", "Chưa được sửa đổi, bổ sung"
SPECIAL = "HP2013"


def complete(asked: DataFrame, ask: Callable[[str], str], errors: str = "blank") -> DataFrame:
    """Adds completion and latency_sec to asked(prompt, ...), asking batch by batch in the tasks; an error gives '' or, with errors="raise", ends the job."""
    import time

    if errors not in ("blank", "raise"):
        raise ValueError(errors)
    schema = StructType([*asked.schema.fields, StructField("completion", StringType()), StructField("latency_sec", DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            answers, took = [], []
            for p in b["prompt"]:
                began = time.perf_counter()
                try:
                    answers.append(ask(p))
                except Exception:
                    if errors == "raise":
                        raise
                    answers.append("")
                took.append(time.perf_counter() - began)
            yield b.assign(completion=answers, latency_sec=took)

    return asked.mapInPandas(run, schema)


def respond(items: DataFrame, ask: Callable[[str], str], model: str, limit: int = 0, order: str = "uid", evaluated_at: str | None = None) -> DataFrame:
    """The response rows of a model to items(uid, task_id, question, options, ...), the first `limit` (R35): answer and raw output (stripped), latency to four places, time; errors of the model end the job."""
    rows = rel.head(items, limit, order)
    asked = rows.withColumn("prompt", text.prompt(F.col("task_id"), F.col("question"), F.col("options")))
    answer = text.strip(text._text("completion"))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if evaluated_at is None else F.lit(evaluated_at)
    out = complete(asked, ask, "raise").withColumns({"model": F.lit(model), "model_answer": answer, "raw_model_output": answer, "latency_sec": F.round("latency_sec", 4), "evaluated_at": now})
    return out.drop("prompt", "completion")


def year_of(c) -> Column:
    return F.coalesce(F.year(c).cast("string"), F.lit(UNKNOWN_YEAR))


def with_docs(articles: DataFrame, docs: DataFrame) -> DataFrame:
    """Articles with their document's columns d_*, one join by document."""
    return articles.join(docs.select(F.col("uid").alias("doc_uid"), *[F.col(c).alias(f"d_{c}") for c in docs.columns if c != "uid"]), "doc_uid")


def strata(articles: DataFrame, docs: DataFrame, least: int = 8, margin: int = 2) -> DataFrame:
    """Core articles with their documents and the stratum that they are drawn from."""
    special = (F.col("doc_uid") == SPECIAL) | (F.col("d_doc_id") == SPECIAL)
    kind = F.when(special, "special").when(F.col("d_doc_type").isin("Luật", "Nghị định"), F.col("d_doc_type"))
    return with_docs(rel.core_articles(articles, least, margin), docs).withColumn("stratum", kind).filter("stratum is not null")


def case_title() -> Column:
    return F.coalesce(F.nullif(F.col("title_parsed"), F.lit("")), F.nullif(F.col("title_web"), F.lit("")))


def issue_prompts(cases: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """G1: the cases of a sample, with their prompt; those without title or content are left out."""
    rows = rel.sample(cases.filter("section_content is not null"), "uid", n, seed).filter(case_title().isNotNull() & (F.col("section_content") != ""))
    return rows.withColumn("prompt", prompts.issue(case_title(), F.col("legal_relation"), F.col("case_type")))


def issue_items(cases: DataFrame, completions: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """G1: cases of a sample with the issue label that the model (completions: uid, completion) names."""
    rows = issue_prompts(cases, n, seed).join(completions, "uid")
    before, between, after = map(F.lit, ISSUE_QUESTION)
    question = F.concat(before, prompts.numbered_labels(), between, "section_content", after)
    return rows.select(F.concat(F.lit("bench_1_1_"), "uid").alias("uid"), F.col("uid").alias("refer_uid"), F.lit("case").alias("refer_type"), question.alias("question"), text.issue_label("completion").alias("answer"))


def choice_prompts(cases: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """The cases of a sample that have content and decision, with their prompt; those without title are left out."""
    rows = rel.sample(cases.filter((text._text("section_content") != "") & (text._text("section_decision") != "")), "uid", n, seed).filter(case_title().isNotNull())
    return rows.withColumn("prompt", prompts.choice(case_title(), F.col("section_decision")))


def choice_items(cases: DataFrame, completions: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Cases with the options of the model's JSON (correct, distractors), in seeded order; unreadable or too few are left out."""
    v = F.from_json(text.json_object("completion"), "correct string, distractors array<string>")
    rows = choice_prompts(cases, n, seed).join(completions, "uid").withColumn("v", v)
    # the key has a name of its own: within a function over an array, "uid" would be taken for the new column of that name
    answer = text.strip(text._text("v.correct"))
    rows = rows.filter((answer != "") & (F.size("v.distractors") >= 3)).withColumn("_key", F.col("uid"))
    options = F.concat(F.slice("v.distractors", 1, 3), F.array(answer))
    question = F.concat(F.lit(CHOICE_QUESTION[0]), text.before_reasoning("section_content"), F.lit(CHOICE_QUESTION[1]))
    return rows.select(F.concat(F.lit("bench_1_2_"), "uid").alias("uid"), F.col("uid").alias("refer_uid"), F.lit("case").alias("refer_type"), question.alias("question"), rel.shuffled(options, F.col("_key")).alias("options"), answer.alias("answer"))


def definition_prompts(articles: DataFrame, docs: DataFrame, **core: int) -> DataFrame:
    """The core articles of the strata, with their prompt."""
    name = F.coalesce(F.nullif(F.col("d_title"), F.lit("")), "d_doc_id")
    return strata(articles, docs, **core).withColumn("prompt", prompts.definition(F.col("article_number"), F.col("title"), name, year_of("d_issue_date"), F.col("content")))


def definition_items(articles: DataFrame, docs: DataFrame, completions: DataFrame, n: int, seed: int = 0, **core: int) -> DataFrame:
    """The first articles, in seeded order and by the quota of each stratum, in which the model (completions: article_uid, completion) found a definition. With completions given, filling up to the quota is a filter and a rank."""
    v = F.from_json(text.json_object("completion"), "co string, ten_khai_niem string, giai_thich string")
    rows = strata(articles, docs, **core).join(completions, "article_uid").withColumn("v", v).withColumns({"concept": text.strip(text._text("v.ten_khai_niem")), "answer": text.strip(text._text("v.giai_thich"))})
    rows = rel.stratified(rows.filter("v.co = 'co' and concept <> '' and answer <> ''"), "stratum", "article_uid", rel.quotas(n), seed)
    name = F.coalesce(F.nullif(F.col("d_title"), F.lit("")), "d_doc_id")
    question = F.format_string("Trong %s (ban hành năm %s), khái niệm '%s' được định nghĩa như thế nào?", name, year_of("d_issue_date"), "concept")
    return rows.select(F.concat(F.lit("bench_2_1_"), "article_uid").alias("uid"), F.col("article_uid").alias("refer_uid"), F.col("d_doc_id").alias("refer_doc_id"), F.lit("article").alias("refer_type"), "concept", F.concat(question, F.lit(DEFINITION_TAIL)).alias("question"), "answer")


def recall_items(articles: DataFrame, docs: DataFrame, n: int | None, seed: int = 0) -> DataFrame:
    """Articles to be recalled, n by strata, or of every document up to five (R23); the answer is the plain text."""
    rows = with_docs(rel.core_articles(articles), docs)
    rows = rel.per_group(rows, "doc_uid", [F.col("article_number"), F.col("article_uid")], 5) if n is None else rel.stratified(strata(articles, docs), "stratum", "article_uid", rel.quotas(n), seed)
    question = F.format_string("Hãy cho biết nội dung của Điều %s của %s (%s).", "article_number", F.coalesce(F.nullif(F.col("d_title"), F.lit("")), "d_doc_id"), year_of("d_issue_date"))
    return rows.select(F.concat(F.lit("bench_2_2_"), "article_uid").alias("uid"), F.col("article_uid").alias("refer_uid"), F.lit("article").alias("refer_type"), question.alias("question"), text.legal_plain("content").alias("answer")).filter("answer <> ''")


def metadata_items(articles: DataFrame, docs: DataFrame, n: int, seed: int = 0, **core: int) -> DataFrame:
    """Half the items ask for the source of an excerpt (number or article, by a seeded coin), the rest for a document's date or signer."""
    half = n // 2
    dated = (n - half) // 2
    core = rel.sample(strata(articles, docs, **core).withColumn("excerpt", text.excerpt("content")).filter("excerpt <> '' and d_doc_id is not null"), "article_uid", half, seed)
    coin = F.substring(rel.seeded(F.col("article_uid"), f"coin{seed}"), 1, 1) < "8"
    item = lambda kind, key, q, a: [F.concat(F.lit("bench_2_3_"), kind, F.lit("_"), key).alias("uid"), F.col(key).alias("refer_uid"), q.alias("question"), a.alias("answer")]
    quote = F.format_string('Đoạn trích dưới đây thuộc văn bản nào?\n\n"%s"', "excerpt")
    a = core.select(*item(F.when(coin, "docid").otherwise("article"), "article_uid", quote, F.when(coin, F.col("d_doc_id")).otherwise(text.article_label("article_number", "d_doc_id"))), F.lit("article").alias("refer_type"))
    d = docs.filter("doc_id is not null")
    b = rel.sample(d.filter("effective_date is not null"), "uid", dated, f"date{seed}").select(*item(F.lit("effective"), "uid", F.format_string("Văn bản số %s có hiệu lực từ ngày nào?", "doc_id"), F.date_format("effective_date", "dd/MM/yyyy")), F.lit("doc").alias("refer_type"))
    c = rel.sample(d.filter(text._text("signer") != ""), "uid", n - half - dated, f"signer{seed}").select(*item(F.lit("signer"), "uid", F.format_string("Ai ký văn bản số %s?", "doc_id"), F.col("signer")), F.lit("doc").alias("refer_type"))
    return rel.together([a, b, c], n, "uid", seed)


def field_items(articles: DataFrame, docs: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """N articles asked by their field of law, with one seeded article of each of three other fields as distractors.

    Fields are ranked once; the k-th item takes the k-th field in turn and the articles of the next three fields with other labels,
    so no pair of an article and all others is ever formed. Fewer than four fields, or labels, give no items.
    """
    rows = with_docs(rel.core_articles(articles), docs).withColumns({"field": text.clean_field("d_legal_field"), "label": text.article_label("article_number", "d_doc_id")}).filter("field is not null and d_doc_id is not null")
    rows = rows.select("field", "article_uid", "label").withColumn("r", F.row_number().over(Window.partitionBy("field").orderBy(rel.seeded(F.col("article_uid"), seed), "article_uid")))
    fields = rows.groupBy("field").agg(F.count("*").alias("size"))
    order = fields.withColumn("f", F.row_number().over(Window.orderBy(rel.seeded(F.col("field"), seed), "field"))).withColumn("fields", F.count("*").over(Window.partitionBy()))
    items = order.filter("fields >= 4").withColumn("k", F.explode(F.expr(f"filter(transform(sequence(0, {max(n, 1)} div fields), j -> j * cast(fields as int) + f), k -> k <= {n})")))
    # the k-th item meets the article of every field whose turn it is there; fields are few, items as many as asked for
    turns = items.select("k", "fields", F.explode(F.expr("sequence(0, cast(fields as int) - 1)")).alias("shift"), F.col("f").alias("first")).withColumn("g", F.pmod(F.col("first") - 1 + F.col("shift"), F.col("fields")))
    turns = turns.join(order.select((F.col("f") - 1).alias("g"), "field", "size"), "g").withColumn("r", (F.pmod(F.floor((F.col("k") - 1) / F.col("fields")) + F.col("shift"), F.col("size")) + 1).cast("int"))
    met = turns.join(rows, ["field", "r"]).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("shift", "field", "article_uid", "label"))).alias("met"))
    # the first three other fields whose labels differ from those taken before; a label that clashes is passed over for the next field's
    labels = F.slice(F.array_distinct(F.transform("met", lambda x: x["label"])), 1, 4)
    made = met.select("k", F.element_at("met", 1).alias("c"), labels.alias("labels")).filter("size(labels) = 4")
    question = F.format_string("Điều khoản nào dưới đây liên quan trực tiếp nhất đến chủ đề pháp lý: '%s'?", "c.field")
    return made.select(F.concat(F.lit("bench_2_6_"), "c.article_uid").alias("uid"), F.col("c.article_uid").alias("refer_uid"), F.lit("article").alias("refer_type"), F.col("c.field").alias("legal_field"), F.concat(question, F.lit(PICK_TAIL)).alias("question"), rel.shuffled(F.col("labels"), F.col("c.article_uid")).alias("options"), F.col("c.label").alias("answer"))


def amendment_items(articles: DataFrame, docs: DataFrame, resolved: DataFrame) -> DataFrame:
    """resolved(article_uid, original_uid, original_number) says what an amending article amends; options are the article, its neighbours and "not amended"; at least three distractors, and no document amends itself."""
    a = with_docs(articles.filter("is_amendment"), docs).join(resolved, "article_uid").filter("doc_uid <> original_uid").withColumn("answer", text.answer_label("article_number", "d_doc_id"))
    refs = a.select("article_uid", F.col("original_uid").alias("doc_uid"), F.col("original_number").alias("article_number")).withColumnRenamed("article_uid", "by")
    original = rel.first_article(refs, articles).select(F.col("by").alias("article_uid"), F.col("article_uid").alias("original_article"), text.clean_article_number("article_number").alias("number"))
    near = rel.neighbours(articles, a, 4).select(F.col("target").alias("article_uid"), F.col("article_number").alias("near"), "rank")
    near = near.groupBy("article_uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "near"))), lambda x: x["near"]).alias("near"))
    rows = a.join(original, "article_uid").join(near, "article_uid", "left")
    wrong = F.array_distinct(F.concat(F.transform(F.coalesce("near", F.array().cast("array<string>")), lambda x: text.answer_label(x, F.col("d_doc_id"))), F.array(F.lit(NOT_AMENDED))))
    rows = rows.withColumn("wrong", F.array_remove(wrong, F.col("answer"))).filter("size(wrong) >= 3")
    title = docs.select(F.col("uid").alias("original_uid"), F.format_string("%s (%s)", "title", year_of("issue_date")).alias("original_title"))
    options = rel.shuffled(F.concat(F.slice(rel.shuffled(F.col("wrong"), F.col("article_uid")), 1, 3), F.array("answer")), F.col("article_uid"))
    question = F.format_string("Điều %s của '%s' được sửa đổi, bổ sung bởi điều khoản nào sau đây?", "number", "original_title")
    return rows.join(title, "original_uid").select(F.concat_ws("_", F.lit("bench_2_4"), "original_article", "article_uid").alias("uid"), F.col("original_article").alias("refer_uid"), F.lit("article").alias("refer_type"), F.col("article_uid").alias("amendment_article_id"), F.concat(question, F.lit(PICK_TAIL)).alias("question"), options.alias("options"), "answer")


REFERENCES = "refs array<struct<title_keywords:array<string>,doc_type:string,year:string,doc_id:string,article_numbers:array<string>>>"
ORIGINAL = "original_article_number string, search_hint string, title_keywords array<string>, doc_type string, year string, doc_id string"


def reference_prompts(cases: DataFrame) -> DataFrame:
    """(case_uid, prompt) of the cases of first instance that cite their bases."""
    return application_cases(cases).select(F.col("uid").alias("case_uid"), prompts.references(F.col("legal_bases")).alias("prompt"))


def references(completions: DataFrame) -> DataFrame:
    """(case_uid, position, title_keywords, doc_type, year, doc_id, article_numbers) of the model's lists, completions(case_uid, completion); references without keywords or articles are left out."""
    v = F.from_json(text.json_object("completion"), REFERENCES)
    rows = completions.select("case_uid", F.posexplode(v["refs"]).alias("position", "x")).select("case_uid", "position", "x.*")
    return rows.filter("size(title_keywords) > 0 and size(article_numbers) > 0")


def searches(refs: DataFrame, search_id: Column, hint: Column) -> DataFrame:
    """The parameters of `rel.search` of references(title_keywords, doc_type, year, doc_id), in normal form, with the numbers that the hint holds; those without any are left out (they need a model's reading first, `prompts.search`)."""
    own = text.doc_number("doc_id")
    numbers = F.array_distinct(F.concat(F.when(own != "", F.array(own)).otherwise(F.array().cast("array<string>")), text.doc_numbers(hint)))
    rows = refs.select(search_id.alias("search_id"), text.keywords(F.col("title_keywords")).alias("keywords"), text.doc_type("doc_type").alias("doc_type"), text.year("year").alias("year"), numbers.alias("doc_numbers"), own.alias("_own"))
    return rows.filter("size(keywords) > 0 or doc_type is not null or year is not null or coalesce(_own, '') <> ''").drop("_own")


def reference_id() -> Column:
    return F.concat_ws("#", "case_uid", "position")


def resolve(refs: DataFrame, docs: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """(case_uid, position, doc_uid, article_numbers) of the references whose document is found, by score or by the model's choice (chosen: search_id, uid)."""
    ranked = rel.search(docs, searches(refs, reference_id(), F.array_join("title_keywords", " ")))
    found = rel.decide(ranked, chosen).select("search_id", F.col("uid").alias("doc_uid"))
    return refs.withColumn("search_id", reference_id()).join(found, "search_id").select("case_uid", "position", "doc_uid", "article_numbers")


def cited_articles(resolved: DataFrame, articles: DataFrame) -> DataFrame:
    """(case_uid, position, doc_uid, article_number, article_uid, content) of the cited articles, each once per case, in the order of citation."""
    rows = resolved.select("case_uid", "doc_uid", F.col("position").alias("_ref"), F.posexplode("article_numbers").alias("_nth", "article_number"))
    found = rel.first_article(rows, articles).withColumn("article_number", text.clean_article_number("article_number"))
    first = found.groupBy("case_uid", "article_uid").agg(F.min_by(F.struct("doc_uid", "article_number", "content", "_ref", "_nth"), F.struct("_ref", "_nth")).alias("x"))
    return first.select("case_uid", F.struct("x._ref", "x._nth").alias("position"), "x.doc_uid", "x.article_number", "article_uid", "x.content")


def application_blocks(refs: DataFrame, articles: DataFrame, docs: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """(case_uid, block, found) of the cases all of whose articles cited from known documents are found."""
    resolved = resolve(refs, docs, chosen)
    cited = cited_articles(resolved, articles)
    expected = resolved.groupBy("case_uid").agg(F.sum(F.size("article_numbers")).alias("expected"))
    whole = cited.groupBy("case_uid").agg(F.count("*").alias("found")).join(expected, "case_uid").filter("found >= expected").select("case_uid", "found")
    d = docs.select(F.col("uid").alias("doc_uid"), "title", "doc_id", "issue_date")
    return legal_block(cited.join(whole, "case_uid", "left_semi").join(d, "doc_uid")).join(whole, "case_uid")


def decision_prompts(cases: DataFrame, blocks: DataFrame) -> DataFrame:
    """(case_uid, prompt) of the cases with all their articles."""
    rows = application_cases(cases).withColumnRenamed("uid", "case_uid").join(blocks, "case_uid")
    return rows.select("case_uid", prompts.decision(F.col("section_decision"), F.col("block")).alias("prompt"))


def amendment_prompts(articles: DataFrame, n: int | None = None, seed: int = 0) -> DataFrame:
    """Amending articles (a sample) with their prompt."""
    rows = articles.filter("is_amendment")
    return (rows if n is None else rel.sample(rows, "article_uid", n, seed)).withColumn("prompt", prompts.amendment(F.col("content")))


def originals(articles: DataFrame, docs: DataFrame, completions: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """resolved(article_uid, original_uid, original_number): what the model (completions: article_uid, completion) says that an article amends, with the document searched by that and by the numbers in the article."""
    v = F.from_json(text.json_object("completion"), ORIGINAL)
    rows = articles.select("article_uid", "content").join(completions.select("article_uid", v.alias("v")), "article_uid").select("article_uid", "content", "v.*")
    rows = rows.withColumn("original_number", text.clean_article_number("original_article_number")).filter("original_number <> ''")
    ranked = rel.search(docs, searches(rows, F.col("article_uid"), text.left_part(F.col("content"), 1200)))
    found = rel.decide(ranked, chosen).select(F.col("search_id").alias("article_uid"), F.col("uid").alias("original_uid"))
    return rows.join(found, "article_uid").select("article_uid", "original_uid", "original_number")


def legal_block(rows: DataFrame, case: str = "case_uid") -> DataFrame:
    """(case, block): the articles cited in a case, rows(case, position, article_number, content, title, doc_id, issue_date), as one text."""
    head = F.format_string("\nĐiều %s — %s (%s):", "article_number", F.coalesce(F.nullif(F.col("title"), F.lit("")), "doc_id"), year_of("issue_date"))
    line = F.concat(head, F.lit("\n"), text.left_part(text._text("content"), 1500))
    block = F.transform(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))), lambda x: x["line"])
    return rows.groupBy(case).agg(F.concat(F.lit("[Các điều luật liên quan]\n"), F.array_join(block, "\n")).alias("block"))


def application_cases(cases: DataFrame) -> DataFrame:
    """Cases of first instance with content, bases and a decision of 100 characters or more."""
    return cases.filter((text._text("section_content") != "") & (text._text("legal_bases") != "") & F.col("court_level").ilike("%sơ thẩm%") & (F.char_length(text.strip(text._text("section_decision"))) >= 100))


def application_items(cases: DataFrame, blocks: DataFrame, completions: DataFrame, n: int | None = None) -> DataFrame:
    """Cases of first instance with all cited articles (blocks: case_uid, block, found), options from the model's JSON (completions: case_uid, completion), by uid."""
    v = F.from_json(text.json_object("completion"), "correct string, distractors array<string>")
    rows = application_cases(cases).withColumn("facts", text.before_reasoning("section_content")).filter(F.char_length("facts") >= 100).withColumnRenamed("uid", "case_uid")
    rows = rows.join(blocks, "case_uid").join(completions, "case_uid").withColumn("v", v).filter((text.strip(text._text("v.correct")) != "") & (F.size("v.distractors") >= 3))
    answer = text.strip(F.col("v.correct"))
    out = rows.select(
        F.concat(F.lit("bench_3_1_"), "case_uid").alias("uid"), F.col("case_uid").alias("refer_uid"), F.lit("case").alias("refer_type"), F.col("found").alias("num_articles_found"),
        F.concat(F.lit("[Tình tiết vụ án]\n"), "facts", F.lit("\n\n"), "block", F.lit(APPLICATION_TAIL)).alias("question"),
        rel.shuffled(F.concat(F.slice("v.distractors", 1, 3), F.array(answer)), F.col("case_uid")).alias("options"), answer.alias("answer"), F.col("section_reasoning").alias("explanation"),
    )
    return out if n is None else out.orderBy("refer_uid").limit(n)
