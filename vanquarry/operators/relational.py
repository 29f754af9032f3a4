"""Relational operators: upsert, validation, samples, neighbours (R1-R7, R10-R11, R14-R27, R33-R36). All by window and join, none by key-wise lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanquarry.functions import text

UPDATED = {
    "legal_docs": ("title", "doc_type", "issuing_body", "legal_field", "is_amendment", "signer", "issue_date", "effective_date", "status", "summary", "download_links", "url", "raw_text"),
    "legal_articles": ("title", "content", "is_amendment"),
    "court_cases": ("issuance_date", "title_parsed", "legal_bases", "raw_text", "section_introduction", "section_content", "section_reasoning", "section_decision"),
}


def upsert(target: DataFrame | None, source: DataFrame, key: str, updated: tuple[str, ...] | list[str], order: list[str]) -> DataFrame:
    """One row per key. Columns in `updated` come from the last source row by order, others from the target's row, else from the first source row.

    One aggregation of the source by key (with map-side combine) and one join by the same key; rows with a null key are dropped.
    """
    source = source.filter(F.col(key).isNotNull())
    rank = F.struct(*order)
    last = [F.max_by(F.struct(*updated), rank).alias("new")]
    frozen = [c for c in source.columns if c not in updated and c != key and c not in order]
    first = [F.min_by(F.struct(*frozen), rank).alias("old")] if frozen else []
    merged = source.groupBy(key).agg(*last, *first).select(key, *[F.col(f"old.{c}").alias(c) for c in frozen], *[F.col(f"new.{c}").alias(c) for c in updated])
    if target is None:
        return merged
    t, s = target.alias("t"), merged.withColumn("_in", F.lit(True)).alias("s")
    keep = [F.coalesce(F.col(f"t.{key}"), F.col(f"s.{key}")).alias(key)]
    for c in target.columns:
        if c != key:
            old, new = F.col(f"t.{c}"), F.col(f"s.{c}") if c in merged.columns else F.lit(None)
            take = F.col("s._in").isNotNull() if c in updated else F.col(f"t.{key}").isNull()
            keep.append(F.when(take, new).otherwise(old).alias(c))
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(*keep)


def required(df: DataFrame, present: list[str] = (), not_blank: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows by fields that must not be null or '', or not blank."""
    ok = F.lit(True)
    for c in present:
        ok &= text._text(c) != ""
    for c in not_blank:
        ok &= text.strip(text._text(c)) != ""
    return df.filter(ok), df.filter(~ok)


def with_parent(df: DataFrame, parent: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose parent exists."""
    return df.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_semi")


def excluding(df: DataFrame, done: DataFrame, column: str) -> DataFrame:
    """Rows whose id isn't among those done."""
    return df.join(done.select(column).distinct(), column, "left_anti")


def alias_keys(*names: str, missing: str = "unknown") -> Column:
    """The first of several columns that isn't null or ''; the word for missing becomes null."""
    return F.nullif(F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names]), F.lit(missing))


def any_like(columns: list[str], patterns: Column) -> Column:
    """Any column contains any of the patterns, in any case."""
    whole = F.lower(F.concat_ws("\n", *columns))
    return F.exists(patterns, lambda p: whole.contains(F.lower(p)))


def seeded(key: Column, seed: int | str = 0) -> Column:
    """An order that looks random but is the same each time and everywhere."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def sample(df: DataFrame, key: str, n: int, seed: int | str = 0) -> DataFrame:
    """N rows in seeded order."""
    return df.orderBy(seeded(F.col(key), seed), key).limit(n)


def shuffled(options: Column, key: Column) -> Column:
    """An array in an order seeded by key, the same everywhere."""
    tagged = F.transform(options, lambda x: F.struct(F.md5(F.concat_ws("|", key, x)).alias("h"), x.alias("x")))
    return F.transform(F.array_sort(tagged), lambda s: s["x"])


def long_enough(content: str | Column = "content", length: int = 80) -> Column:
    return F.char_length(text.strip(text._text(content))) >= length


def core_articles(articles: DataFrame, least: int = 8, margin: int = 2, long: Column | None = None) -> DataFrame:
    """Articles of enough text (`long`, by default told from the content) that are neither among the first nor the last of a document with enough of them; one aggregation and a join instead of a query per article."""
    n = text.article_int("article_number")
    bounds = articles.groupBy("doc_uid").agg(F.min(n).alias("_lo"), F.max(n).alias("_hi"))
    rows = articles.withColumn("_n", n).filter(long_enough() if long is None else long).join(bounds, "doc_uid")
    return rows.filter((F.col("_hi") - F.col("_lo") + 1 >= least) & F.col("_n").between(F.col("_lo") + margin, F.col("_hi") - margin)).drop("_n", "_lo", "_hi")


def quotas(n: int) -> dict[str, int]:
    """Shares of the strata, the remainder going to the last."""
    laws, decrees = int(n * 0.8), int(n * 0.18)
    return {"Luật": laws, "Nghị định": decrees, "special": n - laws - decrees}


def stratified(df: DataFrame, stratum: str, key: str, quota: dict[str, int], seed: int | str = 0) -> DataFrame:
    """Of each stratum its quota of rows in seeded order (top rows per group, pre-limited within each partition by Spark)."""
    allowed = F.create_map(*[F.lit(x) for kv in quota.items() for x in kv])
    w = Window.partitionBy(stratum).orderBy(seeded(F.col(key), seed), key)
    return df.filter(F.col(stratum).isin(*quota)).withColumn("_row", F.row_number().over(w)).filter(F.col("_row") <= max(quota.values())).filter(F.col("_row") <= allowed[F.col(stratum)]).drop("_row")


def per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("_row", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_row") <= n).drop("_row")


def first_article(refs: DataFrame, articles: DataFrame) -> DataFrame:
    """refs(doc_uid, article_number, ...) with the article of that number in any case, the least article_uid if several."""
    a = articles.withColumn("_k", F.lower("article_number")).groupBy("doc_uid", "_k").agg(F.min_by(F.struct("article_uid", "content"), "article_uid").alias("a"))
    return refs.withColumn("_k", F.lower(text.clean_article_number("article_number"))).join(a, ["doc_uid", "_k"]).select(*[c for c in refs.columns], "a.article_uid", "a.content")


def neighbours(articles: DataFrame, targets: DataFrame, n: int = 3) -> DataFrame:
    """For each target(article_uid) the n articles of its document that are nearest by number, then by suffix; unreadable numbers last.

    Candidates of an article are the n next ones upward and downward by number, the first of its own number and the first with
    unreadable numbers: frames of n rows and groups cut to n + 1 rows, never all pairs of a document. A target with an
    unreadable number has its document's first articles by id.
    """
    a = articles.select("doc_uid", "article_uid", "article_number", text.article_value("article_number").alias("v")).withColumns({"number": F.col("v.number"), "suffix": F.coalesce(F.col("v.suffix"), F.col("article_number"))}).drop("v")
    x = F.struct("number", "suffix", "article_uid", "article_number")
    readable = F.col("number").isNotNull()
    group = Window.partitionBy("doc_uid", readable)
    tie = ["suffix", "article_uid"]
    near = lambda w: F.collect_list(x).over(w.rowsBetween(1, n))
    rows = a.withColumn("up", near(group.orderBy("number", *tie))).withColumn("down", near(group.orderBy(F.desc("number"), *tie)))

    def first(keys: list[str], order: list[str], name: str) -> DataFrame:
        cut = a.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n + 1)
        return cut.groupBy(*keys).agg(F.collect_list(x).alias(name))

    same = first(["doc_uid", "number"], tie, "same").filter(readable)
    odd = first(["doc_uid", "number"], tie, "odd").filter(~readable).drop("number")
    head = first(["doc_uid"], ["article_uid"], "head")
    rows = rows.join(targets.select("article_uid").distinct(), "article_uid", "left_semi").join(same, ["doc_uid", "number"], "left").join(odd, "doc_uid", "left").join(head, "doc_uid", "left")
    none = F.array().cast("array<struct<number:bigint,suffix:string,article_uid:string,article_number:string>>")
    some = F.when(readable, F.array_distinct(F.concat(F.col("up"), F.col("down"), F.coalesce("same", none), F.coalesce("odd", none)))).otherwise(F.col("head"))
    far = lambda c: F.when(~readable, 0).otherwise(F.coalesce(F.abs(c["number"] - F.col("number")), F.lit(10_000)))
    keyed = F.transform(F.filter(some, lambda c: c["article_uid"] != F.col("article_uid")), lambda c: F.struct(far(c).alias("d"), F.when(readable, c["suffix"]).otherwise("").alias("s"), c["article_uid"].alias("article_uid"), c["article_number"].alias("article_number")))
    picked = rows.select(F.col("article_uid").alias("target"), F.posexplode(F.slice(F.array_sort(keyed), 1, n)).alias("pos", "c"))
    return picked.select("target", "c.article_uid", "c.article_number", (F.col("pos") + 1).cast("int").alias("rank"))


def complete(refs: DataFrame, found: DataFrame, case: str = "case_uid") -> DataFrame:
    """Cases all of whose references are found: refs(case, doc_uid, article_number) against found(case, article_uid); an article cited twice is expected twice but found once."""
    expected = refs.groupBy(case).agg(F.count("*").alias("expected"))
    have = found.groupBy(case).agg(F.countDistinct("article_uid").alias("found"))
    return expected.join(have, case).filter("found >= expected")


def keyword_overlap(keyword: Column, title: Column) -> Column:
    """Share of the keyword's distinct words that the title has; an empty keyword fits any title."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(text.spaces(c)), " "), lambda x: x != ""))
    k = words(keyword)
    return F.when(F.size(k) == 0, 1.0).otherwise(F.size(F.array_intersect(k, words(title))) / F.size(k))


def keyword_titles(keywords: DataFrame, titles: DataFrame, least: float = 0.7) -> DataFrame:
    """S25 for many of both: (keyword, title, share) of keywords(keyword) and titles(title) with at least that overlap, by a join on single words; empty keywords, which fit any title, are left out."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(text.spaces(c)), " "), lambda x: x != ""))
    k = keywords.select("keyword").distinct().withColumn("w", words("keyword")).select("keyword", F.size("w").alias("n"), F.explode("w").alias("word"))
    t = titles.select("title").distinct().select("title", F.explode(words("title")).alias("word"))
    return k.join(t, "word").groupBy("keyword", "title").agg((F.count("*") / F.max("n")).alias("share")).filter(F.col("share") >= least)


def crawl_quota(topics: DataFrame, target: int) -> DataFrame:
    """topics(topic, keyword) with the pages' quota of each keyword; one more topic is free discovery; remainders are left."""
    share = target // (topics.select("topic").distinct().count() + 1)
    of = topics.groupBy("topic").agg(F.count("*").alias("k"))
    return topics.join(of, "topic").select("topic", "keyword", F.floor(F.lit(share) / F.col("k")).alias("quota"))


def until_gap(pages: DataFrame, key: str, order: str, hit: str, gap: int = 10) -> DataFrame:
    """Rows of each key up to the end of the first run of `gap` rows without a hit."""
    w = Window.partitionBy(key).orderBy(order)
    rows = pages.withColumn("_run", F.sum(F.col(hit).cast("int")).over(w)).withColumn("_in_run", F.row_number().over(Window.partitionBy(key, "_run").orderBy(order)) - F.when(F.col("_run") > 0, 1).otherwise(0))
    stop = F.max(F.when(F.col("_in_run") >= gap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_stop", stop).filter(F.coalesce("_stop", F.lit(0)) == 0).drop("_run", "_in_run", "_stop")


GRAM = 6


def holding(docs: DataFrame, fragments: DataFrame, columns: list[str], hint=lambda df: df) -> DataFrame:
    """(fragment, uid, issue_date): the documents that hold one of the distinct fragments(fragment, lower case) in one of the columns, in any case.

    An equi-join: documents are cut into all stretches of GRAM characters (fewer for shorter fragments), of which a fragment has its first; what meets is compared in full.
    """
    sizes = sorted(r[0] for r in fragments.select(F.least(F.char_length("fragment"), F.lit(GRAM))).distinct().collect() if r[0])
    whole = F.lower(F.concat_ws("\n", *columns))
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("_whole") - (n - 1), F.lit(1))), lambda i: F.substring(F.col("_whole"), i, F.lit(n)))
    grams = F.array_distinct(F.concat(*map(cut, sizes))) if sizes else F.array().cast("array<string>")
    rows = docs.select("uid", "issue_date", whole.alias("_whole")).withColumn("_gram", F.explode(grams))
    return rows.join(hint(fragments.withColumn("_gram", F.left("fragment", F.lit(GRAM)))), "_gram").filter(F.col("_whole").contains(F.col("fragment"))).select("fragment", "uid", "issue_date")


def newest(df: DataFrame, key: str, n: int) -> DataFrame:
    """Of each key the n newest rows; Spark limits the groups within each partition first."""
    return df.withColumn("_row", F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last("issue_date"), "uid"))).filter(F.col("_row") <= n).drop("_row")


def search(docs: DataFrame, params: DataFrame, top: int = 5, pool: int = 300, sent: int = 100_000) -> DataFrame:
    """The best candidates for each search, with score, reasons and rank.

    params(search_id, keywords array, doc_type, year, doc_numbers array), in normal form; docs(uid, doc_id, title, doc_type, issue_date).
    Searches with numbers take the documents that hold one; where none does, and for searches without numbers, those that fit a
    keyword, the type or the year, the newest `pool` of them. As the newest of several conditions together are among the newest
    of each, every keyword, type and year is looked up once, cut to its newest `pool`, and then given to the searches that name
    it: equi-joins only. Up to `sent` searches are broadcast; more are joined by shuffling.
    """
    hint = F.broadcast if params.limit(sent + 1).count() <= sent else lambda df: df
    p = params.withColumn("patterns", F.flatten(F.transform("doc_numbers", text.number_patterns)))
    d = docs.select("uid", F.col("doc_id").alias("d_id"), F.col("title").alias("d_title"), F.col("doc_type").alias("d_type"), "issue_date")
    wanted = p.select("search_id", F.explode("patterns").alias("fragment")).select("search_id", F.lower("fragment").alias("fragment")).distinct()
    exact = holding(d, wanted.select("fragment").distinct(), ["d_id"], hint).join(hint(wanted), "fragment").select("search_id", "uid", "issue_date").distinct()
    rest = p.join(exact.select("search_id").distinct(), "search_id", "left_anti")
    words = rest.select("search_id", F.explode("keywords").alias("fragment")).select("search_id", F.lower("fragment").alias("fragment")).distinct()
    by_word = newest(holding(d, words.select("fragment").distinct(), ["d_title", "d_id"], hint), "fragment", pool).join(words, "fragment")
    by_type = newest(d.select(F.col("d_type").alias("doc_type"), "uid", "issue_date").filter("doc_type is not null"), "doc_type", pool).join(rest.select("search_id", "doc_type"), "doc_type")
    digits = F.array_distinct(F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("d_id") - 3, F.lit(1))), lambda i: F.substring(F.col("d_id"), i, F.lit(4)).try_cast("int")), lambda x: x.between(1000, 9999)))
    by_year = newest(d.filter("d_id is not null").select("uid", "issue_date", F.explode(digits).alias("year")), "year", pool).join(rest.select("search_id", "year"), "year")
    free = rest.filter((F.size("keywords") == 0) & F.col("doc_type").isNull() & F.col("year").isNull()).select("search_id", (F.char_length("search_id") * 0).alias("_all"))
    of_all = d.select("uid", "issue_date").orderBy(F.desc_nulls_last("issue_date"), "uid").limit(pool).withColumn("_all", F.char_length("uid") * 0).join(free, "_all")
    found = exact
    for one in (by_word, by_type, by_year, of_all):
        found = found.unionByName(one.select("search_id", "uid", "issue_date"))
    found = newest(found.distinct(), "search_id", pool).drop("issue_date")
    rows = d.withColumn("d_number", text._text(text.doc_number("d_id"))).join(found, "uid").join(hint(p), "search_id")
    score, reasons = score_candidate()
    rows = rows.withColumn("score", score).withColumn("reasons", reasons).filter("score > 0")
    w = Window.partitionBy("search_id").orderBy(F.desc("score"), F.asc_nulls_first("issue_date"), "uid")
    rows = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return rows.select("search_id", "uid", F.col("d_id").alias("doc_id"), F.col("d_title").alias("title"), F.col("d_type").alias("doc_type"), "issue_date", "score", "reasons", "rank")


def score_candidate() -> tuple[Column, Column]:
    """Points and reasons of a row with d_* and search columns: each rule is a (points, reason) pair, null where it doesn't apply."""
    title, number = F.lower(text._text("d_title")), F.col("d_number")
    kind, year = text.doc_type("d_type"), F.year("issue_date")
    rule = lambda cond, points, reason: F.when(cond, F.struct(F.lit(points).alias("points"), reason.alias("reason")))
    numbers = F.transform("doc_numbers", lambda n: F.coalesce(
        rule(n == number, 120, F.concat(F.lit("doc_id exact: "), n)), rule((n != "") & (number.contains(n) | n.contains(number)), 90, F.concat(F.lit("doc_id partial: "), n))
    ))
    y = F.col("year")
    by_year = F.coalesce(
        rule(y == year, 40, F.concat(F.lit("year match: "), y.cast("string"))), rule(number.contains(y.cast("string")), 15, F.concat(F.lit("year appears in doc_id: "), y.cast("string"))),
        rule(y.isNotNull() & year.isNotNull() & (y != year), -20, F.concat(F.lit("year differs: "), year.cast("string"))),
    )
    t = F.col("doc_type")
    fits = (kind == t) | ((t == "Bộ luật") & (kind == "Luật") & title.contains("bộ luật"))
    by_type = F.coalesce(rule(fits, 30, F.concat(F.lit("doc_type match: "), t)), rule(t.isNotNull() & kind.isNotNull(), -35, F.concat(F.lit("doc_type differs: "), kind)))
    words = F.transform("keywords", lambda k: F.coalesce(rule(title.contains(F.lower(k)), 15, F.concat(F.lit("title keyword: "), k)), rule(F.lower(number).contains(F.lower(k)), 8, F.concat(F.lit("doc_id keyword: "), k))))
    rules = F.array_compact(F.concat(numbers, F.array(by_year, by_type), words))
    weak = F.size(rules) == 0
    return F.when(weak, -10).otherwise(F.aggregate(rules, F.lit(0), lambda a, x: a + x["points"])), F.when(weak, F.array(F.lit("weak match"))).otherwise(F.transform(rules, lambda x: x["reason"]))


def head(items: DataFrame, n: int, order: str) -> DataFrame:
    """The first n items by order; all if n is not above 0."""
    return items.orderBy(order).limit(n) if n > 0 else items


def together(parts: list[DataFrame], n: int, key: str, seed: int | str = 0) -> DataFrame:
    """Sub-samples one after another, cut to n rows (earlier parts first), then in seeded order."""
    rows = None
    for k, part in enumerate(parts):
        one = part.withColumn("_part", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    return rows.orderBy("_part", seeded(F.col(key), seed), key).limit(n).orderBy(seeded(F.col(key), f"order{seed}"), key).drop("_part")


def decide(ranked: DataFrame, chosen: DataFrame | None = None, least: int = 160, margin: int = 50) -> DataFrame:
    """(search_id, uid, how): the best candidate if it is good enough and well ahead, else the one that `chosen`(search_id, uid) names among the candidates."""
    w = Window.partitionBy("search_id").orderBy("rank")
    rows = ranked.withColumn("next", F.coalesce(F.lead("score").over(w), F.lit(0)))
    sure = rows.filter((F.col("rank") == 1) & (F.col("score") >= least) & (F.col("score") - F.col("next") >= margin)).select("search_id", "uid", F.lit("score").alias("how"))
    if chosen is None:
        return sure
    named = ranked.select("search_id", "uid").join(chosen.select("search_id", "uid").distinct(), ["search_id", "uid"], "left_semi").join(sure, "search_id", "left_anti")
    return sure.unionByName(named.select("search_id", "uid", F.lit("model").alias("how")))


def candidate_line() -> Column:
    """One line that shows a ranked candidate, with at most five reasons."""
    return F.format_string("%d. uid=%s | score=%d | doc_id=%s | title=%s | type=%s | year=%s | reasons=%s", "rank", "uid", "score", "doc_id", "title", "doc_type", F.coalesce(F.year("issue_date").cast("string"), F.lit("?")), F.array_join(F.slice("reasons", 1, 5), "; "))
