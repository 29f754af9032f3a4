"""Scoring of answers and summaries (M1-M12). One projection computes the normal forms, one aggregation the summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanquarry.functions import dates, metrics, text

CHOICE_TASKS = ("task_1_2", "task_2_4", "task_2_6")
NO_JUDGE = {"answer_correctness": 0.0, "fact_usage": 0.0, "legal_application": 0.0, "court_reasoning_alignment": 0.0, "total_score": 0.0, "is_acceptable": False, "reason": "Cannot parse judge JSON"}
JUDGE = "answer_correctness double, fact_usage double, legal_application double, court_reasoning_alignment double, total_score string, is_acceptable boolean, reason string"


def with_forms(df: DataFrame, gold: str = "answer", answer: str = "model_answer") -> DataFrame:
    """Adds _g and _p, the loose forms, and _gm and _pm, the match forms, of the gold and the model's answer."""
    return df.withColumns({"_gm": text.match_form(gold), "_pm": text.match_form(answer)}).withColumns({"_g": _loose("_gm"), "_p": _loose("_pm")})


def _loose(matched: str) -> Column:
    return text.spaces(F.regexp_replace(F.lower(F.col(matched)), r"[^0-9a-zA-ZÀ-ỹ/\- ]+", " "))


def short_answer(df: DataFrame, similarity: bool = True) -> DataFrame:
    """M4: exact in match form (or article form where article_mode), or equal in loose form; with the metrics, rounded to four places."""
    d = with_forms(df)
    mode = F.col("article_mode") if "article_mode" in df.columns else F.lit(False)
    exact = F.when(mode, text.article_form("model_answer") == text.article_form("answer")).otherwise(F.col("_pm") == F.col("_gm"))
    loose = F.col("_p") == F.col("_g")
    out = d.withColumns({
        "scoring_method": F.lit("normalized_exact_match"), "exact_match": exact, "loose_exact_match": loose, "is_correct": exact | loose, "score": (exact | loose).cast("double"),
        "token_f1": F.round(metrics.token_f1(F.col("_p"), F.col("_g")), 4), "length_ratio": F.round(metrics.length_ratio(F.col("_p"), F.col("_g")), 4),
    })
    if similarity:
        out = out.withColumn("char_similarity", F.bround(metrics.char_similarity("_p", "_g"), 4))
    return out.drop("_g", "_p", "_gm", "_pm")


def choice(df: DataFrame, answer: str = "model_answer") -> DataFrame:
    """M5: the option that the answer means and how it was found: the only option contained in it, the gold text contained in it, equal text (both empty), or the letter."""
    d = with_forms(df, answer=answer).withColumn("_o", F.coalesce("options", F.array().cast("array<string>")))
    d = d.withColumn("_l", _loose_options()).withColumn("_in", F.filter(F.arrays_zip("_o", "_l"), lambda x: (x["_l"] != "") & F.col("_p").contains(x["_l"])))
    index = text.choice_index(answer)
    one = F.size("_in") == 1
    gold_in = (F.col("_g") != "") & F.col("_p").contains(F.col("_g"))
    equal = F.col("_p") == F.col("_g")
    letter = index.isNotNull() & (index < F.size("_o"))
    selected = F.when(one, F.get("_in", F.lit(0))["_o"]).when(gold_in | equal, text._text("answer")).when(letter, F.get("_o", index))
    source = F.when(one, "option_text").when(gold_in, "gold_text").when(equal, "exact_text").when(letter, "choice_letter")
    picked = F.when(one, F.get("_in", F.lit(0))["_l"]).when(gold_in | equal, F.col("_g")).when(letter, F.get("_l", index)).otherwise("")
    correct = picked == F.col("_g")
    return d.withColumns({"scoring_method": F.lit("multiple_choice_normalized"), "selected_answer": selected, "match_source": source, "is_correct": correct, "score": correct.cast("double")}).drop("_g", "_p", "_gm", "_pm", "_o", "_l", "_in")


def _loose_options() -> Column:
    """Loose forms of the options; composed in one call over the joined options, as the function runs outside the JVM."""
    joined = F.split(text.nfc(F.array_join(F.transform("_o", lambda x: F.coalesce(x, F.lit(""))), "\x00")), "\x00")
    strip = lambda x: F.btrim(text.spaces(x), F.lit(" \"'`.,;:"))
    return F.when(F.size("_o") == 0, F.array().cast("array<string>")).otherwise(F.transform(joined, lambda x: text.spaces(F.regexp_replace(F.lower(strip(x)), r"[^0-9a-zA-ZÀ-ỹ/\- ]+", " "))))


def metadata(df: DataFrame) -> DataFrame:
    """M6: by question type, containment of the gold answer or equal dates; other questions as short answers."""
    d = with_forms(df).withColumn("question_type", text.question_type("uid"))
    q = F.col("question_type")
    contains = F.col("_p").contains(F.col("_g"))
    day = dates.answer_date("model_answer") == dates.answer_date("answer")
    plain = (F.col("_pm") == F.col("_gm")) | (F.col("_p") == F.col("_g"))
    correct = F.when(q == "effective_date_from_doc_id", day).when(q == "metadata_exact", plain).otherwise(contains)
    method = F.when(q == "doc_id_from_excerpt", "doc_id_contains_match").when(q == "article_from_excerpt", "article_contains_match").when(q == "effective_date_from_doc_id", "date_exact_match")
    method = method.when(q == "signer_from_doc_id", "signer_normalized_match").otherwise("normalized_exact_match")
    return d.withColumns({"scoring_method": method, "is_correct": correct, "score": correct.cast("double")}).drop("_g", "_p", "_gm", "_pm")


def reasoned_answer(c: str) -> tuple[Column, Column]:
    """M7: (answer, explanation) of a JSON answer, else (the stripped text, '')."""
    found = text.json_object(c)
    v = F.try_parse_json(found)
    part = lambda k: text.strip(text._text(F.try_variant_get(v, f"$.{k}", "string")))
    return F.when(found.isNotNull(), part("answer")).otherwise(text.strip(text._text(c))), F.when(found.isNotNull(), part("explanation")).otherwise("")


def judged(df: DataFrame) -> DataFrame:
    """M8: rows with raw_judge_output; the choice decides the score, the judge's total and verdict are kept beside it (all zero if unreadable)."""
    answer, explanation = reasoned_answer("model_answer")
    d = choice(df.withColumns({"model_explanation": explanation, "_a": answer}), "_a").withColumn("model_answer", F.col("_a")).drop("_a")
    j = F.from_json(text.json_object("raw_judge_output"), JUDGE)
    none = F.struct(*[F.lit(v if k != "total_score" else "0.0").alias(k) for k, v in NO_JUDGE.items()])
    d = d.withColumn("judge_result", F.coalesce(j, none))
    return d.withColumns({"scoring_method": F.lit("multiple_choice_plus_llm_judge"), "answer_score": F.col("score"), "judge_score": F.coalesce(F.col("judge_result.total_score").try_cast("double"), F.lit(0.0))})


def score(df: DataFrame, similarity: bool = True) -> DataFrame:
    """M9: scores by task, in the columns that all tasks have and those that some do (else null)."""
    columns = ["uid", "task_id", "model", "scoring_method", "score", "is_correct", "exact_match", "loose_exact_match", "token_f1", "char_similarity", "length_ratio", "selected_answer", "match_source", "question_type", "judge_score", "judge_acceptable"]
    t = F.col("task_id")
    reasoned = t == "task_3_1"
    parts = [
        short_answer(df.filter(~t.isin(*CHOICE_TASKS, "task_2_3", "task_3_1")).withColumn("article_mode", t == "task_2_2"), similarity),
        choice(df.filter(t.isin(*CHOICE_TASKS))),
        metadata(df.filter(t == "task_2_3")),
    ]
    if "raw_judge_output" in df.columns:
        parts.append(judged(df.filter(reasoned)).withColumn("judge_acceptable", F.col("judge_result.is_acceptable")))
    else:
        parts.append(choice(df.filter(reasoned)))
    types = {"score": "double", "is_correct": "boolean", "exact_match": "boolean", "loose_exact_match": "boolean", "token_f1": "double", "char_similarity": "double", "length_ratio": "double", "judge_score": "double", "judge_acceptable": "boolean"}
    out = None
    for p in parts:
        p = p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(types.get(c, "string")).alias(c) for c in columns])
        out = p if out is None else out.unionByName(p)
    return out


def summarize(scores: DataFrame, by: tuple[str, ...] = ("model", "task_id")) -> DataFrame:
    """Per group the number of samples, the accuracy and the means of the metrics over rows that have them (null if none), rounded to four places."""
    mean = lambda c, name: F.round(F.avg(c), 4).alias(name)
    return scores.groupBy(*by).agg(
        F.count("*").alias("num_samples"), F.round(F.avg(F.col("is_correct").cast("double")), 4).alias("accuracy"), mean("token_f1", "avg_token_f1"), mean("char_similarity", "avg_char_similarity"),
        mean("length_ratio", "avg_length_ratio"), mean("judge_score", "avg_judge_score"), mean(F.when(F.col("task_id") == "task_3_1", F.coalesce("judge_acceptable", F.lit(False)).cast("double")), "acceptable_rate"),
    )


def not_scored(responses: DataFrame, scores: DataFrame | None, force: bool = False) -> DataFrame:
    """Responses that have no score yet, or all of them."""
    return responses if scores is None or force else responses.join(scores.select("model", "task_id", "uid"), ["model", "task_id", "uid"], "left_anti")
