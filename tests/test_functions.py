import datetime
import difflib
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vanquarry.functions import dates, ids, metrics, text

NFD = unicodedata.normalize("NFD", "Điều")


def test_spaces_and_match_form(one):
    assert one(text.spaces, " a\u00a0\t b\u3000", "", None) == ["a b", "", ""]
    assert one(text.match_form, ' "Điều 1." ', "a\u00a0b;", NFD, None) == ["Điều 1", "a b", "Điều", ""]


def test_loose_form_keeps_signs_in_its_range(one):
    assert one(text.loose_form, "A×B ÷ c!", "12/2016/NĐ-CP", "x_y", None) == ["a×b ÷ c", "12/2016/nđ-cp", "x y", ""]


def test_article_form(one):
    assert one(text.article_form, "1. Một\n2) hai", "a) Ba; b. bốn", "x1. y") == ["Một hai", "Ba bốn", "x1 y"]


def test_slug_drops_slashes(one):
    assert one(text.slug, "123/2016/NĐ-CP", "Luật  Đất đai", "", None) == ["1232016nd-cp", "luat-dat-dai", "unknown", "unknown"]
    assert one(text.crawl_slug, "Đất đai", None) == ["at_ai", "empty"]


def test_clean_crawled(one):
    assert one(text.clean_crawled, "a\u200bb\nĐang theo dõi\n x \n<a data-href=1>\nend\n", None) == ["ab\n x \nend", ""]


def test_missing(one):
    assert one(text.clean_missing, " Đang  cập nhật", "x  y", "", None) == [None, "x y", None, None]
    assert one(text.clean_field, "None", " Thuế ", None) == [None, "Thuế", None]


def test_valid_doc(spark):
    rows = spark.createDataFrame([("Dự thảo luật", "1/2"), ("Luật", "12"), ("Luật", "12/2"), (None, "chưa rõ"), (None, None)], "t string, n string")
    assert [r[0] for r in rows.select(text.is_valid_doc("t", "n")).collect()] == [False, False, True, False, False]


def test_caps_line(one):
    assert one(text.is_caps_line, "LUẬT đ", "123", "LUẬT ĐẤT ĐAI", None) == [True, False, True, False]


def test_legal_plain_takes_leading_words_with_a_stop(one):
    assert one(text.legal_plain, "1. Một\na) hai\n- ba, bốn", "cho. phép", None) == ["Một hai ba bốn", "phép", ""]


def test_numbers(one, spark):
    assert one(text.article_int, "33a", "x", None) == [33, None, None]
    assert one(lambda c: text.article_value(c)["suffix"], "33A", "3-a", "7") == ["a", None, ""]
    assert one(text.doc_number, " 12/2016/nđ-cp", "", None) == ["122016NDCP", None, None]
    assert one(lambda c: text.doc_numbers(c), "theo 12/2016/NĐ-CP và 12/2016/NĐ-CP, 5/2020/QH14.", None) == [["122016NDCP", "52020QH14"], []]
    assert one(text.number_patterns, "122016NDCP", "592020QH14", "X") == [["122016NDCP", "12/2016", "12/2016/NDCP", "12/2016/NĐ-CP", "12/2016/ND-CP"], ["592020QH14", "59/2020", "59/2020/QH14", "59/2020/QH"], ["X"]]
    assert one(text.clean_article_number, "Điều 5, khoản 2", None) == ["5", ""]
    rows = spark.createDataFrame([(["Luật", " Đất đai ", "đất ĐAI", "a"],), (None,)], "k array<string>")
    assert [r[0] for r in rows.select(text.keywords(F.col("k"))).collect()] == [["Đất đai"], []]
    assert one(text.year, "2020", "1700", "x", None) == [2020, None, None, None]


def test_types(one):
    assert one(text.doc_type, "Bộ luật Dân sự", "Luật sửa đổi", "Nghị định", "Thông tư", None) == ["Bộ luật", "Luật", "Nghị định", None, None]
    assert one(text.status, "Hết hiệu lực một phần: 1/1/2020", "Còn hiệu lực", "bị bãi bỏ", None, "2020 còn hiệu lực") == ["Hết hiệu lực một phần", "Còn hiệu lực", "Hết hiệu lực", "Không xác định", "Không xác định"]
    assert one(text.issuing_body, "59/2020/QH14", "1/2020/NĐ-CP", "2/QĐ-TTg", "1/UBTVQH13", "9/X", None) == ["Quốc hội", "Chính phủ", "Thủ tướng Chính phủ", "Ủy ban Thường vụ Quốc hội", None, None]


def test_excerpt_and_facts(one):
    assert one(text.excerpt, "A. B.\nC.", " . ", None) == ["A. B.", "", ""]
    facts = "x" * 250
    assert one(text.before_reasoning, facts + "XÉT THẤY: y", "XÉT THẤY: z", facts + "XÉT THẤY: NHẬN ĐỊNH CỦA TÒA")[:2] == [facts, "XÉT THẤY: z"]


def test_choices(one, spark):
    assert one(text.choice_index, "A", "B.", "c) text", "Đúng", "abc", None) == [0, 1, 2, None, None, None]
    rows = spark.createDataFrame([(["x", "y"],)], "o array<string>")
    assert rows.select(text.options_block(F.col("o"))).first()[0] == "A. x\nB. y"
    with pytest.raises(Exception, match="more than four"):
        spark.createDataFrame([(list("abcde"),)], "o array<string>").select(text.options_block(F.col("o"))).collect()


def test_json_and_labels(one):
    assert one(text.json_object, 'x {"a": 1} y', "{bad", "} {", None) == ['{"a": 1}', None, None, None]
    first, last = text.ISSUE_LABELS[0], text.ISSUE_LABELS[-1]
    assert one(text.issue_label, first.upper(), "15", "1. gì đó", f"Là {last} nhé", "?", None) == [first, last, first, last, text.OTHER_LABEL, text.OTHER_LABEL]
    assert one(text.question_type, "bench_2_3_docid_1", "bench_2_3_signer_1", "x", None) == ["doc_id_from_excerpt", "signer_from_doc_id", "metadata_exact", "metadata_exact"]
    assert one(text.model_dir, "a/b:c d") == ["a__b_c_d"]
    assert one(text.is_weak_title, "LUẬT", "Luật Đất đai", "abc") == [True, False, True]
    assert one(text.file_slug, "Án 1\nx") == ["Án_1"]
    assert one(text.is_rejected_case_title, "Án lệ số 1", "tranh chấp") == [True, False]


def test_dates(one, spark):
    d = datetime.date
    assert one(dates.vn_date, "31/02/2020 2020-3-1", "5-6-2020", "ngày 7 tháng 8 năm 2021", "đã biết", None, "x") == [d(2020, 3, 1), d(2020, 6, 5), d(2021, 8, 7), None, None, None]
    assert one(dates.case_date, " 14 - 10 - 2025.", "1/2/25", None) == ["2025-10-14", None, None]
    assert one(dates.iso_date, "2020-02-30", "2020-02-03", "3/2/2020") == [None, d(2020, 2, 3), None]
    assert one(dates.answer_date, "ngày 1/2/2020.", "2020-2-1", "hôm qua") == ["01/02/2020", "01/02/2020", "hôm qua"]
    rows = spark.createDataFrame([("2020-01-01", "có hiệu lực kể từ ngày ban hành"), ("2020-01-01", "Hiệu lực từ ngày 1/7/2020"), (None, "x")], "i string, t string")
    assert [r[0] for r in rows.select(dates.effective_date(F.to_date("i"), "t")).collect()] == [d(2020, 1, 1), d(2020, 7, 1), None]


def test_ids(one, spark):
    assert one(ids.court_acronym, "Tòa án nhân dân khu vực 2 - Ngọc Lĩnh", "TAND huyện Cam Lâm", "abc", None) == ["TANDKV2NL", "TANDTANDCL", "TAND", "TAND"]
    rows = spark.createDataFrame([("12/2020/HNGĐ-ST", "TAND tỉnh Yên Bắc", None), (None, None, "2020-01-02")], "n string, c string, d string")
    assert [r[0] for r in rows.select(ids.case_uid(F.col("n"), F.col("c"), F.col("d"))).collect()] == ["122020HNGST-TANDTANDYB-00000000", "N-TAND-20200102"]


def test_metrics(spark):
    pairs = [("a b b c", "b b d"), ("", ""), ("a", ""), ("x y", "z"), ("a a a", "a"), ("tòa án", "tòa án")]
    long = "ab " * 100
    rows = spark.createDataFrame([*pairs, (long, "ba " * 100)], "p string, g string").select(metrics.token_f1(F.col("p"), F.col("g")).alias("f"), metrics.length_ratio(F.col("p"), F.col("g")).alias("l"), metrics.char_similarity("p", "g").alias("c"), "p", "g").collect()
    for r in rows:
        p, g = r["p"].split(), r["g"].split()
        same = sum((Counter(p) & Counter(g)).values())
        want = 1.0 if not p and not g else 0.0 if not same else 2 * same / (len(p) + len(g))
        assert r["f"] == pytest.approx(want)
        assert r["c"] == difflib.SequenceMatcher(None, r["p"], r["g"]).ratio()
    assert rows[1]["l"] == 1 and rows[2]["l"] == 0
