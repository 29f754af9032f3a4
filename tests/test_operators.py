import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from vanquarry.operators import cases, documents, generators, html, scoring
from vanquarry.operators import relational as rel
from vanquarry.sources import files, tables
from vanquarry.streaming import scores as stream

BODY = "nội dung của điều này được quy định như sau với đủ số chữ để không bị coi là nhiễu trong văn bản này"


def split(spark, t):
    df = spark.createDataFrame([("u", "1/2020/QH14", False, t)], "uid string, doc_id string, is_amendment boolean, raw_text string")
    return [(r["article_number"], r["heading"], r["content"]) for r in documents.split_articles(df).collect()]


def test_split_articles_skeleton(spark):
    t = f"Mở đầu\nĐiều 1. Phạm vi\n{BODY}\nĐiều 5. Trích\nvẫn của điều một\nĐiều 2. Đối tượng\n{BODY}"
    assert split(spark, t) == [("1", "Phạm vi", f"{BODY}\nĐiều 5. Trích\nvẫn của điều một"), ("2", "Đối tượng", BODY)]


def test_split_articles_rejects_quotes_stops_and_connectives(spark):
    t = f'Điều 1. Một\nsửa như sau: "\nĐiều 2. Trích\n{BODY}\nĐiều 2. Có dấu. Chấm\nx\nĐiều 2\nvà Điều 3 khác\nĐiều 2. Hai\n{BODY}'
    got = split(spark, t)
    assert [(n, h) for n, h, _ in got] == [("1", "Một"), ("2", "Hai")]


def test_split_articles_short_without_name_and_empty(spark):
    t = f"Điều 1. Một\n{BODY}\nĐiều 2\nngắn\nĐiều 3. Ba\n\nĐiều 4. Bốn\r\n{BODY}"
    got = split(spark, t)
    assert [n for n, _, _ in got] == ["1", "4"]
    assert "ngắn" in got[0][2]


def test_split_articles_letters_and_line_breaks(spark):
    assert [n for n, _, _ in split(spark, f"Điều\n1. Một\n{BODY}\nĐiều 33a. X\ny\nĐiều 2. Hai\n{BODY}")] == ["1", "2"]
    assert split(spark, "không có gì") == [] and split(spark, "") == []


def test_dropped_headings_come_back_as_written(spark):
    got = split(spark, f"Điều 1. Một\n{BODY}\n  điều 2.\nngắn\nĐIỀU 3. Ba\n{BODY}")
    assert got == [("1", "Một", f"{BODY}\n  điều 2.\nngắn"), ("3", "Ba", BODY)]


def test_titles(one):
    t = "CỘNG HÒA\n\nLUẬT\nĐẤT ĐAI\nCăn cứ Hiến pháp"
    late = "x\n" * 50 + "LUẬT\nĐẤT ĐAI"
    cases_ = [t, "B\nỘ\nLUẬT\nDÂN SỰ\nĐiều 1. x", "NGHỊ ĐỊNH\nQUY ĐỊNH CHI TIẾT\nThi hành luật", "không có", late, None, "", "LUẬT Thử\nvề việc  a\n\nNơi nhận: x", "B\nỘ\nLUẬT", "LUẬT\n" + "dòng\n" * 20]
    want = ["LUẬT ĐẤT ĐAI", "BỘ LUẬT DÂN SỰ", "NGHỊ ĐỊNH QUY ĐỊNH CHI TIẾT", None, None, None, None, "LUẬT Thử về việc a", "BỘ LUẬT", "LUẬT" + " dòng" * 11]
    assert one(documents.document_title, *cases_) == want


def test_refine_documents(spark):
    raw = [("http://a", "Luật Thử", f"LUẬT\nTHỬ\nĐiều 1. A\n{BODY}", None, {"Số hiệu": "1/2020/QH14", "Loại văn bản": "Luật", "Ngày ban hành": "01/02/2020", "Tình trạng hiệu lực": "Còn hiệu lực"}), ("http://b", "Dự thảo", "x", None, {"Số hiệu": "2/2020/QH14"})]
    df = spark.createDataFrame(raw, "url string, title_web string, raw_text string, summary string, attrs map<string,string>")
    r = documents.refine(df, True).collect()
    assert len(r) == 1 and r[0]["uid"] == "luat-12020qh14-luat-thu-2020-02-01" and r[0]["status"] == "Còn hiệu lực" and r[0]["issuing_body"] == "Quốc hội" and r[0]["title"] == "LUẬT THỬ"
    assert documents.refine(df, False).first()["status"] is None


def test_case_sections(spark):
    t = "Mở\nNỘI DUNG VỤ ÁN:\nnd\nQUYẾT ĐỊNH:\nsai\nNHẬN ĐỊNH CỦA TÒA ÁN\nnh\nQUYẾT ĐỊNH\nqd"
    long = "Mở đầu\n" + "x" * 500 + "\nNguyên đơn: A\ny"
    rows = [t, "không có đề mục", f"{long}\nNHẬN ĐỊNH CỦA TÒA ÁN:\nnh"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "t string").select(cases.sections(F.col("t"))).collect()]
    assert (got[0]["introduction"], got[0]["content"], got[0]["reasoning"], got[0]["decision"]) == ("Mở", "nd\nQUYẾT ĐỊNH:\nsai", "nh", "qd")
    assert got[1]["introduction"] == rows[1] and got[1]["content"] == ""
    assert got[2]["content"] == "Nguyên đơn: A\ny" and got[2]["introduction"].endswith("x")


def test_case_metadata(one):
    assert one(cases.case_number, "Bản án số: 12/2020/HS-ST\n", "Bản án số: 12/2020/DS-PT", "Số: PT") == ["12/2020/HS-ST", None, "PT"]
    assert one(cases.case_day, "Ngày: 04 - 01 - 2005\n", "Ngày 29 tháng 7 năm 2022", "x") == ["2005-01-04", None, None]
    assert one(cases.case_title, 'V/v "tranh chấp\nđất"\nNHÂN DANH', "x") == ["tranh chấp đất", None]
    assert one(cases.legal_bases, "QUYẾT ĐỊNH:\nCăn cứ Điều 1;\nTuyên xử: A", "Căn cứ") == ["Căn cứ Điều 1;", ""]


def test_refine_cases(spark):
    raw = [("u", "Bản án số: 1/2020/HS-ST\nNgày: 1 - 2 - 2020\nV/v trộm cắp\n\nNỘI DUNG VỤ ÁN:\na\nNHẬN ĐỊNH CỦA TÒA ÁN:\nb\nQUYẾT ĐỊNH:\nCăn cứ x. Xử: y", {"Tòa án xét xử": "TAND tỉnh Yên Bắc"}), ("v", "V/v Án lệ\n\n", {}), ("w", "", {})]
    r = cases.refine(spark.createDataFrame(raw, "url string, raw_text string, metadata map<string,string>")).collect()
    assert [(x["uid"], x["case_number"], x["section_content"], x["legal_bases"]) for x in r] == [("12020HSST-TANDTANDYB-20200201", "1/2020/HS-ST", "a", "Căn cứ x.")]


def test_upsert(spark):
    target = spark.createDataFrame([("a", "old", 1), ("b", "keep", 2)], "k string, frozen string, n int")
    source = spark.createDataFrame([("a", "new", 5, 2), ("a", "new", 4, 1), ("c", "first", 7, 1), ("c", "second", 8, 2), (None, "x", 0, 0)], "k string, frozen string, n int, o int")
    assert {tuple(r) for r in rel.upsert(target, source, "k", ["n"], ["o"]).collect()} == {("a", "old", 5), ("b", "keep", 2), ("c", "first", 8)}
    assert rel.upsert(None, source.limit(0), "k", ["n"], ["o"]).count() == 0


def test_quotas_and_strata(spark):
    assert rel.quotas(10) == {"Luật": 8, "Nghị định": 1, "special": 1} and rel.quotas(50)["special"] == 1 and rel.quotas(100) == {"Luật": 80, "Nghị định": 18, "special": 2}
    rows = spark.createDataFrame([(f"u{i}", "Luật" if i % 2 else None) for i in range(20)], "uid string, t string")
    got = rel.stratified(rows, "t", "uid", {"Luật": 3, "Nghị định": 2}, 1)
    assert got.count() == 3 and got.collect() == rel.stratified(rows, "t", "uid", {"Luật": 3, "Nghị định": 2}, 1).collect()


def test_required_and_parents(spark):
    df = spark.createDataFrame([("a", "x"), ("", "y"), ("c", " "), (None, None)], "k string, v string")
    ok, bad = rel.required(df, ["k"], ["v"])
    assert [r["k"] for r in ok.collect()] == ["a"] and bad.count() == 3


def test_search_scores_and_gate(spark):
    docs = spark.createDataFrame([("d1", "12/2016/NĐ-CP", "Nghị định về đất", "Nghị định", "2016-01-01"), ("d2", "13/2016/NĐ-CP", "Nghị định về nhà", "Nghị định", "2016-01-01"), ("d3", "45/2013/QH13", "Luật Đất đai", "Luật", None)], "uid string, doc_id string, title string, doc_type string, d string").withColumn("issue_date", F.to_date("d")).drop("d")
    params = spark.createDataFrame([("s1", ["đất"], "Nghị định", 2016, ["122016NDCP"]), ("s2", ["Đất đai"], None, None, []), ("s3", ["không có"], None, None, [])], "search_id string, keywords array<string>, doc_type string, year int, doc_numbers array<string>")
    got = {(r["search_id"], r["rank"]): (r["uid"], r["score"]) for r in rel.search(docs, params).collect()}
    assert got == {("s1", 1): ("d1", 120 + 40 + 30 + 15), ("s2", 1): ("d3", 15)}
    assert [(r["search_id"], r["uid"]) for r in rel.decide(rel.search(docs, params)).collect()] == [("s1", "d1")]
    chosen = spark.createDataFrame([("s2", "d3"), ("s2", "d9")], "search_id string, uid string")
    assert rel.decide(rel.search(docs, params), chosen).count() == 2


def test_choice(spark):
    opts = ["Phạt tù", "Phạt tiền", "Tha", "Phạt tiền và tù"]
    rows = [("A", "Phạt tù"), ("b) vì", "Phạt tiền"), ("Chọn: phạt tiền", "Phạt tiền"), ("Phạt tiền và tù", "Phạt tiền và tù"), ("không biết", "Tha"), ("", "")]
    df = spark.createDataFrame([(str(i), a, g, opts) for i, (a, g) in enumerate(rows)], "uid string, model_answer string, answer string, options array<string>")
    got = [(r["selected_answer"], r["match_source"], r["is_correct"]) for r in scoring.choice(df).orderBy("uid").collect()]
    assert got == [("Phạt tù", "choice_letter", True), ("Phạt tiền", "choice_letter", True), ("Phạt tiền", "option_text", True), ("Phạt tiền và tù", "gold_text", True), (None, None, False), ("", "exact_text", True)]


def test_judge(spark):
    good = json.dumps({"total_score": 4.5, "is_acceptable": True})
    rows = [("1", '{"answer": "A", "explanation": "vì"}', "Đây: " + good), ("2", "A", "không có")]
    df = spark.createDataFrame([(u, a, j, "x", ["x", "y"]) for u, a, j in rows], "uid string, model_answer string, raw_judge_output string, answer string, options array<string>")
    got = [(r["model_answer"], r["model_explanation"], r["judge_score"], r["judge_result"]["is_acceptable"], r["score"]) for r in scoring.judged(df).orderBy("uid").collect()]
    assert got == [("A", "vì", 4.5, True, 1.0), ("A", "", 0.0, False, 1.0)]


def test_summary_of_nothing(spark):
    s = spark.createDataFrame([], "model string, task_id string, is_correct boolean, token_f1 double, char_similarity double, length_ratio double, judge_score double, judge_acceptable boolean")
    assert scoring.summarize(s).count() == 0


PAGE = """<html><head><link rel="canonical" href="/x"><meta name="description" content="mô tả"></head><body><h1> Tiêu  đề </h1><div id="tomtat"><table class="t"><tr><td>Số hiệu:</td><td><a href="/a">1/2020</a></td><td>Lĩnh vực</td><td><a>Thuế</a><a>Đất</a></td></tr><tr><td>một ô</td></tr></table>
<div class="doc-summary">tóm<br>lược</div></div><a href="/tai-file/1.pdf">Tải</a><a href="/tai-file/1.pdf">Tải lại</a><a href="b.docx" title="Word">x</a><a href="/ban-an/2.html">án</a><a href="/luat-d1.html">luật</a><div id="full">dòng 1<p>dòng 2</div></body></html>"""


def test_html(spark):
    assert html.table_fields(PAGE, within="tomtat", pairs=True, anchors=("Lĩnh vực",)) == {"Số hiệu": "1/2020", "Lĩnh vực": "Thuế, Đất"}
    assert html.table_fields(PAGE, prefer_anchor=True) == {"Số hiệu": "1/2020"} and html.table_fields(None) == {}
    df = spark.createDataFrame([(PAGE,), ("",)], "p string").withColumn("l", html.links("p"))
    r = df.select(html.summary("p"), html.heading("p"), html.canonical_url("p"), html.element_text("p", "full"), html.downloads(F.col("l"), "https://h"), html.case_links(F.col("l"), "https://h"), html.doc_links(F.col("l"), "https://h")).collect()
    assert tuple(r[0][:4]) == ("tóm lược", "Tiêu  đề", "/x", "dòng 1\ndòng 2")
    assert [(x["file_type"], x["url"]) for x in r[0][4]] == [("pdf", "https://h/tai-file/1.pdf"), ("doc", "https://h/b.docx")]
    assert r[0][5] == ["https://h/ban-an/2.html"] and r[0][6] == ["https://h/luat-d1.html"] and r[1][4] == []


def test_html_containers(spark):
    page = """<div id="tomtat"><table><tr><td>Áp dụng</td><td>có</td><td>Số hiệu</td><td>1</td></tr></table><a href="/tai-file/a.pdf">Tải</a></div><a href="/tai-file/b.pdf">Tải</a>
    <h3 class="entry-title"><a href="/khac">x</a></h3><div class="doc-item"><h3><a href="/ban-an/1">một</a></h3><a href="/ban-an/2">hai</a></div>"""
    other = '<h3 class="big entry-title"><a href="/ban-an/9">chín</a><a href="/ban-an/8">tám</a></h3><div class="doc-item"><h3><a href="/ban-an/1">một</a></h3></div>'
    assert html.table_fields(page, pairs=True, without=html.EXCLUDED) == {"Số hiệu": "1"}
    df = spark.createDataFrame([(page,), (other,), (None,)], "p string")
    df = df.withColumns({"l": html.links("p", "tomtat"), "r": html.result_links("p")})
    got = df.select(html.downloads(F.col("l"), "https://h").alias("d"), html.case_links(F.col("r"), "https://h").alias("c")).collect()
    assert [x["url"] for x in got[0]["d"]] == ["https://h/tai-file/a.pdf"]
    assert [r["c"] for r in got] == [["https://h/ban-an/1"], ["https://h/ban-an/9"], None]


def test_listed_documents(spark):
    rows = [[("/Luat-1/", "Luật 35/2024/QH15"), ("/luat-1", "Luật 35/2024/QH15"), ("luat-2", "Luật 1-2"), ("https://X/a", "Nghị định 12/2023/NĐ-CP"), ("/z", "Luật sửa đổi 1/2")]]
    df = spark.createDataFrame([(r,) for r in rows], "l array<struct<href:string,label:string>>")
    got = df.select(F.explode(html.listed(F.col("l"), "https://h")).alias("x")).select("x.*")
    assert [tuple(r) for r in got.collect()] == [("https://h/luat-1", "Luật 35/2024/QH15"), ("https://h/luat-2", "Luật 1-2"), ("https://x/a", "Nghị định 12/2023/NĐ-CP")]
    assert [r[0] for r in got.select(html.is_kept(F.lit(None).cast("string"), F.col("title"))).collect()] == [True, False, True]


def test_official_titles(one):
    assert one(html.is_official_title, "Luật 35/2024/QH15", "Luật sửa đổi 1", "Luật", "Nghị định 12/2023/NĐ-CP", "Luật Đất đai") == [True, False, False, True, False]


def test_body_text(spark):
    df = spark.createDataFrame([(" ", "p" * 200, "h"), ("d", "p" * 200, "h"), (None, "p", "h" * 300), (None, None, "h")], "d string, f string, h string")
    assert [r[0] and r[0]["format"] for r in df.select(html.body_text(F.col("d"), F.col("f"), F.col("h"))).collect()] == ["pdf", "doc", "html", None]


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps([{"uid": "1"}, {"uid": "2"}]))
    (tmp_path / "in/b.json").write_text(json.dumps({"uid": "3"}))
    (tmp_path / "in/c.json").write_text("{broken")
    rows = files.read_json(spark, str(tmp_path / "in"), files.LEGAL_DOC)
    assert sorted(r["uid"] for r in rows.collect() if r["uid"]) == ["1", "2", "3"]
    files.write_by_source(rows, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"_source=a", "_source=b"}
    inputs = spark.createDataFrame([("a.json",), ("b.json",), ("c.json",)], "source_file string")
    files.write_by_source(rows, str(tmp_path / "all"), sources=inputs)
    assert {p.name for p in (tmp_path / "all").iterdir() if p.is_dir()} == {"_source=a", "_source=b", "_source=c"}
    assert spark.read.json(str(tmp_path / "all")).count() == 3
    (tmp_path / "t").mkdir()
    (tmp_path / "t/x.txt").write_text("trang 1\n\n\n\n\n\ntrang 2")
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:r><w:t>một</w:t></w:r></w:p><w:p><w:t>hai</w:t></w:p></w:document>')
    (tmp_path / "t/y.docx").write_bytes(z.getvalue())
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in files.read_documents(spark, str(tmp_path / "t")).collect()}
    assert got["y.docx"] == "một\nhai"
    r = files.read_texts(spark, str(tmp_path / "t/x.txt")).select(files.pages(F.col("text")).alias("p")).select("p", files.is_scanned(F.col("p"))).first()
    assert r[0] == ["trang 1", "trang 2"] and r[1]
    (tmp_path / "t/z.exe").write_bytes(b"x")
    with pytest.raises(Exception, match="unsupported"):
        files.read_documents(spark, str(tmp_path / "t")).collect()


def test_items(spark, sf):
    from vanquarry.plans import catalogue as c

    rows = generators.field_items(c.articles(spark, sf), c.typed_docs(spark, sf), 20).collect()
    assert all(len(set(r["options"])) == 4 and r["answer"] in r["options"] for r in rows)
    done = spark.createDataFrame([("p1",)], "prompt string")
    assert [r["completion"] for r in generators.complete(done, lambda p: p.upper()).collect()] == ["P1"]
    assert [r["completion"] for r in generators.complete(done, lambda p: 1 / 0).collect()] == [""]


def test_amendments(spark):
    a = spark.createDataFrame([("a1", "m", "1", "x", True), ("a2", "m", "2", "x", False), ("a3", "m", "3", "x", False), ("o1", "o", "7", "y", False)], "article_uid string, doc_uid string, article_number string, content string, is_amendment boolean")
    d = spark.createDataFrame([("m", "9/2020/QH14", "Luật sửa"), ("o", "1/2010/QH12", "Luật gốc")], "uid string, doc_id string, title string").withColumn("issue_date", F.lit(None).cast("date"))
    r = generators.amendment_items(a, d, spark.createDataFrame([("a1", "o", "Điều 7")], "article_uid string, original_uid string, original_number string")).collect()
    assert len(r) == 1 and r[0]["answer"] == "Điều 1 của 9/2020/QH14" and len(set(r[0]["options"])) == 4 and r[0]["uid"] == "bench_2_4_o1_a1"


def test_neighbours_match_brute_force(spark):
    import random
    import re

    rng = random.Random(8)
    rows = [(f"d{rng.randrange(3)}", f"a{i:03}", rng.choice(["1", "2", "3", "3a", "3b", "7", "x", "phụ lục", "12"])) for i in range(60)]
    value = lambda n: (int(re.match(r"\d+", n)[0]), re.sub(r"\d", "", n)) if re.fullmatch(r"\d+[a-z]*", n) else None
    want = set()
    for d, u, n in rows:
        v = value(n)
        key = lambda r: (0, "", r[1]) if v is None else (abs(value(r[2])[0] - v[0]), value(r[2])[1], r[1]) if value(r[2]) else (10_000, r[2], r[1])  # noqa: E731, B023
        for k, (_, o, m) in enumerate(sorted([r for r in rows if r[0] == d and r[1] != u], key=key)[:3], 1):
            want.add((u, o, m, k))
    a = spark.createDataFrame(rows, "doc_uid string, article_uid string, article_number string")
    got = [tuple(r) for r in rel.neighbours(a, a, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_keyword_titles(spark):
    k, t = spark.createDataFrame([("đất đai",), ("",)], "keyword string"), spark.createDataFrame([("Tranh chấp Đất đai",), ("đất",), ("x",)], "title string")
    assert {tuple(r) for r in rel.keyword_titles(k, t, 0.5).collect()} == {("đất đai", "Tranh chấp Đất đai", 1.0), ("đất đai", "đất", 0.5)}


def test_gap(spark):
    df = spark.createDataFrame([(1, i, i in (0, 1, 5)) for i in range(9)], "k int, i int, h boolean")
    assert sorted(r["i"] for r in rel.until_gap(df, "k", "i", "h", 3).collect()) == [0, 1, 2, 3, 4]


def test_crawl_quota(spark):
    t = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "topic string, keyword string")
    assert {tuple(r) for r in rel.crawl_quota(t, 300).collect()} == {("a", "x", 50), ("a", "y", 50), ("b", "z", 100)}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text(json.dumps({"uid": "u", "task_id": "task_2_1", "model": "m", "answer": "x", "model_answer": "x"}))
    q = stream.score_stream(stream.responses(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).start()
    q.processAllAvailable()
    (tmp_path / "in/2.json").write_text(json.dumps({"uid": "u", "task_id": "task_2_1", "model": "m", "answer": "x", "model_answer": "y"}))
    q.processAllAvailable()
    q.stop()
    assert [(r["uid"], r["score"]) for r in stream.latest(spark, str(tmp_path / "out")).collect()] == [("u", 0.0)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    tables.write(df, str(tmp_path / "t.parquet"))
    tables.write(df, str(tmp_path / "t.parquet"), clear=False)
    assert tables.read(spark, str(tmp_path), "t").count() == 2


def test_pages_of_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("một\n\n\nhai\n\n\n\n\n\n")
    (tmp_path / "y.pdf").write_bytes(b"%PDF")
    calls = []
    pages = files.pdf_pages_adapter(lambda b: calls.append(b) or ["ngắn", "trang"], lambda b: ["quét"])
    got = {(r["path"].rsplit("/", 1)[1], r["page_no"]): r["text"] for r in files.read_pages(spark, str(tmp_path), pages).collect()}
    assert got == {("x.txt", 1): "một", ("x.txt", 2): "hai", ("y.pdf", 1): "quét"}
    with pytest.raises(Exception, match="unsupported file type"):
        files.read_pages(spark, str(tmp_path)).collect()


def test_head_and_together(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(9)], "uid string, x int")
    assert [r["uid"] for r in rel.head(df, 3, "uid").collect()] == ["0", "1", "2"] and rel.head(df, 0, "uid").count() == rel.head(df, -1, "uid").count() == 9
    got = [r["x"] for r in rel.together([df.filter("x < 4"), df.filter("x >= 4")], 6, "uid").collect()]
    assert set(got) > {0, 1, 2, 3} and len(got) == 6 and got != sorted(got)


def test_searches_beyond_the_broadcast_agree(spark):
    docs = spark.createDataFrame([(f"d{i}", f"{i}/{2000 + i}/NĐ-CP", f"Nghị định về đất số {i}", "Nghị định", None) for i in range(30)], "uid string, doc_id string, title string, doc_type string, issue_date date")
    rows = [("a", ["đất số 1"], None, None, []), ("b", [], None, 2007, []), ("c", [], None, None, []), ("d", ["không"], "Nghị định", None, ["32003NDCP"]), ("e", ["đ"], None, None, [])]
    params = spark.createDataFrame(rows, "search_id string, keywords array<string>, doc_type string, year int, doc_numbers array<string>")
    one, two = (sorted(map(tuple, rel.search(docs, params, sent=n).select("search_id", "uid", "score", "rank").collect())) for n in (100, 2))
    assert one == two and ("d", "d3", 150, 1) in one
    plan = rel.search(docs, params)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Join" in plan and "CartesianProduct" not in plan


def test_clashing_labels_are_passed_over(spark):
    """Two fields share a label; the item goes on to a further field."""
    content = "x" * 100
    docs = spark.createDataFrame([(f"d{f}", "1/2020" if f < 2 else f"{f}/2020", f"Lĩnh vực {f}") for f in range(5)], "uid string, doc_id string, legal_field string")
    rows = [(f"a{f}-{n}", f"d{f}", str(n), content) for f in range(5) for n in range(1, 13)]
    arts = spark.createDataFrame(rows, "article_uid string, doc_uid string, article_number string, content string")
    got = generators.field_items(arts.filter("article_number <> '6' or doc_uid in ('d0', 'd1')"), docs, 10).collect()
    assert len(got) == 10 and all(len(set(r["options"])) == 4 and r["answer"] in r["options"] for r in got)


LAW = [("d1", "52/2014/QH13", "Luật Hôn nhân và Gia đình", "Luật", "2014-06-19"), ("d2", "92/2015/QH13", "Bộ luật Tố tụng dân sự", "Luật", "2015-11-25")]


def test_from_case_to_item(spark):
    """Task 3.1 with injected completions: references, their articles, the decision's options."""
    docs = spark.createDataFrame(LAW, "uid string, doc_id string, title string, doc_type string, issue_date string").withColumn("issue_date", F.to_date("issue_date"))
    arts = spark.createDataFrame([("d1", f"a{n}", str(n), f"nội dung {n}") for n in (33, 55)] + [("d2", "b147", "147", "án phí")], "doc_uid string, article_uid string, article_number string, content string")
    facts, end = "Nguyên đơn trình bày. " * 8, "Tuyên xử chấp nhận yêu cầu khởi kiện. " * 4
    rows = [(u, facts, "Nhận định.", end, "Căn cứ Luật Hôn nhân", "Sơ thẩm") for u in ("c1", "c2", "c3")] + [("c4", facts, "", "ngắn", "x", "Sơ thẩm"), ("c5", facts, "", end, "x", "Phúc thẩm")]
    cases_ = spark.createDataFrame(rows, "uid string, section_content string, section_reasoning string, section_decision string, legal_bases string, court_level string")
    asked = generators.reference_prompts(cases_)
    assert {r["case_uid"] for r in asked.collect()} == {"c1", "c2", "c3"} and "Căn cứ Luật Hôn nhân" in asked.first()["prompt"]
    ref = lambda doc_id, *numbers: {"title_keywords": ["Hôn nhân"], "doc_type": "Luật", "year": 2014, "doc_id": doc_id, "article_numbers": numbers}
    said = {"c1": {"refs": [ref("52/2014/QH13", "55", "Điều 33"), ref("52/2014/QH13", "33")]}, "c2": {"refs": [ref("52/2014/QH13", "33", 56)]}, "c3": {"refs": [{**ref("52/2014/QH13", "33"), "title_keywords": []}]}}
    refs = generators.references(spark.createDataFrame([(u, "Đây: " + json.dumps(x)) for u, x in said.items()] + [("c9", "không rõ")], "case_uid string, completion string"))
    assert sorted((r["case_uid"], r["position"]) for r in refs.collect()) == [("c1", 0), ("c1", 1), ("c2", 0)]
    assert generators.application_blocks(refs, arts, docs).count() == 0  # c1 cites an article twice, c2 one that isn't there
    refs = refs.filter("not (case_uid = 'c1' and position = 1)")
    blocks = generators.application_blocks(refs, arts, docs)
    block = "[Các điều luật liên quan]\n\nĐiều 55 — Luật Hôn nhân và Gia đình (2014):\nnội dung 55\n\nĐiều 33 — Luật Hôn nhân và Gia đình (2014):\nnội dung 33"
    assert [tuple(r) for r in blocks.select("case_uid", "found", "block").collect()] == [("c1", 2, block)]
    prompt = generators.decision_prompts(cases_, blocks).collect()
    assert len(prompt) == 1 and block in prompt[0]["prompt"] and end.strip() in prompt[0]["prompt"]
    answer = json.dumps({"correct": " Chấp nhận ", "distractors": ["Bác", "Đình chỉ", "Hủy", "x"]})
    items = generators.application_items(cases_, blocks, spark.createDataFrame([("c1", answer)], "case_uid string, completion string")).collect()
    assert len(items) == 1 and items[0]["answer"] == "Chấp nhận" and set(items[0]["options"]) == {"Chấp nhận", "Bác", "Đình chỉ", "Hủy"}
    assert items[0]["question"].endswith("Yêu cầu: Chỉ trả về nội dung đáp án đúng.") and items[0]["num_articles_found"] == 2


def test_originals_of_amendments(spark):
    docs = spark.createDataFrame(LAW, "uid string, doc_id string, title string, doc_type string, issue_date string").withColumn("issue_date", F.to_date("issue_date"))
    arts = spark.createDataFrame([("m1", "Sửa đổi Điều 33 của Luật số 52/2014/QH13"), ("m2", "Sửa đổi"), ("m3", "x")], "article_uid string, content string")
    said = [("m1", {"original_article_number": "Điều 33, 34", "title_keywords": ["Luật"], "doc_type": "Luật", "year": 2014, "doc_id": "52/2014/QH13"}), ("m2", {"original_article_number": None, "doc_id": "52/2014/QH13"}), ("m3", {"original_article_number": "1"})]
    df = spark.createDataFrame([(u, json.dumps(x)) for u, x in said], "article_uid string, completion string")
    assert [tuple(r) for r in generators.originals(arts, docs, df).collect()] == [("m1", "d1", "33")]


def test_response_rows(spark):
    items = spark.createDataFrame([("2", "task_1_1", "hai", None), ("1", "task_1_2", "một", ["a", "b"])], "uid string, task_id string, question string, options array<string>")
    got = generators.respond(items, lambda p: f" {len(p)} ", "m", 1).collect()
    assert [(r["uid"], r["model"], r["latency_sec"] >= 0, len(r["evaluated_at"])) for r in got] == [("1", "m", True, 19)] and got[0]["model_answer"] == got[0]["raw_model_output"] == str(int(got[0]["model_answer"]))
    assert generators.respond(items, str, "m").count() == 2

    def fails(_):
        raise RuntimeError("no answer")

    with pytest.raises(Exception, match="no answer"):
        generators.respond(items, fails, "m").collect()
    assert [r["completion"] for r in generators.complete(items.withColumn("prompt", F.col("question")), fails).collect()] == ["", ""]
