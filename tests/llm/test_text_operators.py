"""Brute force on small fixtures, defined results for odd input."""

import itertools
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanquarry.llm import common
from vanquarry.llm import p1_lookalikes as p1
from vanquarry.llm import p2_scans as p2
from vanquarry.llm import p3_pieces as p3
from vanquarry.llm import p5_site_lines as p5

FIELD = "field_name string, item_id string, value string"
TEXT = "table_name string, uid string, host string, raw_text string"


# --- P1 ---
@pytest.mark.parametrize(
    ("dirty", "clean"),
    [
        (unicodedata.normalize("NFD", "Quyết định"), "Quyết định"), ("Đіều", "Điều"), ("ðược", "được"), ("ＮＱ－１２／２０", "NQ-12/20"), ("a​b﻿­", "ab"), ("một hai　ba", "một hai ba"),
        ("Жердяево", "Жердяево"), ("hệ số μ", "hệ số μ"), ("山河 № ① ½ m² 5–6 “x” …", "山河 № ① ½ m² 5–6 “x” …"), ("a\r\n\tb  c", "a\r\n\tb  c"), ("", ""), ("vе̂̀", "về"),
    ],
)
def test_consistent(dirty, clean):
    assert common.consistent(dirty) == clean
    assert common.consistent(clean) == clean


def test_consistent_long_and_short_agree():
    for t in ("Đіều " * 100, "x" * 300 + " ", "sạch " * 100):
        assert common.consistent(t) == "".join(common.consistent(x + " ") for x in t.split(" "))[: len(common.consistent(t))]


def test_variants(spark):
    rows = [("f", "1", "Đіều một"), ("f", "1", "Đіều một"), ("f", "2", "Điều một"), ("f", "3", None), ("f", "4", ""), ("f", "5", unicodedata.normalize("NFD", "Điều")), ("f", "6", "Жук và μ"), ("f", "7", "hai ba")]
    df = spark.createDataFrame(rows, FIELD).withColumn("word", F.lit("clash")).withColumn("canonical", F.lit(1)).withColumn("words", F.lit(2))
    assert {tuple(r) for r in p1.variants(df).collect()} == {("f", "1", "Đіều", "Điều"), ("f", "5", unicodedata.normalize("NFD", "Điều"), "Điều"), ("f", "7", "hai ba", "hai ba")}
    got = {r["item_id"]: (r["value"], r["n_words"]) for r in p1.apply_form(df).collect()}
    assert got == {"1": ("Điều một", 1), "2": ("Điều một", 0), "3": (None, 0), "4": ("", 0), "5": ("Điều", 1), "6": ("Жук và μ", 0), "7": ("hai ba", 1)}
    assert p1.variants(df.limit(0)).count() == 0


def test_a_class_of_several_mapped_words_has_one_member(spark):
    """Control characters aren't touched by the form, but ignored by the collation: the mapped words differ, the class is one."""
    rows = [("f", "1", "Đіều"), ("f", "2", "Đіề\x07u"), ("f", "3", "ĐIỀＵ")]
    got = {tuple(r) for r in p1.variants(spark.createDataFrame(rows, FIELD)).collect()}
    canonical = {r[1]: r[3] for r in got}
    assert canonical["1"] == canonical["2"] and canonical["3"] == "ĐIỀU"


def test_p1_found_is_what_differs(spark, sf):
    want = set()
    for r in p1.values(spark, sf).collect():
        if r["value"] is not None and common.consistent(r["value"]) != r["value"]:
            want.add((r["field_name"], r["item_id"]))
    got = [tuple(r) for r in p1.p1_found(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


# --- P2 ---
WORDS = "tòa án nhân dân tỉnh người lao động được hưởng theo quy định của pháp luật không hoàn trả kinh phí thẩm định hồ sơ trong năm chung cư phải thông báo khi nhận hộ liền kề giám sát viên phạm vi nghiệm thu".split()
LEXICON = p2.Lexicon({w: 100 for w in WORDS})
READER = p2.Reader(LEXICON)


def test_syllables():
    assert all(map(p2.is_syllable, [*WORDS, "giêng", "quyết", "nghiêng", "khuya", "ngoằn", "uống", "y", "ở", "gì", "xoong"]))
    assert not any(map(p2.is_syllable, ["địnli", "quyềii", "trạrn", "rn", "ngi2", "", "aa", "điịnh", "thât", "chấ", "bcd"]))


@pytest.mark.parametrize(("seen", "meant", "op"), [("địnli", "định", "confusion"), ("thẩrn", "thẩm", "confusion"), ("nhâii", "nhân", "confusion"), ("kh0ng", None, None), ("củ@", "của", "confusion"), ("đu'ợc", "được", "confusion"), ("th-\nông", "thông", "hyphen"), ("thô¬\nng", "thông", "hyphen"), ("QĐ-\nUBND", "QĐ-\nUBND", None), ("phạm", "phạm", None)])
def test_decode(seen, meant, op):
    text, ops = LEXICON.decode(seen)
    assert meant is None or text == meant
    assert meant is None or (ops[op] > 0 if op else not ops)


def test_noise_kinds():
    head = "QUYẾT ĐỊNH VỀ VIỆC THẨM ĐỊNH HỒ SƠ CHUNG CƯ\n"
    title = "Quyết định 12/2020/QĐ-UBND về việc thẩm định hồ sơ chung cư"
    n = "12/2020/QĐ-UBND"
    assert READER.noise(head + "người lao động được hưởng\ntheo quy định", title, n) == []
    assert READER.noise(head + "người lao độ-\nng được hưởng", title, n) == ["broken_word"]
    assert READER.noise(head + "người lao động đu'ợc hưởng", title, n) == ["wrong_char"]
    assert READER.noise(head + "năm 2O20", title, n) == ["wrong_char"]
    assert READER.noise(head + "người lao động\n- 2 -\nđược hưởng", title, n) == ["page_furniture"]
    assert READER.noise(head + "người lao động\nQuyết định 12/2020/QĐ-UBND. thẩm định hồ sơ ch...\nđược hưởng", title, n) == ["page_furniture"]
    for line in ("Quyết định 12/2020/QĐ-UBND   5", "2 | Quyết định 12/2O20/QĐ-UBND", "12/2020/QĐ-UBND - 7"):
        assert READER.noise(head + f"người lao động\n{line}\nđược hưởng", None, n)[-1:] == ["page_furniture"]
    for line in ("Quyết định 12/2020/QĐ-UBND", "theo 15/2020/QĐ-UBND 5", "Quyết định 12/2020/QĐ-UBND năm 5"):
        assert READER.noise(head + f"người lao động\n{line}\nđược hưởng", None, n) == []
    changed = "Quyết định 12/2020/QĐ-UBND sửa đổi quy định về việc thẩm định hồ sơ chung cư"
    assert READER.noise(head + "người lao động\nTHẨM ĐỊNH HỒ SƠ CHUNG CƯ\nđược hưởng", changed, n) == ["page_furniture"]
    assert READER.noise(head + "Điều 1a. mã LST2-4, xe 63C-217.62, 5 m2, bạn thấy hữu ích?", title, n) == []
    assert READER.noise(head + "đượ̣c hưởng​", title, n) == []


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("theo quy đ ịnh của", "theo quy định của"), ("theo quyđịnh của", "theo quy định của"), ("ph áp lu ật không", "pháp luật không"), ("theo quy đị\nnh của", "theo quy định của"), ("th eo quyđịnli của", "theo quy định của"), ("tỉnh ở Manila theo", "tỉnh ở Manila theo"), ("năm 12O/2O17 theo", "năm 120/2017 theo")],
)
def test_torn_and_joined_words(seen, meant):
    assert READER.repair(seen, None, None) == meant


def test_nothing_is_passed_over_for_its_place_or_length():
    subject = "thẩm định hồ sơ chung cư " * 12
    head = "\n".join(f"dòng mở đầu {'abcdeghik'[i % 9]}" for i in range(60))
    body = "người lao động được hưởng\n" + subject.strip().upper() + "\ntheo quy định"
    assert READER.noise(f"{head}\nV/v {subject.strip()}\n\n{body}", None, None) == ["page_furniture"]
    number = p2._number(None, None, "tòa án " * 2000 + "số 12/2020/HS-ST")
    assert number == "12/2020/HS-ST"
    assert p2.paragraphs([f"dòng {i} không có dấu chấm và" for i in range(1500)]).count("\n") == 0
    assert LEXICON.decode("l-\nii-\nê-\nn-\nh")[0]  # any number of operations in a word


def test_paragraphs_are_the_division_of_least_cost():
    """Against all divisions of a few lines, with the costs said again."""
    rng = random.Random(8)
    for _ in range(60):
        lines = [rng.choice(["Một hai ba bốn.", "năm sáu bảy tám chín mười", "TIÊU ĐỀ", "- mục một;", "chín mười"]) for _ in range(rng.randrange(1, 7))]
        width = np.percentile([len(x) for x in lines], 90)

        def cost(i, j, lines=lines, width=width):
            total = 0.3
            for k in range(i, j):
                x, y = lines[k], lines[k + 1] if k + 1 < len(lines) else ""
                ends, opens = x[-1] in ".;:!?)”\"" or x.isupper(), not y or y[0].isupper() or y[0] in "-+*[(“"
                if k == j - 1:
                    total += 0 if ends else 2.0 if opens else 6.0
                else:
                    total += (3.0 if ends and opens and len(x) < 0.75 * width else 0.6 if ends and opens else 0.2) + (4.0 if x.isupper() or y.isupper() else 0)
            return total

        n = len(lines)
        all_ = []
        for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, n), k) for k in range(n)):
            edges = [0, *cuts, n]
            all_.append((sum(cost(a, b) for a, b in itertools.pairwise(edges)), "\n\n".join(" ".join(lines[a:b]) for a, b in itertools.pairwise(edges))))
        got = p2.paragraphs(lines)
        assert min(c for c, t in all_ if t == got) <= min(all_)[0] + 1e-9


def test_repair_round_trip():
    want = "Người lao động được hưởng theo quy định của pháp luật. Không hoàn trả kinh phí thẩm định hồ sơ trong năm chung cư phải thông báo khi nhận."
    noisy = "Người lao động đu'ợc hưởng the-\no quy địnli của pháp luật. Không\n- 3 -\nhoàn trả kinh phí thẩm định hồ sơ tro¬\nng năm chung cư phải thông báo khi nhận."
    assert READER.repair(noisy.replace("the-\no", "th-\neo"), None, None) == want


def test_paragraphs():
    a = "Người lao động được hưởng theo quy định của pháp luật về thẩm định hồ"
    assert p2.paragraphs([a, "sơ trong năm.", "Không hoàn trả kinh phí thẩm định hồ sơ trong năm chung cư phải thông báo", "khi nhận."]).split("\n\n") == [f"{a} sơ trong năm.", "Không hoàn trả kinh phí thẩm định hồ sơ trong năm chung cư phải thông báo khi nhận."]
    assert p2.paragraphs(["a.", "", "b."]) == "a.\n\nb." and p2.paragraphs([]) == ""


def test_p2_odd_input(spark):
    schema = "table_name string, uid string, title string, number string, raw_text string, extra int"
    rows = [("legal_docs", "1", None, None, None, 1), ("legal_docs", None, "x", "y", "- 1 -", 1), ("legal_docs", "2", None, None, "", 1), ("legal_docs", "3", None, None, "a\n- 2 -\nb", 1), ("legal_docs", "3", None, None, "a\n- 2 -\nb", 1), ("legal_docs", "4", None, None, "tòa án " * 20000, 1)]
    df = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in p2.noise(df).collect()] == [("legal_docs", "3", "page_furniture")]
    got = {r["uid"]: r["raw_text"] for r in p2.repaired(df).collect()}
    assert got["3"] == "a b" and got["2"] == "" and got["4"] == "tòa án " * 20000
    assert p2.noise(df.limit(0)).count() == 0


# --- P3 ---
def test_offsets_properties():
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice("ab  .\nđ́") for _ in range(rng.randrange(400)))
        limit = rng.randrange(2, 60)
        overlap = rng.randrange(limit)
        ps = p3.offsets(t, limit, overlap)
        if not t:
            assert ps == []
            continue
        assert ps[0][0] == 0 and ps[-1][1] == len(t) and all(0 < e - s <= limit for s, e in ps)
        assert all(b[0] == a[1] - overlap for a, b in zip(ps, ps[1:])) and all(a[1] < b[1] for a, b in zip(ps, ps[1:]))


def test_offsets_cut_at_the_strongest_place():
    assert p3.offsets("aaaa bbbb cccc.\ndddd. eeee ffff", 24, 0)[0] == (0, 16)
    assert p3.offsets("aaaa. bbbb cccc dddd", 12, 0)[0] == (0, 11)
    assert p3.offsets("x" * 25, 10, 3) == [(0, 10), (7, 17), (14, 24), (21, 25)]
    for bad in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            p3.offsets("abc", *bad)


def test_pieces(spark):
    df = spark.createDataFrame([("f", "1", "x" * 30), ("f", "1", "x" * 30), ("f", "2", None), ("f", "3", ""), ("f", "4", "short")], FIELD).withColumn("piece", F.lit("clash"))
    got = p3.pieces(df, 20, 5)
    assert {r["item_id"] for r in got.collect()} == {"1"} and got.count() == 2
    assert {r["item_id"] for r in p3.pieces(df, 20, 5, oversized=False).collect()} == {"1", "4"}
    assert p3.pieces(df.limit(0), 20, 5).count() == 0


# --- P5 ---
def lines(rows, least=5, share=0.1, hosts=2):
    """Brute force."""
    import regex

    where, uids = {}, {}
    for t, u, h, text in rows:
        if u is None or not h or text is None:
            continue
        uids.setdefault((t, h), set()).add(u)
        for i, x in enumerate(common.consistent(text).split("\n"), 1):
            if len(regex.findall(r"\p{L}+", x)) >= 3:
                where.setdefault((t, h, regex.sub(r"[\d\s]", "", x.lower())), set()).add((u, i))
    often = {k for k, v in where.items() if len({u for u, _ in v}) >= max(least, share * len(uids[k[:2]]))}
    return {(k[0], u, i) for k in often if len({o for o in often if o[0] == k[0] and o[2] == k[2]}) <= hosts for u, i in where[k]}


def site(seed=0, n=60):
    rng = random.Random(seed)
    words = "một hai ba bốn năm sáu bảy tám chín mười đất nhà luật thuế án".split()
    own = {h: [" ".join(rng.choices(words, k=rng.randrange(3, 9))) for _ in range(3)] for h in ("a.vn", "b.vn", "c.vn")}
    rows = []
    for i in range(n):
        h = rng.choice("aaab") + ".vn" if i % 9 else "c.vn"
        ls = [" ".join(rng.choices(words, k=rng.randrange(0, 12))) for _ in range(20)] + ["Độc lập tự do"] + [rng.choice((str.upper, str.lower, str))(x) + f" {i}" for x in own[h] if rng.random() < 0.7]
        rng.shuffle(ls)
        rows.append(("legal_docs", f"u{i}", h, rng.choice(("\n", "\r\n")).join(ls)))
    return rows


def test_repeated_lines_match_brute_force(spark):
    for seed in range(2):
        rows = site(seed)
        rows += [rows[0], rows[0], ("legal_docs", "n1", "a.vn", None), ("legal_docs", None, "a.vn", "x y z"), ("legal_docs", "n2", None, "x y z"), ("court_cases", "e", "a.vn", "")]
        df = spark.createDataFrame(rows, TEXT).withColumn("line_no", F.lit(7))
        df = df.select("table_name", "uid", "host", "raw_text")
        got = [(r["table_name"], r["uid"], r["line_no"]) for r in p5.repeated(df).collect()]
        assert len(got) == len(set(got)) and set(got) == lines(rows)
        wide = [(r["table_name"], r["uid"], r["line_no"]) for r in p5.repeated(df, broadcast_limit=1).collect()]
        assert set(wide) == set(got)
    assert p5.repeated(df.limit(0)).count() == 0


def test_lines_are_cut(spark):
    rows = [("legal_docs", str(i), "a.vn", f"văn bản số {i} riêng\nchia sẻ trang này {i}") for i in range(6)]
    got = p5.cleaned(spark.createDataFrame(rows, TEXT).withColumn("nos", F.lit(1)).withColumn("line_no", F.lit("clash"))).collect()
    assert {r["uid"]: (r["raw_text"], r["lines_removed"]) for r in got} == {str(i): ("", 2) for i in range(6)}


def test_chunks_depend_on_content_only():
    line = "chia sẻ qua thư điện tử mã quét liên kết và đăng nhập để lưu văn bản vào tủ hồ sơ của người đọc trên mạng tra cứu cộng đồng này"
    a, b = p5.Scan(f"trước\n{line}\nsau"), p5.Scan(f"{line} \n khác hẳn")
    inside = lambda s, n: set(s.chunks()[0][s.chunks()[1] == n].tolist())
    assert inside(a, 1) == inside(b, 0) and len(inside(a, 1)) >= 2 and a.wording[1] == b.wording[0]
