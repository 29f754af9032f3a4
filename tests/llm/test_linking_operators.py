"""Brute force or held-out accuracy on small fixtures, defined results for odd input."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanquarry.llm import p4_names as p4
from vanquarry.llm import p6_near_duplicates as p6
from vanquarry.llm import p7_windows as p7
from vanquarry.llm import p8_leaks as p8
from vanquarry.llm import p9_language as p9
from vanquarry.llm.common import cut

# --- P4 ---
REGISTRY = [
    (1, "court", "Tòa án nhân dân tỉnh Yên Bắc"), (2, "court", "Tòa án nhân dân huyện Lam Điền, tỉnh Nhơn Giang"), (3, "court", "Tòa án nhân dân khu vực 1 - Yên Bắc"), (4, "court", "Tòa án nhân dân khu vực 2 - Yên Bắc"),
    (5, "body", "Ủy ban nhân dân tỉnh Yên Bắc"), (6, "body", "Thủ tướng Chính phủ"), (7, "body", "Chính phủ"), (8, "body", "Bộ Cảng và Vận tải"), (9, "signer", "Nguyễn Trọng Hà"), (10, "signer", "Trần Bá Uyên"), (11, "signer", "Quách Bá Uyên"), (12, "body", "Quốc hội"), (15, "signer", "Một Hai Ba Bốn Năm Sáu Bảy Tám Chín"),
]


@pytest.mark.parametrize(
    ("kind", "name", "entity"),
    [
        ("court", "TAND tỉnh Yên Bắc", 1), ("court", "TÒA ÁN NHÂN DÂN TỈNH YÊN BẮC", 1), ("court", "Tòa ná nhân dân tỉnh Yên Bắc", 1), ("court", "Yên Bắc, TAND tỉnh", 1), ("court", "TAND huyện Lam Điền (Nhơn Giang)", 2), ("court", "TAND H. Lam Điền, T. Nhơn Giang", 2),
        ("court", "Tòa Lam Điền", 2), ("court", "Tòa án nhân dân tỉnh Nhơn Giang, huyện Lam Điền", 2), ("court", "TAND KV1 - Yên Bắc", 3), ("court", "Yên Bắc - TAND KV 2", 4), ("court", "Tòa án nhân dân huyện Gia Ninh", None),
        ("body", "U.B.N.D. tỉnh Yên Bắc", 5), ("body", "tỉnh Yên Bắc - UBND", 5), ("body", "TTg", 6), ("body", "Chính phủ - Thủ tướng", 6), ("body", "CP", 7), ("body", "Chính phu", 7), ("body", "BCVT", 8), ("body", "Bộ Cảng và Vận tải (cũ)", 8), ("body", "Sở Kế hoạch Bình Xá", None), ("body", "Quốchội", 12),
        ("signer", "N.T. Hà", 9), ("signer", "Ng. Trọng Hà", 9), ("signer", "Hà, Nguyễn Trọng", 9), ("signer", "ThS. Nguyễn Trọng Hà", 9), ("signer", "Nguyễn Tring Hà", 9), ("signer", "Trọng Hà (đã ký)", 9), ("signer", "Bá Uyên", None), ("signer", "Cù Lệ Ngân", None),
        ("signer", "Hà Trọng Nguyễn", 9), ("signer", "Trong Ha Nguyen", 9), ("signer", "Một Hai Ba Bốn Năm Sáu Bảy Tám Chín", 15), ("signer", "Chín Một Hai Ba Bốn Năm Sáu Bảy Tấm", 15), ("signer", "Hai Một Ba Bốn Năm Sáu Bảy Tám Chín", 15),
        ("court", "Yên Bắc, tỉnh, dân, nhân, án, Tòa", 1), ("court", "tỉnh Nhơn Giang huyện Lam Điền TAND", 2),
    ],
)
def test_names(kind, name, entity):
    found = p4.Registry(REGISTRY).look_up(kind, [name, "Trần Bá Uyên", "TAND"])
    found = [x[1:] for x in found if x[0] == name]
    best = [e for e, d, m in found if (d, m) == min((d, m) for _, d, m in found)]
    assert (best[0] if len(best) == 1 else None) == entity


def test_trie_matches_brute_force():
    def osa(a, b):
        d = [[max(i, j) if not min(i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(3)
    words = {"".join(rng.choices("abc", k=rng.randrange(1, 8))) for _ in range(80)}
    trie = p4.Trie()
    for w in words:
        trie.add(w, w)
    other, typed = p4.Trie(), {"".join(rng.choices("abcd", k=rng.randrange(1, 8))) for _ in range(80)}
    for w in typed:
        other.add(w, w)
    for most in (0, 1, 2):
        got = {(d, a, b) for d, these, those in trie.join(other, most) for a in these for b in those}
        assert got == {(osa(a, b), a, b) for a in words for b in typed if osa(a, b) <= most}


def test_links(spark):
    reg = spark.createDataFrame([*REGISTRY, (None, "court", "x"), (13, None, "x"), (14, "court", None), REGISTRY[0]], "entity_id bigint, entity_kind string, canonical_name string")
    names = spark.createDataFrame([("court", "TAND tỉnh Yên Bắc"), ("court", "TAND tỉnh Yên Bắc"), ("court", None), ("court", " "), ("signer", "Bá Uyên"), ("other", "x")], "kind string, name string").withColumn("entity_id", F.lit(1))
    assert [tuple(r) for r in p4.links(names, reg).collect()] == [("court", "TAND tỉnh Yên Bắc", 1)]
    assert [tuple(r) for r in p4.links(names, reg, block=3).collect()] == [("court", "TAND tỉnh Yên Bắc", 1)]
    assert p4.links(names.limit(0), reg).count() == 0 and p4.links(names, reg.limit(0)).count() == 0


# --- P6 ---
TEXT = "table_name string, uid string, host string, raw_text string"


def corpus(seed=0):
    rng = random.Random(seed)
    name = lambda n: "".join("bcdghklmnp"[int(c)] for c in str(n))  # noqa: E731  (no digits, which the wording of a line leaves out)
    base = [" ".join(name(rng.randrange(3000)) for _ in range(rng.choice((12, 60, 300)))) for _ in range(25)]
    rows = []
    for i, t in enumerate(base):
        rows.append(t)
        for _ in range(rng.randrange(4)):
            w = t.split()
            for _ in range(rng.randrange(1, max(2, len(w) // 14))):
                k = rng.randrange(len(w))
                w[k : k + rng.randrange(2)] = [f"s{name(rng.randrange(99))}"] * rng.randrange(3)
            rows.append(" ".join(w))
        if i % 5 == 0:
            rows += [t, t.upper()]
    return [("legal_docs", f"u{i:03}", "h", t) for i, t in enumerate(rows)]


def similar(rows, threshold=0.5):
    sets = {}
    for _, u, _, t in rows:
        w = (t or "").lower().split()
        if u and len(w) >= 5:
            sets[u] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    return {("legal_docs", a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_pairs_match_brute_force(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame([*rows, rows[0], ("legal_docs", "n", "h", None), ("legal_docs", None, "h", "x"), ("legal_docs", "s", "h", "a b"), ("legal_docs", "e", "h", "")], TEXT)
    got = [tuple(r) for r in p6.found(df).collect()]
    want = similar(rows)
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want) and len(want) > 30
    monkeypatch.setattr(p6, "HOT", 1)
    assert {tuple(r) for r in p6.found(df).collect()} == set(got)
    monkeypatch.setattr(p6, "ALL_PAIRS", 1)
    stars = {tuple(r) for r in p6.found(df).collect()}
    assert stars < set(got) and {u for _, a, b in stars for u in (a, b)} == {u for _, a, b in got for u in (a, b)}
    assert p6.found(df.limit(0)).count() == 0


def test_signatures_meet_at_the_threshold():
    rng = np.random.default_rng(5)
    missed = 0
    for n in (12, 60, 400, 3000):
        for _ in range(60):
            common = rng.integers(0, 2**63, 2 * n // 3 + 1, dtype=np.uint64)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, n // 3, dtype=np.uint64)])) for _ in range(2))
            missed += len(np.intersect1d(p6.signatures(a), p6.signatures(b))) < p6.SHARED
    assert missed == 0


def test_site_lines_are_left_out():
    from vanquarry.llm import p5_site_lines as p5

    line = "chia sẻ trang này ngay"
    with_line = p6.words(f"một hai ba bốn năm\n{line} 5\nsáu bảy", np.array([p5.wording(line)]))
    assert np.array_equal(with_line, p6.words("một hai ba bốn năm\nSÁU bảy"))
    assert len(p6.words("a_b 1,2 x²")) == 4


# --- P7 ---
def test_plan_is_exact_and_full():
    rng = random.Random(2)
    for capacity in (10, 100, 512):
        h = Counter(rng.randint(1, capacity) for _ in range(2000))
        plan = p7.plan(dict(h), capacity, rounds=60)
        used = Counter()
        for times, found in plan:
            assert times > 0 and sum(s * n for s, n in found.items()) <= capacity
            for s, n in found.items():
                used[s] += times * n
        assert used == h
        bins, volume = sum(t for t, _ in plan), sum(s * n for s, n in h.items())
        best = max(-(-volume // capacity), sum(n for s, n in h.items() if 2 * s > capacity))
        assert bins <= best * 1.03 + 2
    assert p7.plan({}, 5) == []
    with pytest.raises(ValueError):
        p7.plan({6: 1}, 5)


def test_fill(spark):
    rows = [(i, n) for i, n in enumerate([0, 1, 5, 9, 10, 11, 25, 3, 3, 3, 30] + [4] * 50)]
    counts = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint")
    got = p7.fill(counts, [("w", 10), ("v", 7)]).collect()
    for name, capacity in (("w", 10), ("v", 7)):
        mine = [r for r in got if r["window_name"] == name]
        load = Counter()
        for r in mine:
            load[r["window_no"]] += r["n_tokens"]
        assert max(load.values()) <= capacity and sum(load.values()) == sum(n for _, n in rows)
        for i, n in rows:
            ps = sorted((r["piece_no"], r["start_token"], r["n_tokens"]) for r in mine if r["doc_id"] == i)
            assert len(ps) == max(1, -(-n // capacity)) and [p[1] for p in ps] == [k * capacity for k in range(len(ps))] and sum(p[2] for p in ps) == n
    assert p7.fill(counts.limit(0), [("w", 10)]).count() == 0 and p7.fill(counts, []).count() == 0
    with pytest.raises(ValueError):
        p7.fill(counts, [("w", 0)])


def test_token_counts(spark):
    import os

    if not os.path.exists(p7.TOKENIZER):
        pytest.skip("no tokenizer")
    df = spark.createDataFrame([(1, "Điều 1"), (1, "Điều 1"), (2, ""), (3, None), (None, "x"), (4, "<|endoftext|>")], "doc_id bigint, text string").withColumn("n_tokens", F.lit(9))
    got = {r["doc_id"]: r["n_tokens"] for r in p7.token_counts(df).collect()}
    assert set(got) == {1, 2, 4} and got[2] == 0 and got[1] == len(p7.encoding(p7.TOKENIZER).encode_ordinary("Điều 1"))


# --- P8 ---
def test_myers_matches_brute_force():
    def distance(p, t):
        row = [0] * (len(t) + 1)
        for i, a in enumerate(p, 1):
            last, row[0] = row[0], i
            for j, b in enumerate(t, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
        return min(row)

    rng = random.Random(4)
    for _ in range(300):
        p, t = rng.choices("abc", k=rng.randrange(1, 9)), rng.choices("abc", k=rng.randrange(0, 12))
        assert p8.myers(p, t) == distance(p, t)


def test_leaks(spark):
    rng = random.Random(6)
    word = lambda: f"từ{rng.randrange(400)}"
    items = [(f"i{k}", " ".join(word() for _ in range(n)), " ".join(word() for _ in range(5)), "x") for k, n in enumerate((11, 12, 13, 30, 45))]
    docs, want = [], {}
    for d in range(60):
        ws = [word() for _ in range(rng.randrange(0, 80))]
        if d % 3:
            q = rng.choice(items[1:])[1].split()
            n = rng.randrange(9, min(len(q), 20) + 1)
            a = rng.randrange(len(q) - n + 1)
            part = [x.upper() if rng.random() < 0.3 else x for x in q[a : a + n]]
            if d % 3 == 2:
                part[rng.randrange(len(part))] = "khác"
            ws[10:10] = part
        docs.append((d, " ,\n".join(ws)))
    for d, t in docs:
        w = t.lower().replace(",", " ").split()
        for u, q, _, _ in items:
            q = q.lower().split()
            runs = {tuple(q[i : i + 12]) for i in range(len(q) - 11)}
            if any(tuple(w[i : i + 12]) in runs for i in range(len(w) - 11)):
                want[d, u] = 0
            elif any(p8.myers(list(r), w) <= 1 for r in runs):
                want[d, u] = 1
    dd = spark.createDataFrame([*docs, docs[1], (99, None), (98, ""), (None, "x")], "doc_id bigint, text string").withColumn("item_uid", F.lit("clash"))
    ii = spark.createDataFrame([*items, items[2], ("z", None, None, None)], "uid string, question string, answer string, explanation string")
    got = p8.leaks(dd, ii).collect()
    assert {(r["doc_id"], r["item_uid"]) for r in got if not r["distance"]} == {k for k, v in want.items() if not v}
    assert {(r["doc_id"], r["item_uid"]): r["distance"] for r in got} == want and len(set(want.values())) == 2
    assert sorted(map(tuple, p8.leaks(dd, ii, block=200).collect())) == sorted(map(tuple, got))
    assert p8.leaks(dd.limit(0), ii).count() == 0 and p8.leaks(dd, ii.limit(0)).count() == 0


@pytest.mark.parametrize(("min_words", "budget"), [(12, 0), (12, 1), (7, 1), (9, 2), (5, 3)])
def test_index_matches_brute_force(min_words, budget):
    """Few different words, so that pieces are hit all over, and texts looked at together."""
    rng = random.Random(min_words + budget)
    texts = [" ".join(rng.choices("abcd", k=rng.randrange(40))) for _ in range(40)]
    own = [" ".join(rng.choices("abcd", k=rng.randrange(30))) for _ in range(12)]
    for k in range(0, 40, 2):
        part = rng.choice([q for q in own if len(q) > 2 * min_words]).split()[: min_words + 2]
        part[rng.randrange(len(part))] = rng.choice(["a", "a b", "x"])
        texts[k] += " " + " ".join(part)
    index = p8.Index([{"item_uid": str(i), "part": "question", "passage": t} for i, t in enumerate(own)], min_words, budget)
    got = {(d, index.names[no][0]): least for d, no, least in index.find(texts)}
    want = {}
    for d, t in enumerate(texts):
        for i, q in enumerate(own):
            w = q.split()
            least = min((p8.myers(w[k : k + min_words], t.split()) for k in range(len(w) - min_words + 1)), default=99)
            if least <= budget:
                want[d, str(i)] = least
    assert got == want and want


# --- P9 ---
SAMPLES = {
    "vi": "Người lao động được hưởng lương theo quy định. Cơ quan đăng ký phải thông báo cho chủ đầu tư trong mười ngày. Hợp đồng thuê đất hết hạn.",
    "en": "The lessee shall file the notice of transfer before the hearing. The registrar may publish the list of creditors. Each party has to keep the ledger.",
    "fr": "Le greffier conserve la liste des créanciers avant l'audience. La coopérative doit déposer le registre. Le preneur restitue l'acte scellé.",
    "ru": "Арендатор публикует список кредиторов до начала слушания. Истец обязан подать годовой отчёт. Подрядчик возвращает залог.",
    "zh": "承租人应当提交转让通知书。港务委员会负责审计年度申报表。原告一方必须保存债权人名册。",
}


@pytest.fixture(scope="module")
def models():
    return p9.fit([(k, t) for k, t in SAMPLES.items()] * 3 + [("fr", SAMPLES["en"])])


def test_languages(spark, models):
    rows = [
        (1, "vi", "Cơ quan đăng ký thông báo hợp đồng thuê đất."), (2, "en", "Co quan dang ky thong bao hop dong thue dat."), (3, None, "The registrar shall keep the list of creditors.\n\nLe preneur doit déposer la liste."),
        (4, "xx", "123\n---"), (5, "vi", None), (6, "vi", ""), (7, "zh", "港务委员会应当提交年度申报表。"), (8, "ru", "Истец публикует отчёт до начала слушания."), (7, "zh", "港务委员会应当提交年度申报表。"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumn("para_no", F.lit(1))
    found = p9.languages(df, models)
    assert {tuple(r) for r in p9.wrong(found).collect()} == {(2, 0, "vi"), (3, 0, "en"), (3, 3, "fr")}
    assert all(0 < r["confidence"] <= 1 for r in found.collect())
    assert p9.languages(df.limit(0), models).count() == 0 and p9.languages(df, None).count() == 0 and p9.fit([]) is None


def test_languages_come_from_the_labels():
    german = "Der Mieter muss die Kündigung vor der Anhörung einreichen. Das Gericht veröffentlicht die Liste der Gläubiger. Jede Partei führt ihre Bücher selbst."
    rows = [(k, t) for k, t in [*SAMPLES.items(), ("de", german)] for _ in range(4)] + [("xx", t) for t in SAMPLES.values()] * 2 + [("nl", SAMPLES["en"])] * 3
    m = p9.fit(rows)
    assert m.languages == sorted([*SAMPLES, "de"])
    assert m.classify([p9.words("Das Gericht veröffentlicht die Bücher der Mieter")])[0][0] == "de"


def test_one_odd_sentence_does_not_turn_rejection_off():
    rows = [(k, t) for k, t in SAMPLES.items()] * 300
    plain = p9.fit(rows).limit["en"]
    assert p9.fit([*rows, ("en", "qxzzj wvvk kkzq jqx.")]).limit["en"] < 1.5 * plain


def test_rejection(models):
    ws = p9.words("qqzx wwkj zzzx xqkw jjqz")
    assert models.classify([ws])[0][0] == "und"


def test_probabilities_sum_to_one():
    m = p9.Model(Counter({"ba": 3, "bab": 1, "ca": 2}))
    for context in ("", "b", "ba"):
        total = 0.0
        for c in ["a", "b", "c", "\x03"]:
            w = context + c.replace("\x03", "")
            h, word = p9.grams([w])
            cost = m.cost(h, p9.contexts([w]))
            total += np.exp(-cost[len(context)])
        assert 0.7 < total <= 1.0001  # the rest is for characters never seen


def test_held_out_accuracy(spark, sf):
    """On labelled rows that the models weren't fitted on, but for the share of labels that is wrong in the data."""
    docs = p9.read(spark, sf, "documents")
    m = p9.fit(p9.sample(docs, 12))
    r = p9.languages(docs.filter(F.col("lang").isin(*SAMPLES)), m).filter("para_no = 0").select(F.avg((F.col("stored") == F.col("lang")).cast("double"))).first()[0]
    assert r > 0.85
