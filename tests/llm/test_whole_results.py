"""Cases that the operators once left out."""

import numpy as np
import pytest

from vanquarry.llm import p2_scans as p2
from vanquarry.llm import p3_pieces as p3
from vanquarry.llm import p5_site_lines as p5
from vanquarry.llm import p6_near_duplicates as p6
from vanquarry.llm import p7_windows as p7

TEXT = "table_name string, uid string, host string, raw_text string"


# --- P2 ---
def test_words_broken_across_page_furniture():
    reader = p2.Reader(p2.Lexicon({w: 100 for w in "người lao động được hưởng theo quy định khác hành".split()}))
    n, line = "12/2020/QĐ-UBND", "XEM BÌNH LUẬN (182)"
    skip = np.array([p5.wording(line)])
    assert "broken_word" in reader.noise("người kh-\nTrang 5\nác được hưởng", None, n)
    assert "broken_word" in reader.noise(f"người kh-\n- 9 -\n{line}\nác được hưởng", None, n, skip)
    assert "broken_word" in reader.noise(f"người kh¬\nQuyết định {n}   9\nác được hưởng", None, n)
    assert reader.noise("người theo-\nTrang 5\nquy định", None, n) == ["page_furniture"]
    assert reader.lexicon.decode("địnl-\ni")[0] == "định"


# --- P3, P7 ---
def test_large_parameter_tables_are_refused(spark, tmp_path):
    spark.range(1001).selectExpr("concat('t.c', id) field_name", "id + 9 max_chars", "0L overlap_chars", "concat('w', id) window_name", "id + 1 capacity_tokens").write.parquet(f"{tmp_path}/size_limits.parquet")
    spark.read.parquet(f"{tmp_path}/size_limits.parquet").write.parquet(f"{tmp_path}/context_windows.parquet")
    for f in (p3.all_pieces, p7.windows_of):
        with pytest.raises(ValueError, match="parameter table"):
            f(spark, str(tmp_path))


# --- P6 ---
@pytest.mark.parametrize("n", [250, 511, 1020])
def test_contained_sets_in_neighbouring_bands_meet(n):
    rng = np.random.default_rng(n)
    shared = []
    for _ in range(100):
        b = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        shared.append(len(np.intersect1d(p6.signatures(np.sort(b[:n])), p6.signatures(np.sort(b)))))
    m = np.mean(shared)
    assert np.exp(-m) * (1 + m) < 2e-6


def test_large_classes_give_all_pairs(spark, monkeypatch):
    base = [f"từ{'bcdghk'[i % 6]}{chr(97 + i % 25)}{chr(97 + i // 6)}" for i in range(60)]
    texts = [(" , " if i % 2 else " ").join(base) + "." * i for i in range(70)] + [" ".join([*base[:55], "khác"]), " ".join(base)]
    rows = [("legal_docs", f"u{i:02}", "", t) for i, t in enumerate(texts)]
    want = {("legal_docs", a[1], b[1]) for a in rows for b in rows if a[1] < b[1]}
    df = spark.createDataFrame(rows, TEXT)
    for block in (1000, 9):
        monkeypatch.setattr(p6, "BLOCK", block, raising=False)
        got = [tuple(r) for r in p6.found(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize(("small", "large", "common"), [(1, 1, 1), (1, 2, 1), (2, 3, 2), (3, 4, 3), (3, 5, 3), (4, 8, 4), (6, 9, 5), (15, 30, 15)])
def test_short_sets_meet(small, large, common):
    rng = np.random.default_rng(small)
    for _ in range(100):
        x = rng.integers(0, 2**63, small + large - common, dtype=np.uint64)
        a, b = np.sort(x[:small]), np.sort(x[small - common :])
        assert len(np.intersect1d(p6.signatures(a), p6.signatures(b))) >= p6.SHARED


def test_small_sets_are_never_missed():
    rng = np.random.default_rng(11)
    for n in [*range(1, 41)] * 6:
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for m in range(-(-n // 2), 2 * n + 1):
            least = -(-(n + m) // 3)  # common features for a similarity of one half
            if least <= min(n, m):
                b = np.concatenate([a[:least], rng.integers(0, 1 << 63, m - least).astype(np.uint64)])
                shared = np.intersect1d(p6.signatures(np.sort(a)), p6.signatures(np.sort(b)))
                assert len(shared) >= p6.SHARED, (n, m)


# --- P5 ---
def test_passages_wrapped_in_many_ways_are_cut(spark):
    import random
    import textwrap

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeghiklmnopqrstuvxy") for _ in range(rng.randrange(2, 7)))
    passage, formal = (" ".join(word() for _ in range(60)) for _ in range(2))
    rows, bodies = [], {}
    for i in range(24):
        body = [" ".join(word() for _ in range(50)) for _ in range(2)]
        bodies[f"u{i:02}"] = body
        site = f"h{i % 3}"
        inside = passage if site == "h0" else ""
        rows.append(("legal_docs", f"u{i:02}", site, textwrap.fill(" ".join([body[0], inside, body[1], formal]), 30 + i)))
    df = spark.createDataFrame([*rows, rows[0], ("legal_docs", None, "h0", passage), ("legal_docs", "z", "h0", None)], TEXT)
    got = {r["uid"]: (r["raw_text"], r["passages_removed"]) for r in p5.cleaned(df).collect() if r["raw_text"]}
    for _, uid, site, text in rows:
        left, n = got[uid]
        flat = " ".join(left.split())
        assert all(b in flat for b in bodies[uid]) and formal in flat
        if site == "h0":
            assert n >= 1 and len(flat) < len(" ".join(text.split())) - len(passage) + 120
        else:
            assert n == 0 and left == text
    assert p5.passages(df.limit(0)).count() == 0
