"""Text and search operators: fixtures, and metamorphic checks of the
distributed plans against brute force on small inputs."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import textops as TO


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_formula_split(spark):
    df = spark.createDataFrame([(r"\(a\) b \(c=1\)",)], "t string")
    r = df.select(TX.formulas("t").alias("f"), TX.strip_formulas("t").alias("s"),
                  TX.operator_formulas(TX.formulas("t")).alias("op")).first()
    assert r.f == [r"\(a\)", r"\(c=1\)"]
    assert r.s == " b "
    assert r.op == [r"\(c=1\)"]


def test_clean_full(spark):
    df = spark.createDataFrame([("Hello,  WORLD!! 007 x0 Đà-nẵng",)], "t string")
    assert df.select(TX.clean_full("t")).first()[0] == "hello world 7 x0 đà nẵng"


def test_text_kind(spark):
    df = spark.createDataFrame([("plain words here",), (r"\(x+1\)",), (r"solve this now \(x=1\)",)], "t string")
    kinds = [r.k for r in df.select(*TX.kind_parts("t")).select(TX.text_kind_from(2).alias("k")).collect()]
    assert kinds == ["Text only", "Math only", "Math and Text"]


def test_edit_ratio_matches_brute_force(spark):
    pairs = [("kitten", "sitting"), ("élan", "elan"), ("", ""), ("abc", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.r for r in df.select(TX.edit_ratio("a", "b").alias("r")).collect()]
    want = [1.0 if max(len(a), len(b)) == 0 else 1 - _lev(a, b) / max(len(a), len(b)) for a, b in pairs]
    assert got == pytest.approx(want)


def test_sequence_cosine_zero_padding(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0]), ([], [1.0])], "a array<double>, b array<double>")
    got = [r.c for r in df.select(TX.sequence_cosine("a", "b").alias("c")).collect()]
    assert got[0] == pytest.approx(5 / (math.sqrt(14) * math.sqrt(5)))
    assert got[1] == 0.0


def test_operator_majority_tests_math_first(spark):
    rows = [("hello world",), (r"\(x^2\)",), (r"one two three four five six \(x^2\)",),
            (r"one two three four five six \(x\)",), ("one two three four five six",)]
    df = spark.createDataFrame(rows, "t string").select(*TX.kind_parts("t"))
    assert [r[0] for r in df.select(TX.text_kind_majority_from()).collect()] == [
        "Math only", "Math only", "Math and Text", "Text only", "Text only"]


def test_non_ascii_share_ignores_formulas_and_punctuation(spark):
    rows = [("word\u2019 plain",), ("caf\u00e9 12 x \\(\u00e9\\) abc",), ("1 22",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(TX.non_ascii_share("t", "word")).collect()]
    assert got[0] == 0 and got[2] == -1
    assert got[1] == pytest.approx(0.5)


def test_dense_ids_match_sorted_order(spark):
    words = ["pear", "apple", "fig", "kiwi", "apple", "date", "banana", "cherry"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.id for r in TO.dense_ids(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted(set(words)))}


def test_salted_join_equals_plain_join(spark):
    from tessera.operators.joins import salted_equi_join

    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "id int, key string")
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("k6", 3)], "key string, v int")
    a = sorted(tuple(r) for r in salted_equi_join(big, small, "key", salts=4).select("id", "v").collect())
    b = sorted(tuple(r) for r in big.join(small, "key").select("id", "v").collect())
    assert a == b


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclid"])
def test_dense_top_k_equals_brute_force(spark, monkeypatch, metric):
    """Small blocks and slices, equal vectors and a zero vector."""
    import numpy as np
    from tessera.operators import lsa

    monkeypatch.setattr(lsa, "BLOCK_ROWS", 7)
    monkeypatch.setattr(lsa, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(0)
    D = rng.integers(-2, 3, size=(60, 4)).astype(float)
    D[5] = 0
    Q = np.concatenate([rng.normal(size=(6, 4)), D[3:5]])
    docs = spark.createDataFrame([(i, D[i].tolist()) for i in range(60)], "id long, vec array<double>")
    qs = spark.createDataFrame([(100 + i, Q[i].tolist()) for i in range(8)], "id long, vec array<double>")
    found = lsa.dense_top_k(qs, docs.repartition(4), 5, metric, max_bytes=100).collect()
    got = sorted((r.query_id, r.rank, r.doc_id) for r in found)
    want = []
    for i in range(8):
        if metric == "euclid":
            s = -np.sqrt(((D - Q[i]) ** 2).sum(1))
        else:
            s = D @ Q[i]
            if metric == "cosine":
                n = np.linalg.norm(D, axis=1) * np.linalg.norm(Q[i])
                s = s / np.where(n == 0, 1, n)
        s = np.round(s, 10)
        want += [(100 + i, rank, j) for rank, j in enumerate(sorted(range(60), key=lambda j: (-s[j], j))[:5], 1)]
    assert got == sorted(want)


def test_whole_spectrum_equals_numpy(spark):
    import numpy as np
    from tessera.operators import lsa

    x = np.random.default_rng(1).normal(size=(80, 7)) * np.arange(1, 8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert lsa.spectrum(df.repartition(3)) == pytest.approx(values)
    rows = sorted(tuple(r) for r in lsa.explained_variance(df, 3).collect())
    assert [k for k, _ in rows] == [0, 3, 6, 7]
    assert [c for _, c in rows] == pytest.approx([0, values[:3].sum() / values.sum(),
                                                  values[:6].sum() / values.sum(), 1])


def test_dedup_first_keeps_smallest_id(spark):
    df = spark.createDataFrame([(3, "x", "a"), (1, "x", "b"), (2, "y", "c")], "id int, t string, v string")
    got = sorted((r.id, r.v) for r in TO.dedup_first(df, ["t"], "id").collect())
    assert got == [(1, "b"), (2, "c")]


def test_fuzzy_score_bounds(spark):
    pairs = list(itertools.product(["a b c", "c b a", "x"], repeat=2))
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select(TX.fuzzy_score("a", "b").alias("s"), "a", "b").collect():
        assert 0.0 <= r.s <= 1.0
        if sorted(r.a.split()) == sorted(r.b.split()):
            assert r.s == 1.0


def test_containment_finds_short_and_word_cutting_passages(spark, tmp_path):
    from tessera.plans import search_plans as SP
    from tessera.sources.tables import Tables

    docs = [(1, "the alphabet soup is warm"), (2, "cold soup"), (3, "a warm soup is here")]
    passages = [(1, "phabet so"), (2, "lphabe"), (3, "soup is"), (4, "soup is warm"), (5, "bread is soup"),
                (6, "t soup is w"), (7, ""), (8, "p"), (9, "warm"), (10, "zq"), (11, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs],
                               "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(passages, "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    t = Tables(spark, str(tmp_path))
    truth = sorted(tuple(r) for r in SP.containment_truth(t).collect())
    want = sorted((q, d) for q, p in passages for d, x in docs if p is not None and p in x)
    assert truth == want
    plan = SP.containment_truth(t)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    out = {r.query_id: r.outcome for r in SP.search_evaluation(t).collect()}
    assert set(out) == set(range(1, 12)) and out[5] == "No result"


# Character classes of the cleaners -------------------------------------------------
def plain_clean_full(col):
    t = F.regexp_replace(F.lower(F.col(col)), f"[^a-z0-9{TX.VIET_LETTERS}]+", " ")
    return TX.squeeze(F.regexp_replace(t, "(^| )0+", "$1"))


def plain_accent_delete(col):
    return TX.squeeze(F.regexp_replace(F.lower(F.col(col)), f"[{TX.VIET_LETTERS}_]", ""))


def plain_letters(col):
    t = F.translate(F.col(col), TX.PUNCT_FILTERS, " " * len(TX.PUNCT_FILTERS))
    return F.lower(F.regexp_replace(t, r"\d+", ""))


def plain_words(col):
    return F.regexp_extract_all(F.lower(F.col(col)), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)


def test_cleaners_equal_plain_classes(spark):
    import random

    rng = random.Random(5)
    signs = TX.VIET_LETTERS + TX.VIET_LETTERS.upper() + TX.PUNCT_FILTERS + \
        "'abcxyzABZ0012 09   \n\t\r\x00\x7f\x80ÿéßŸœıİſΣς١²½Ⅷ漢ひ😀𝔘𝟘́"
    texts = ["".join(rng.choices(signs, k=rng.choice([0, 1, 3, 10, 60]))) for _ in range(3000)]
    texts += [None, "0", " 00 0 007 a0 0a", "x\n0 0"]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    pairs = {"full": (TX.clean_full("t"), plain_clean_full("t")),
             "accent": (TX.clean_accent_delete("t", True), plain_accent_delete("t")),
             "letters": (TX.clean_letters("t"), plain_letters("t")),
             "words": (TX.word_tokens("t"), plain_words("t"))}
    assert df.agg(*[F.count_if(~a.eqNullSafe(b)).alias(k) for k, (a, b) in pairs.items()]
                  ).first().asDict() == dict.fromkeys(pairs, 0)


def test_long_classes_stand_behind_a_range_test(spark):
    """Else java.util.regex tests some 60 letters for each ASCII character."""
    assert TX.VIET_LETTERS in TX._VIET and TX._VIET.startswith("[\\x{80}-") and "&&" in TX.WORD_RE
