"""The dense spaces over sparse rows: whole texts, repeated ids, null texts."""

import math
from collections import Counter

import numpy as np
import pytest

from tessera.functions import text as TX
from tessera.operators import lsa
from tessera.operators import search as S

DOCS = [(1, "aa bb bb cc"), (2, "aa dd dd dd"), (3, None), (4, "zz zz"), (5, "cc cc bb aa aa dd"),
        (2, "bb aa"), (6, ""), (7, "dd " * 300 + "cc")]
TERMS = ["dd", "aa", "bb", "cc"]


def dense(spark, form="smooth"):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    places = lsa.term_places(docs, "doc_id", TERMS, TX.word_tokens("text"))
    texts = {}
    for i, text in DOCS:
        texts.setdefault(i, Counter()).update(w for w in (text or "").split() if w in TERMS)
    df = {w: sum(w in c for c in texts.values()) for w in TERMS}
    idf = np.array([math.log(8 / (1 + df[w])) + 1 for w in TERMS])
    if form != "smooth":
        idf = np.array([math.log2(7 / df[w]) for w in TERMS])
    want = {}
    for i, c in texts.items():
        x = np.array([c[w] for w in TERMS]) * idf
        if x.any():
            want[i] = x / np.linalg.norm(x)
    return lsa.unit_vectors(places, idf), want


def test_sparse_rows_equal_the_long_form(spark, monkeypatch):
    monkeypatch.setattr(lsa, "BLOCK_ROWS", 2)
    got, want = dense(spark)
    rows = {r.id: dict(zip(r.terms, r["values"])) for r in got.collect()}
    assert sorted(rows) == sorted(want) == [1, 2, 5, 7]
    for i, x in want.items():
        assert [rows[i].get(j, 0.0) for j in range(4)] == pytest.approx(list(x))
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    long_form, _ = S.corpus_tfidf(docs.filter("text NOT LIKE 'zz%' OR text IS NULL OR doc_id = 4"), "doc_id")
    by_long = {(r.id, r.term): r.w for r in long_form.collect() if r.id != 4}
    assert by_long == pytest.approx({(i, TERMS[j]): x for i, v in rows.items() for j, x in v.items()})


def test_pca_and_lsi_over_sparse_rows_equal_numpy(spark):
    got, want = dense(spark)
    x = np.stack([want[i] for i in sorted(want)])
    values, axes = np.linalg.eigh(np.cov(x.T))
    pca = lsa.fit_pca(got, 2, 4)
    assert pca.mean == pytest.approx(x.mean(0)) and pca.deviation == pytest.approx(x.std(0, ddof=1))
    assert np.abs(pca.components) == pytest.approx(np.abs(axes[:, ::-1][:, :2]), abs=1e-7)
    assert lsa.spectrum(got, 4) == pytest.approx(np.maximum(values[::-1], 0), abs=1e-12)
    rest = (x - x.mean(0)) - (x - x.mean(0)) @ pca.components @ pca.components.T
    row = lsa.reconstruction_error(pca, got, 4).first()
    assert row.rmse == pytest.approx(math.sqrt((rest ** 2).mean()))
    assert row.mean_feature_std == pytest.approx(x.std(0, ddof=1).mean())
    V = lsa.fit_lsi(got, 2, 4)
    assert np.abs(V) == pytest.approx(np.abs(np.linalg.svd(x)[2][:2].T), abs=1e-7)
    projected = {r.id: r.vec for r in lsa.project(got, V, dim=4).collect()}
    assert {i: list(v) for i, v in projected.items()} == {i: pytest.approx(list(want[i] @ V)) for i in want}


def test_gram_matrix_with_ones(spark):
    got, want = dense(spark)
    x = np.stack([np.append(want[i], 1.0) for i in want])
    assert lsa.gram_matrix(got, 4, ones=True) == pytest.approx(x.T @ x)
