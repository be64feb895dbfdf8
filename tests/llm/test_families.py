"""Operator 4: large families of near copies, cell by cell."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import near_dedup

from .test_near_dedup import _same


def stray_copies(n, edits=9):
    """Copies of one text of which many are too far from each other to link."""
    rng = np.random.default_rng(3)
    base = list(rng.choice([f"w{i}" for i in range(500)], 150))
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(int(rng.integers(0, edits))):
            copy[int(rng.integers(150))] = f"new{int(rng.integers(10**6))}"
        rows.append((1000 - i, " ".join(copy)))
    return rows


def test_family_of_stray_copies(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK_ROWS", 30)
    rows = stray_copies(240)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _same(near_dedup.near_duplicates(df).collect(), rows)


def _keyed(spark, pairs):
    rows = spark.createDataFrame(sorted(set(pairs)), "key long, id long")
    return rows.join(rows.groupBy("key").agg(F.min("id").alias("first")), "key")


def test_a_family_is_connected_by_one_edge_a_class(spark, monkeypatch):
    edges = []
    real = near_dedup.materialise

    def counted(df, name):
        out = real(df, name)
        if name == "least-edges":
            edges.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "materialise", counted)
    n = 600
    pairs = [(k, i) for i in range(n) for k in (i % 7, 10 + i % 11, 30 + i % 13, 50 + i // 100)]
    member = near_dedup._families(_keyed(spark, pairs)).collect()
    assert sorted(r.id for r in member) == list(range(n)) and {r.family for r in member} == {0}
    assert edges[0] < n and sum(edges) < 1.2 * n


@pytest.mark.parametrize("seed", [5, 6])
def test_families_are_the_components_of_shared_keys(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [(int(rng.integers(60)), int(rng.integers(200))) for _ in range(150)]
    root = list(range(200))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first, sizes = {}, Counter(k for k, _ in set(pairs))
    for k, i in pairs:
        a, b = find(first.setdefault(k, i)), find(i)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.family for r in near_dedup._families(_keyed(spark, pairs)).collect()}
    met = {i for k, i in pairs if sizes[k] > 1}
    assert got == {i: find(i) for i in met}
