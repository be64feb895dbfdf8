"""Operator 4 against brute force over all pairs of full shingle sets."""

import re

import numpy as np
import pytest

from tessera.llm import near_dedup


def _sets(texts):
    out = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5
                   else ({tuple(w)} if w else set()))
    return out


def brute(rows):
    """{doc_id: (n_shingles, component_id)} by comparing every pair."""
    ids, sets = [r[0] for r in rows], _sets([r[1] for r in rows])
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 75 * max(len(a), len(b)):
                if 100 * len(a & b) >= 75 * len(a | b):
                    x, y = find(ids[i]), find(ids[j])
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def _same(out, rows):
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_distance_counts_symbols(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 4, (50, 48)).astype(np.uint64)
    b = rng.integers(0, 4, (50, 48)).astype(np.uint64)

    def words(x):
        return [[int(sum(int(v) << (16 * i) for i, v in enumerate(c))) - (1 << 64)
                 * (int(c[3]) >> 15) for c in row.reshape(12, 4)] for row in x]

    names = [f"{p}{i}" for p in "ab" for i in range(12)]
    df = spark.createDataFrame([x + y for x, y in zip(words(a), words(b))], names)
    from pyspark.sql import functions as F
    cols = [F.struct(*[F.col(f"{p}{i}").alias(f"s{i}") for i in range(12)]).alias(p) for p in "ab"]
    got = [r[0] for r in df.select(*cols).select(near_dedup._distance("a", "b")).collect()]
    assert got == (a != b).sum(1).tolist()


@pytest.mark.parametrize("seed", [0, 1])
def test_chains_stars_and_borders(spark, seed):
    """Edited copies around 0.75, chains of copies of copies, shared passages."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = list(rng.choice(words, 60))
    rows = []
    for _ in range(25):
        base = list(rng.choice(words, int(rng.integers(30, 200))))
        last = base
        for k in range(int(rng.integers(1, 14))):
            last = list(last if k % 2 else base)
            for _ in range(int(rng.integers(0, max(2, len(last) // 25)))):
                last[int(rng.integers(len(last)))] = str(rng.choice(words))
            rows.append(" ".join(last).upper() if k % 5 == 0 else "\t".join(last))
    rows += [" ".join([*passage, *rng.choice(words, int(rng.integers(5, 60)))]) for _ in range(80)]
    rows = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _same(near_dedup.near_duplicates(df).collect(), rows)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    _same(near_dedup.near_duplicates(df).collect(), rows)


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t", 0), (4, "a b", 0), (5, "A  B", 0), (6, "a", 0),
            (7, "x " * 90_000, 0), (8, "x x x x x", 0), (8, "x x x x x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    out = near_dedup.near_duplicates(df).collect()
    assert len(out) == 9
    assert {r.doc_id: r.component_id for r in out} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7}
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0
    stay = near_dedup.drop_near_copies(df)
    assert stay.columns == df.columns
    assert sorted(r.doc_id for r in stay.collect()) == [1, 2, 3, 4, 6, 7]
    null = df.union(spark.createDataFrame([(None, "a b", 0), (None, None, 0)], df.schema))
    got = [r for r in near_dedup.near_duplicates(null).collect() if r.doc_id is None]
    assert sorted(((r.n_shingles, r.component_id) for r in got)) == [(0, None), (1, 4)]
