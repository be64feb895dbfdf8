"""Operator 7 against brute force over every 200-byte string."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import repeats


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p:p + 200] for t in texts for p in range(len(t) - 199))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - 199):
            if seen[t[p:p + 200]] > 1:
                gone[p:p + 200] = True
        spans = int(((gone[1:] == 0) & (gone[:-1] == 1)).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _same(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in repeats.repeats(df).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_key_is_the_same_in_both_forms(spark):
    df = spark.createDataFrame([("abc",), ("é" * 9,), ("zzz" * 99,)], "text string")
    rows = df.select("text", repeats._key_of(df.text).alias("k")).collect()
    assert all(r.k == repeats.text_key(r.text.encode()) for r in rows)


@pytest.mark.parametrize("seed", [0, 1])
def test_passages_at_all_places_and_lengths(spark, seed):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghij é\n"))
    noise = lambda n: "".join(rng.choice(letters, n))
    shared = [noise(n) for n in (150, 190, 198, 199, 200, 201, 215, 230, 400, 900)]
    rows = []
    for _ in range(60):
        text = noise(int(rng.integers(0, 300))) if rng.random() < 0.7 else ""
        for _ in range(int(rng.integers(1, 4))):
            passage = shared[int(rng.integers(len(shared)))]
            a = int(rng.integers(0, 3)) * int(rng.integers(0, 40))
            text += passage[a:] + (noise(int(rng.integers(0, 300))) if rng.random() < 0.6 else "")
        rows.append(text)
    base = noise(3000)
    for _ in range(6):  # near copies
        cells = list(base)
        for _ in range(int(rng.integers(0, 12))):
            cells[int(rng.integers(3000))] = "#"
        rows.append("".join(cells))
    rows += [base, base, "x" * 1000, "xy" * 300, "x" * 199, "x" * 200, "", None]
    _same(spark, [(i, t) for i, t in enumerate(rows)])


def test_long_texts_are_worked_on_in_stretches(spark, monkeypatch):
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcd"), 5000))
    raw = np.frombuffer(text.encode(), np.uint8)
    keys = np.array([7], np.int64)
    whole = repeats.sample_positions(*repeats.padded(raw, np.array([0, 5000]), keys))
    monkeypatch.setattr(repeats, "STRETCH", 777)
    parts = repeats.sample_positions(*repeats.padded(raw, np.array([0, 5000]), keys))
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _same(spark, [tuple(r) for r in df.select("doc_id", "text").collect()])


def test_odd_rows(spark):
    rows = [(None, "ab" * 150), (1, "ab" * 150), (1, "ab" * 150), (2, None), (3, "")]
    _same(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeats.repeats(df.limit(0)).count() == 0
