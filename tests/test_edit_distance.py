"""The bit-parallel Levenshtein distance against the table of all cells."""

import random
import time

from pyspark.sql import functions as F

from tessera.functions import edit as ED
from tessera.functions import text as TX


def by_table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def test_distance_equals_the_table():
    rng = random.Random(3)
    for n in (0, 1, 2, 5, 31, 64, 65, 200, 399, 400, 401, 900):
        for m in (0, 1, 3, 64, 150):
            a = "".join(rng.choices("abđ😀 é"[:rng.choice([1, 2, 6])], k=n))
            b = "".join(rng.choices("abđ😀 éz", k=m))
            assert ED.edit_distance(a, b) == ED.edit_distance(b, a) == by_table(a, b)
            cut = a[:n // 3] + b[:4] + a[n // 2:]
            assert ED.edit_distance(a, cut) == by_table(a, cut)
            assert ED.lcs_length(a, cut) == ED.lcs_length(cut, a) >= len(a) - ED.edit_distance(a, cut)


def test_ratio_equals_the_built_in_and_keeps_nulls(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("abc đé\n", k=n))
    rows = [(text(rng.randrange(60)), text(rng.randrange(700))) for _ in range(60)]
    rows += [("", ""), ("", "x"), (None, "x"), ("x", None), ("same", "same")]
    df = spark.createDataFrame(rows, "a string, b string")
    m = F.greatest(F.length("a"), F.length("b"))
    built_in = F.when(m == 0, 1.0).otherwise(1 - F.levenshtein("a", "b") / m)
    for r in df.select(TX.edit_ratio("a", "b").alias("x"), built_in.alias("y")).collect():
        assert r.x == r.y


def test_long_texts_do_not_take_a_step_for_each_cell(spark):
    """40 pairs of 100,000 by 4,000 characters: 16 billion cells."""
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh ", k=100_000))
    df = spark.createDataFrame([(long[i:i + 4000], long) for i in range(40)], "a string, b string")
    df.select(TX.edit_ratio("a", "b")).limit(1).collect()
    begin = time.monotonic()
    assert df.filter(TX.edit_ratio("a", "b") > 0.039).count() == 40
    assert time.monotonic() - begin < 25
