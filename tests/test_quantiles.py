"""Exact percentiles and segmented AUC against plain forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import models as M
from tessera.operators.quantiles import exact_percentiles


def test_percentiles_equal_numpy_for_groups_of_any_size(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(x)) for x in rng.integers(0, 50, 4000)]
    rows += [(None, float(x)) for x in rng.normal(size=300)]
    rows += [(f"g{i}", float(x)) for i in range(40) for x in rng.normal(size=i % 5)]
    rows += [("hot", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: (r.a, r.b, r.c) for r in exact_percentiles(
        df, ["k"], "x", {"a": 0.0, "b": 0.3, "c": 0.75}).collect()}
    groups = {}
    for k, x in rows:
        if x is not None:
            groups.setdefault(k, []).append(x)
    assert got.keys() == groups.keys()
    for k, x in groups.items():
        assert got[k] == pytest.approx(np.quantile(x, [0, 0.3, 0.75]))
    boxes = {r.k: r for r in A.box_stats(df, ["k"], "x").collect()}
    assert boxes["nothing"].q1 is None and boxes[None].q3 == pytest.approx(np.quantile(groups[None], 0.75))


def test_percentiles_of_a_million_distinct_values(spark):
    df = spark.range(1_000_001).select(((F.col("id") * 7919) % 1_000_001).alias("v"))
    row = A.column_profile(df, ["v"]).first()
    assert (row["count"], row.nulls, row.q1, row.q2, row.q3) == (1_000_001, 0, 250_000, 500_000, 750_000)


def test_profile_of_an_empty_table(spark):
    row = A.column_profile(spark.createDataFrame([], "a int, b double"), ["a", "b"]).collect()
    assert sorted(r["column"] for r in row) == ["a", "b"] and all(r["count"] == 0 for r in row)


def test_auc_of_segments_equals_auc_of_each(spark):
    rng = np.random.default_rng(2)
    rows = [(f"s{i % 4}", int(rng.integers(2)), float(rng.integers(30)) / 10) for i in range(2000)]
    rows += [("one class", 1, 0.5), ("one class", 1, 0.7)]
    df = spark.createDataFrame(rows, "seg string, Label int, score double")
    got = {r.seg: r.auc for r in M.auc_by(df, ["seg"]).collect()}
    for s in ("s0", "s3"):
        assert got[s] == pytest.approx(M.auc(df.filter(F.col("seg") == s)).first()["auc"])
    assert got["one class"] is None


def test_permuted_rows_permute_one_feature(spark):
    df = spark.createDataFrame([(i, i % 2, float(i), float(-i)) for i in range(97)],
                               "k long, Label int, a double, b double")
    rows = M.permuted_rows(df, ["a", "b"], "k", repeats=3).collect()
    assert len(rows) == 97 * 7
    for f, other in (("a", "b"), ("b", "a")):
        for r in (1, 2, 3):
            own = [x for x in rows if (x.feature, x.repeat) == (f, r)]
            assert sorted(x[f] for x in own) == sorted(r_[f] for r_ in df.collect())
            assert all(x[other] == (x.k if other == "a" else -x.k) for x in own)
            assert sum(abs(x[f]) != x.k for x in own) > 60


def test_an_informative_feature_is_more_important(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(x > 0), float(x), float(rng.normal())) for i, x in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "k long, Label int, good double, noise double")
    model = M.fit_pipeline(df, ["good", "noise"], "tree")
    got = {r.feature: r.importance for r in M.permutation_importance(
        model, df, ["good", "noise"], "k", repeats=3).collect()}
    assert got["good"] > 0.3 > abs(got["noise"])


def test_the_permuted_rows_are_never_broadcast(spark, monkeypatch):
    """One wide row for each feature and repeat: what is broadcast are the test
    rows at most, and nothing if they are too large; both give the same rows."""
    names = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, i % 2, *[float(i * j) for j in range(8)]) for i in range(50)],
                               "k long, Label int, " + ", ".join(f"{c} double" for c in names))
    found = []
    for fits in (True, False):
        monkeypatch.setattr(M, "fits_broadcast", lambda rows, fits=fits: fits)
        rows = M.permuted_rows(df, names, "k", repeats=20)
        found.append(sorted(map(tuple, rows.collect())))
        plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        joins = [line for line in plan.splitlines() if "HashJoin" in line or "MergeJoin" in line]
        assert len(joins) == 1 and ("BroadcastHashJoin" in joins[0]) == fits
        assert not fits or "BuildRight" in joins[0]
    assert found[0] == found[1] and len(found[0]) == 50 * (8 * 20 + 1)
