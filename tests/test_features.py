"""Unit tests for the per-user feature operators on hand-made fixtures
"""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import horizons as H
from tessera.operators import transforms as T


def _slope(spark, xs, ys, fn):
    df = spark.createDataFrame([(1, float(x), float(y)) for x, y in zip(xs, ys)], "g int, x double, y double")
    return df.groupBy("g").agg(fn("x", "y").alias("s")).first()["s"]


@pytest.mark.parametrize("xs,ys,expected", [
    ([0, 1, 2, 3], [1, 2, 3, 4], 1.0),
    ([1, 2, 3, 4], [1, 2, 3, 4], 1.0),
    ([0, 1, 2, 3], [1, 0.74, 0.56, 0.2], -0.258),
    ([0, 1, 2, 3], [1, 1.5, 1.75, 2], 0.325),
    ([0, 1, 2, 3, 4], [1, 1.5, 1.25, 2, 1.1], 0.07),
])
def test_ols_slope_reference_inputs(spark, xs, ys, expected):
    assert _slope(spark, xs, ys, H.ols_slope) == pytest.approx(expected, abs=5e-4)


def test_ols_slope_constant_x_is_zero(spark):
    assert _slope(spark, [2, 2, 2], [1, 5, 9], H.ols_slope) == 0.0


def test_scaled_slope_is_ols_times_n_minus_1_over_n(spark):
    xs, ys = [0, 1, 2, 3], [1, 0.74, 0.56, 0.2]
    ols = _slope(spark, xs, ys, H.ols_slope)
    scaled = _slope(spark, xs, ys, H.scaled_slope)
    assert scaled == pytest.approx(ols * 3 / 4)


def test_scaled_slope_single_point_is_null(spark):
    assert _slope(spark, [1], [5], H.scaled_slope) is None


def test_successive_diff_single_row_gives_zero(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 1.0), (2, 2, 4.0), (2, 3, 2.0)],
                               "u int, d int, v double")
    out = H.successive_diff(df, ["u"], ["d"], "v").orderBy("u", "d").collect()
    assert [(r.u, r.diff) for r in out] == [(1, 0.0), (2, 3.0), (2, -2.0)]


def test_most_interest_tie_picks_first_action_name(spark):
    rows = [(1, "Learn", 10.0, 5.0, 1.0, 0.1), (1, "Discovery", 10.0, 5.0, 2.0, 0.2),
            (1, "Entertainment", 3.0, 1.0, 2.0, None)]
    df = spark.createDataFrame(rows, "UserID int, ActionType string, total_interest double, "
                                     "average_interest double, accumulate double, Slope_norm double")
    r = H.most_interest(df).first()
    assert r.MostInterest == "Discovery"
    assert r.TotalInterestRatio == pytest.approx(10 / 23)
    assert r.MostAccumulate == "Discovery"          # tie on 2.0 → first name
    assert r.TotalAccuRatio == pytest.approx(2 / 5)


def test_label_null_gap_is_zero(spark):
    df = spark.createDataFrame([(None, 0), (3, 0), (40, 5)], "gapday int, MinFirstDay int")
    out = df.select(H.label_relative("gapday", "MinFirstDay", 30).alias("l")).collect()
    assert [r.l for r in out] == [0, 1, 0]


def test_active_days_multi_horizon_explodes_only_qualifying(spark):
    df = spark.createDataFrame([(1, 2, 5), (1, 3, 5), (1, 6, 5)],
                               "UserID int, nth_day_from_registration int, gapday int")
    out = H.active_days(df, [1, 2, 8]).groupBy("horizon").count().orderBy("horizon").collect()
    # first active day 2: day 2 → all horizons; day 3 → h ≥ 1; day 6 (used 4) → h = 8
    assert [(r.horizon, r["count"]) for r in out] == [(1, 2), (2, 2), (8, 3)]


def test_mode_tie_picks_smallest(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (1, 5), (1, 3), (1, 9)], "u int, h int")
    assert df.groupBy("u").agg(F.mode("h", True).alias("m")).first().m == 3


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(5,), (6,), (10,), (15,), (20,), (21,), (None,)], "d int")
    out = [r.b for r in df.select(T.bin_right_closed("d").alias("b")).collect()]
    assert out == ["Very low", "Low", "Low", "Medium", "High", "Very high", None]


def test_collapse_rare_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "DeviceBrand string")
    out = sorted((r.DeviceBrand or "") for r in T.collapse_rare(df, "DeviceBrand").collect())
    assert out == ["", "Other brand", "a", "a", "a"]


def test_count_distinct_with_null_counts_null_once(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (1, None), (1, "y")], "u int, v string")
    assert df.groupBy("u").agg(A.count_distinct_with_null("v").alias("n")).first().n == 3


def test_pivot_fixed_values_fills_zero(spark):
    df = spark.createDataFrame([(1, "Learn", 2.0), (2, "Discovery", 1.0)], "UserID int, a string, m double")
    out = A.pivot_agg(df, "UserID", "a", ["Discovery", "Learn"], {"M": "m"}).orderBy("UserID").collect()
    assert [(r.MDiscovery, r.MLearn) for r in out] == [(0.0, 2.0), (1.0, 0.0)]


def test_log_transform_shifts_zero_min_columns(spark):
    df = spark.createDataFrame([(0.0, 1.0), (math.e - 1, math.e)], "a double, b double")
    out = T.log_transform(df, ["a", "b"]).collect()
    assert out[0].a == pytest.approx(0.0) and out[1].a == pytest.approx(1.0)
    assert out[0].b == pytest.approx(0.0) and out[1].b == pytest.approx(1.0)


def test_duplicate_audit(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    r = A.duplicate_audit(df).first()
    assert (r.rows, r.distinct_rows, r.duplicate_rows) == (3, 2, 1)


def test_unlisted_brands_get_a_column(spark):
    from tessera.operators import aggregates as A
    from tessera.operators import transforms as T

    logs = spark.createDataFrame([(1, "nokia"), (1, "zz new"), (2, "zz new"), (2, "zz new"), (3, None)],
                                 "UserID long, DeviceBrand string")
    values = T.found_values(logs, "DeviceBrand")
    assert values == ["nokia", "zz new"]
    got = {r.UserID: (r.nokia, r["zz new"], r.n_brands) for r in A.brand_matrix(logs, values).collect()}
    assert (got[1], got[2][1:]) == ((1, 1, 2), (2, 1)) and got[3][2] == 0
    with pytest.raises(ValueError):
        T.found_values(logs, "DeviceBrand", most=1)
