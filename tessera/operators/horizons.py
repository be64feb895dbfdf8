"""Per-user sequence logic (survey 2E): first active day, horizons, labels,
slopes and interest trends.

Inputs are the engagement / learning-detail extracts, which are at
(user, day, action) grain: a user contributes at most a few rows per active
day, so every per-user window below sorts a bounded group.  Nothing is looped
per user; slopes and "last minus first" are closed-form aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

USER = "UserID"
NTH = "nth_day_from_registration"


# E01 -------------------------------------------------------------------------
def first_active_day(df: DataFrame, user: str = USER, day: str = NTH) -> DataFrame:
    """``MinFirstDay`` (first active day since registration), ``ZeroDay``
    (``zero``/``other``) and ``lateUser`` (first active day > 0)."""
    w = Window.partitionBy(user)
    return (df.withColumn("MinFirstDay", F.min(day).over(w))
              .withColumn("ZeroDay", F.when(F.col("MinFirstDay") == 0, "zero").otherwise("other"))
              .withColumn("lateUser", (F.col("MinFirstDay") > 0).cast("int")))


# E02 -------------------------------------------------------------------------
def cutoff_exclusive(df: DataFrame, n_days: int = 3, user: str = USER,
                     day: str = NTH) -> DataFrame:
    """Keep rows with ``nth < MinFirstDay + N``; add ``cutoffDay`` and
    ``usedDays = nth - MinFirstDay``."""
    out = first_active_day(df, user, day).drop("ZeroDay")
    out = out.withColumn("cutoffDay", F.col("MinFirstDay") + F.lit(n_days))
    out = out.filter(F.col("cutoffDay") - F.col(day) > 0)
    return out.withColumn("usedDays", F.col(day) - F.col("MinFirstDay"))


# E03 / E04 ---------------------------------------------------------------------
def active_days(df: DataFrame, horizons: Sequence[int] | int = 1, gap: str = "gapday",
                user: str = USER, day: str = NTH) -> DataFrame:
    """Inclusive horizon(s): a row is kept for horizon ``N`` when
    ``nth <= MinFirstDay + N``.  Adds ``horizon``, ``CutoffDay``,
    ``ScaleActionDay = nth - MinFirstDay`` and ``ScaleGapday = gap -
    MinFirstDay`` (NULL for users who never paid).

    With several horizons a row is emitted once per horizon that contains it
    (an ``explode`` of the qualifying horizons — no join), so all horizons
    are computed in one pass with ``horizon`` as a grouping key."""
    hs = [horizons] if isinstance(horizons, int) else sorted(set(horizons))
    out = first_active_day(df, user, day) if "MinFirstDay" not in df.columns else df
    used = F.col(day) - F.col("MinFirstDay")
    qualifying = F.filter(F.array(*[F.lit(h) for h in hs]), lambda h: h >= used)
    out = out.withColumn("horizon", F.explode(qualifying))
    return (out.withColumn("CutoffDay", F.col("MinFirstDay") + F.col("horizon"))
               .withColumn("ScaleActionDay", used)
               .withColumn("ScaleGapday", F.col(gap) - F.col("MinFirstDay")))


# E05 - E07 ---------------------------------------------------------------------
def label_relative(gap: Column | str, min_first_day: Column | str, mark_day: int = 30) -> Column:
    """Label A: paid within ``mark_day`` days of the first active day."""
    g = F.col(gap) if isinstance(gap, str) else gap
    m = F.col(min_first_day) if isinstance(min_first_day, str) else min_first_day
    return F.coalesce((g - m) <= mark_day, F.lit(False)).cast("int")


def label_absolute(gap: Column | str, days: int = 31) -> Column:
    """Label B: paid within ``days`` days of registration."""
    g = F.col(gap) if isinstance(gap, str) else gap
    return F.coalesce(g <= days, F.lit(False)).cast("int")


def label_scaled(scaled_gap: Column | str, days: int = 31) -> Column:
    """Label C: ``ScaleGapday <= days`` (a user-level max of ScaleGapday)."""
    return label_absolute(scaled_gap, days)


def set_label(events: DataFrame, payment: DataFrame, mark_day: int = 30,
              user: str = USER) -> DataFrame:
    """E05 applied to rows: left-join the payer gap and label each row."""
    pay = payment.select(user, "gapday")
    out = events.join(pay, user, "left")
    return out.withColumn("Label", label_relative("gapday", "MinFirstDay", mark_day))


# E08 / E09 ---------------------------------------------------------------------
def ols_slope(x: str, y: str) -> Column:
    """Least-squares slope of y on x as an aggregate; 0 when x is constant."""
    n = F.count(F.col(y))
    sx, sy = F.sum(x), F.sum(y)
    sxy, sxx = F.sum(F.col(x) * F.col(y)), F.sum(F.col(x) * F.col(x))
    den = n * sxx - sx * sx
    return F.when(den == 0, F.lit(0.0)).otherwise((n * sxy - sx * sy) / den)


def scaled_slope(x: str, y: str) -> Column:
    """``r · sy / sx`` with sample standard deviations and
    ``r = Σdxdy / (n·sx·sy)`` — i.e. ``covar_pop / var_samp(x)``; 0 when either
    series is constant; NULL for a single point."""
    n = F.count(F.col(y))
    vx, vy = F.var_samp(x), F.var_samp(y)
    return (F.when(n < 2, F.lit(None).cast("double"))
             .when((vx == 0) | (vy == 0), F.lit(0.0))
             .otherwise(F.covar_pop(x, y) / vx))


# E10 -------------------------------------------------------------------------
def successive_diff(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    absolute: bool = False, out: str = "diff") -> DataFrame:
    """Differences of consecutive values within each key, in ``order``.
    A group of a single row yields one row with 0 (as the reference)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    d = F.col(value) - F.lag(value).over(w)
    if absolute:
        d = F.abs(d)
    cnt = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rn = F.row_number().over(w)
    res = df.withColumn(out, d).withColumn("_n", cnt).withColumn("_rn", rn)
    res = res.filter((F.col("_rn") > 1) | (F.col("_n") == 1))
    return res.withColumn(out, F.coalesce(F.col(out), F.lit(0.0))).drop("_n", "_rn")


# E11 -------------------------------------------------------------------------
def interest_by_action(eng: DataFrame, day: str = "usedDays", user: str = USER,
                       action: str = "ActionType") -> DataFrame:
    """Per (user, action): interest = UsageTime·Records; its total, mean,
    accumulated change (telescopes to last − first in day order) and the
    normalised scaled slope ``slope / mean``."""
    e = eng.withColumn("interest", F.col("UsageTime") * F.col("Records"))
    # Tie-break the day order by EventDate so "first"/"last" are defined.
    order = F.struct(F.col(day), F.col("EventDate"))
    g = e.groupBy(user, action).agg(
        F.sum("interest").alias("total_interest"),
        F.avg("interest").alias("average_interest"),
        (F.max_by("interest", order) - F.min_by("interest", order)).alias("accumulate"),
        scaled_slope(day, "interest").alias("slope"))
    return g.withColumn("Slope_norm", F.try_divide(F.col("slope"), F.col("average_interest")))


# E12 / E13 ---------------------------------------------------------------------
def most_interest(interest: DataFrame, user: str = USER, action: str = "ActionType") -> DataFrame:
    """Per user: the action with the largest total interest (ties → first
    action name), its share of all interest and its trend; and the action
    with the largest accumulated change, its share of Σ|accumulate| and trend."""
    top_total = F.struct(-F.col("total_interest"), F.col(action))
    top_acc = F.struct(-F.col("accumulate"), F.col(action))
    g = interest.groupBy(user).agg(
        F.min_by(action, top_total).alias("MostInterest"),
        F.min_by("total_interest", top_total).alias("_ti"),
        F.min_by("Slope_norm", top_total).alias("_it"),
        F.sum("total_interest").alias("_sum_ti"),
        F.min_by(action, top_acc).alias("MostAccumulate"),
        F.min_by("accumulate", top_acc).alias("_acc"),
        F.min_by("Slope_norm", top_acc).alias("_at"),
        F.sum(F.abs("accumulate")).alias("_sum_acc"))
    ratio = lambda num, den: F.when(F.col(den) == 0, F.lit(0.0)).otherwise(F.col(num) / F.col(den))
    nan0 = lambda c: F.when(F.isnan(F.col(c)) | F.col(c).isNull(), F.lit(0.0)).otherwise(F.col(c))
    return g.select(
        user, "MostInterest",
        ratio("_ti", "_sum_ti").alias("TotalInterestRatio"),
        nan0("_it").alias("InterestTrend"),
        "MostAccumulate",
        ratio("_acc", "_sum_acc").alias("TotalAccuRatio"),
        nan0("_at").alias("AccuTrend"))
