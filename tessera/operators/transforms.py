"""Feature transforms (survey 2F).

Data-dependent transforms (rare-brand collapse, tiers, log, scaling) compute
their statistics with one small aggregate that stays inside the same lazy
plan: a scalar subquery (``DataFrame.scalar()``) for single values.  A
per-category table (one row per category) is joined back on the category
without a hint: AQE broadcasts it by its measured size, and beyond that splits
the rows of a hot category over tasks.  No job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))


# F01 -------------------------------------------------------------------------
def collapse_rare(df: DataFrame, col: str, other: str = "Other brand") -> DataFrame:
    """Categories whose row count is below the mean count per category
    become ``other``; NULL stays NULL."""
    c = _counts(df, col)
    mean = c.agg(F.avg("_cnt")).scalar()                  # scalar subquery, lazy
    rare = c.filter(F.col("_cnt") < mean).select(col, F.lit(1).alias("_rare"))
    j = df.join(rare, col, "left")
    return j.withColumn(col, F.when(F.col("_rare") == 1, F.lit(other)).otherwise(F.col(col))) \
            .drop("_rare")


# F02 -------------------------------------------------------------------------
def frequency_tier(df: DataFrame, col: str, big: int = 100_000, medium: int = 10_000,
                   out: str = "TypeBrand") -> DataFrame:
    """``Big`` if the category's row count ≥ big, ``Medium`` if ≥ medium,
    else ``Small`` (NULL → Small).  Thresholds are parameters."""
    c = _counts(df, col)
    tier = F.when(F.col("_cnt") >= big, "Big").when(F.col("_cnt") >= medium, "Medium") \
            .otherwise("Small")
    tiers = c.select(col, tier.alias(out))
    j = df.join(tiers, col, "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit("Small")))


# F03 -------------------------------------------------------------------------
def found_values(df: DataFrame, col: str, most: int = 1000) -> list[str]:
    """The distinct values of a column, in order, to make columns of.  More
    than ``most`` are an error: so many categories belong in rows."""
    rows = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{col} has more than {most} values")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """Fixed-list one-hot columns (0/1 ints)."""
    return df.select("*", *[(F.col(col) == v).cast("int").alias(f"{prefix}{v}") for v in values])


def one_hot_per_key(df: DataFrame, key: str, col: str, values: Sequence[str],
                    prefix: str = "") -> DataFrame:
    """One-hot rolled up to one row per key (``max``: the key has the value)."""
    return df.groupBy(key).agg(
        *[F.max((F.col(col) == v).cast("int")).alias(f"{prefix}{v}") for v in values]) \
        .fillna(0)


# F04 -------------------------------------------------------------------------
def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den``, NULL when ``den`` is 0 (the reference yields inf/NaN)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n, F.when(d != 0, d))


# F05 -------------------------------------------------------------------------
def log_transform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``ln(x + 1)`` for columns whose minimum is 0, else ``ln(x)``.  All
    minimums come from one aggregate used as a scalar subquery (a struct)."""
    if not cols:
        return df
    mins = df.agg(F.struct(*[F.min(c).alias(c) for c in cols])).scalar()
    return df.select(*[
        F.ln(F.when(mins[c] == 0, F.col(c) + 1).otherwise(F.col(c))).alias(c) if c in cols
        else F.col(c) for c in df.columns])


# F06 -------------------------------------------------------------------------
def min_max_scale(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    st = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    rng = st["hi"] - st["lo"]
    return df.withColumn(out or col, F.when(rng == 0, F.lit(0.0))
                         .otherwise((F.col(col) - st["lo"]) / rng))


# F08 -------------------------------------------------------------------------
# Labels of the word-count-difference bins.
WORD_DIFF_LABELS = ["Very low", "Low", "Medium", "High", "Very high"]


def bin_right_closed(col: Column | str, edges: Sequence[float] = (5, 10, 15, 20),
                     labels: Sequence[str] = WORD_DIFF_LABELS) -> Column:
    """Bins (-inf, e1], (e1, e2], …, (ek, inf) — right-closed, unlike
    ``Bucketizer``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.lit(labels[-1])
    for e, lab in reversed(list(zip(edges, labels))):
        expr = F.when(c <= e, lab).otherwise(expr)
    return F.when(c.isNull(), F.lit(None)).otherwise(expr)


# F09 -------------------------------------------------------------------------
def top_categories(df: DataFrame, col: str, min_count: int = 300,
                   other: str = "Others", out: str | None = None) -> DataFrame:
    c = _counts(df, col).filter(F.col("_cnt") >= min_count).select(col, F.lit(1).alias("_top"))
    j = df.join(c, col, "left")
    return j.withColumn(out or col, F.when(F.col("_top") == 1, F.col(col)).otherwise(F.lit(other))) \
            .drop("_top")
