"""Global ranks and running sums without a single-partition window.

Rows are range-partitioned once and that layout is written (checkpoint): the
numbering and the per-partition offsets are both read from the same written
rows.  Two branches over an unwritten range exchange could each sample their
own bounds, and their offsets would then not fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def ranged(df: DataFrame, order: Column) -> DataFrame:
    """*df* range-partitioned by *order*, written, with columns ``_o`` (the
    order) and ``_pid`` (the range)."""
    n = max(1, df.sparkSession.sparkContext.defaultParallelism)
    keyed = df.withColumn("_o", order)
    return cut_lineage(keyed.repartitionByRange(n, "_o").withColumn("_pid", F.spark_partition_id()))


def _offsets(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Totals of all ranges before each range: one row per range."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_pid").agg(*[c.alias(k) for k, c in sums.items()])
    return totals.select("_pid", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_off_{k}")
                                   for k in sums])


def global_row_number(df: DataFrame, order: Column, out: str = "_r") -> DataFrame:
    """*df* plus its 1-based row number in *order*."""
    rows = ranged(df, order)
    inside = F.row_number().over(Window.partitionBy("_pid").orderBy("_o"))
    offsets = _offsets(rows, {"n": F.count(F.lit(1))})
    return (rows.withColumn("_rn", inside).join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_rn") + F.col("_off_n")).cast("long"))
            .drop("_o", "_pid", "_rn", "_off_n"))


def cumulative_desc(df: DataFrame, order: str, cols: Sequence[str]) -> DataFrame:
    """*df* plus ``cum_<c>``: running sums in descending *order* (inclusive).
    ``-order`` is the range key, so *order* is a number."""
    rows = ranged(df, -F.col(order))
    running = (Window.partitionBy("_pid").orderBy("_o")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = _offsets(rows, {c: F.sum(c) for c in cols})
    summed = rows.select("*", *[F.sum(c).over(running).alias(f"_run_{c}") for c in cols])
    return summed.join(F.broadcast(offsets), "_pid").select(
        *df.columns, *[(F.col(f"_run_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in cols])


def running_by(df: DataFrame, by: Sequence[str], order: Column, cols: Sequence[str]) -> DataFrame:
    """*df* plus ``run_<c>`` (running sum of ``c`` in *order* within the group
    *by*, inclusive) and ``all_<c>`` (the group's sum).

    Groups are segments of one global range order: a group of any size is
    spread over ranges, and many small groups share one.  Only the sums of
    (range, group) are windowed by group."""
    rows = ranged(df, F.struct(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)],
                               order.alias("_v")))
    inside = (Window.partitionBy("_pid", *by).orderBy("_o")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_pid", *by).agg(*[F.sum(c).alias(f"_s_{c}") for c in cols])
    offsets = totals.select(
        F.col("_pid").alias("_p"), *[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)],
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in cols],
        *[F.sum(f"_s_{c}").over(Window.partitionBy(*by)).alias(f"all_{c}") for c in cols])
    same = F.col("_pid") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    summed = rows.select("*", *[F.sum(c).over(inside).alias(f"_run_{c}") for c in cols])
    return summed.join(offsets, same).select(
        *df.columns, *[(F.col(f"_run_{c}") + F.col(f"_off_{c}")).alias(f"run_{c}") for c in cols],
        *[f"all_{c}" for c in cols])
