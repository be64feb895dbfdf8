"""Exact percentiles by distributed selection (survey D23, D24).

``percentile`` keeps a group's values in one buffer.  Here the values of a
group are counted, ordered over many ranges and given running counts, and only
the two neighbours of each quantile position are picked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import running_by


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      names: dict[str, float]) -> DataFrame:
    """The *keys* and one column for each (name, share) of *names*: the value
    at share x (n - 1), interpolated.  Null values do not count; a group
    without values has no row."""
    counts = (df.select(*keys, F.col(value).cast("double").alias("_x")).filter("_x IS NOT NULL")
              .groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n")))
    rows = running_by(counts, keys, F.col("_x"), ["_n"])
    begin, end = F.col("run__n") - F.col("_n"), F.col("run__n")
    picks, out = [], []
    for name, share in names.items():
        place = F.lit(float(share)) * (F.col("all__n") - 1)
        low, high = F.floor(place), F.ceil(place)
        picks += [F.max(F.when((begin <= low) & (low < end), F.col("_x"))).alias(f"_lo_{name}"),
                  F.max(F.when((begin <= high) & (high < end), F.col("_x"))).alias(f"_hi_{name}"),
                  F.max(place - low).alias(f"_part_{name}")]
        out.append((F.col(f"_lo_{name}") * (1 - F.col(f"_part_{name}"))
                    + F.col(f"_hi_{name}") * F.col(f"_part_{name}")).alias(name))
    return rows.groupBy(*keys).agg(*picks).select(*keys, *out)
