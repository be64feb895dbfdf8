"""Connected components of an edge table, as iterated Spark joins.

Smallest-label propagation with pointer jumping: each round every node takes
the smallest label among itself and its neighbours, then the label of its
label.  Labels live in written tables; only a count of changes reaches the
driver.  Star-shaped groups, however large, settle in two rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fits, materialise

#: Label tables up to this number of rows are broadcast, larger ones shuffled.
BROADCAST_LABELS = 500_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of *edges* (columns a, b); component is
    the smallest node reachable.  *edges* must be a written table."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    labels = materialise(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    small = fits(labels, BROADCAST_LABELS)
    while True:
        side = F.broadcast(labels) if small else labels
        near = (both.join(side, both["b"] == labels["node"])
                .groupBy(F.col("a").alias("_n")).agg(F.min("component").alias("_near")))
        lower = (labels.join(near, labels["node"] == near["_n"], "left")
                 .select("node", F.col("component").alias("_was"),
                         F.least("component", "_near").alias("_now")))
        jump = side.select(F.col("node").alias("_now"), F.col("component").alias("_next"))
        step = materialise(
            lower.join(jump, "_now", "left")
            .select("node", "_was", F.least("_now", "_next").alias("component")), "labels")
        changed = step.filter("_was <> component").limit(1).count()
        labels = step.drop("_was")
        if not changed:
            return labels
