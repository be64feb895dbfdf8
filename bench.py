"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.registry import QUERIES  # noqa: E402
from tessera.session import get_session  # noqa: E402

HEADLINE = [
    "d03_engagement_extract",
    "d05_learning_detail",
    "e04_all_horizons",
    "e14_cutoff_features",
    "h05_cosine_top5",
    "h14_jaccard_top5",
    "h24_search_evaluation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="tessera-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    # Warm-up on the smallest data set (JIT and generated-code caches), so the
    # timings below measure the queries rather than JVM start-up.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        # Timed from plan construction: fits, checkpoints and size checks that
        # run while a query is built are part of its cost.
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
