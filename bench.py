"""Benchmark: headline queries at $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS].  Each query is forced to completion with a no-op write
(no collect to the driver); every query is run once as a warm-up, then each
is timed $BENCH_REPS times and the median kept.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabml.plans.catalog import QUERIES  # noqa: E402
from tabml.session import build_session  # noqa: E402

HEADLINE = ["corr_matrix", "regression_metrics", "linear_ols", "tune_leaderboard",
            "forest_accuracy", "kmeans_sizes", "als_top_k", "top_k_from_factors",
            "level_counts"]


def run(spark, name, sf_dir):
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="tabml-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    for n in names:                                 # warm every query first, so the JIT and
        run(spark, n, sf_dir)                       # codegen caches are alike for all timings
    times = {n: round(statistics.median(run(spark, n, sf_dir) for _ in range(reps)), 3)
             for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "reps": reps,
                      "spark": spark.version}))


if __name__ == "__main__":
    main()
