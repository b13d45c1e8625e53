"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is forced to completion with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  One untimed warm-up query
loads the JVM; ``$BENCH_REPEAT`` (default 1) runs are taken and the median kept.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bronze_to_silver", "apply_changes", "time_travel", "upsert_by_hash", "split_cascade", "dense_topk",
    "sparse_dot", "counter_increase", "decorate_silver", "ingest_outcome", "metric_mapping", "duration_p95",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from strata.session import get_session, shared_root

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="strata-bench",
                        extra={"spark.driver.memory": "16g"})
    shared_root(spark)  # the configured spark.checkpoint.dir, or a private one when unset

    from strata.plans.registry import QUERIES, load_all

    load_all()
    QUERIES["count_rows"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    timings = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
