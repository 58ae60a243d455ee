"""Warm wall-clock seconds of the registered queries; prints one JSON line.

BENCH_SF_DIR   test data folder           (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_QUERIES  comma-separated names      (default: all)
BENCH_RUNS     timed runs, median taken   (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from subtide.plans.registry import QUERIES, run_query
from subtide.session import local_session


def seconds(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    run_query(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    spark = local_session(cpus, "subtide-bench", **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8"})
    for name in names:
        seconds(spark, name, sf_dir)
    timings = {
        name: round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3) for name in names
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
