"""Benchmark the headline queries.

Runs each query fully (``noop`` sink: the whole plan executes, nothing is
collected) on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Per-query configuration is printed to stderr.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitwall import catalog  # noqa: E402
from pitwall.session import get_spark  # noqa: E402

HEADLINE = [
    "driver_race_features",  # flagship: laps -> one feature row per driver-race
    "race_summary",
    "quali_summary",
    "practice_summary",
    "compound_usage",
    "season_trends",
    "lap_records",  # collection: accurate laps + as-of weather + results
    "asof_nearest",
    "session_dim",
    "load_report",
    "season_lookup",
    "inference_frame",
    "search_lasso",  # one cross-validated model search on Spark ML
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(
        f"local[{cpus}]",
        app_name="pitwall-bench",
        shuffle_partitions=2 * cpus,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    # Warm the JVM (class loading, codegen) with the flagship on the smallest
    # tables, so the timings below are warm runs at the requested scale.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        catalog.QUERIES["driver_race_features"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": 2 * cpus,
        "state": "warm JVM, cold data (every query re-reads Parquet)",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
