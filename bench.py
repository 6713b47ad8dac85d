"""Time every registered query on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints ONE JSON line: {"metric", "value" (sum of per-query seconds), "unit",
"queries" {name: sec}, "sf", ...}.  Each query runs to completion into the
``noop`` sink (full execution, nothing collected); the time includes the
small driver-side statistics some operators gather first.  The session is
warmed once before timing; each query is timed as the median of
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from planekit.plans.catalog import QUERIES  # noqa: E402
from planekit.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="planekit-bench")
    spark.sparkContext.setLogLevel("ERROR")

    # warm-up: JVM, Python workers, Parquet footers
    QUERIES["spatial_count_point"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_query_seconds_median_of_%d" % repeat,
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
