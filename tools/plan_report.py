"""Summarise the physical plan of every registered query (for PLANS.md).

For each query: join strategies, exchanges (shuffles), Python stages,
scans with their pushed filters and read schemas.  Plans are taken after
execution (AQE final plan) at the given scale.
Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from planekit.plans.catalog import QUERIES  # noqa: E402
from planekit.session import local_session  # noqa: E402

NODES = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Exchange", "BroadcastExchange", "HashAggregate", "ObjectHashAggregate",
         "SortAggregate", "Generate", "MapInPandas", "FlatMapGroupsInPandas", "Window", "Union")


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    print(f"# Physical plans of the registered queries\n\nScale: `{d}`, local[8], AQE on; final (post-execution) plans.\n"
          "Generated by `tools/plan_report.py`.\n")
    for name, fn in QUERIES.items():
        df = fn(spark, d)
        df.write.format("noop").mode("overwrite").save()
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        head = plan.split("\n\n")[0]
        counts = Counter()
        for line in head.splitlines():
            m = re.search(r"([A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)", line.strip(" :+-*"))
            if m:
                node = line.strip(" :+-*").split(" (")[0].split(" ")[0]
                if node in NODES:
                    counts[node] += 1
        print(f"## {name}\n")
        print("nodes: " + ", ".join(f"{k}×{v}" for k, v in sorted(counts.items())) + "\n")
        scans = re.findall(r"\(\d+\) Scan parquet.*?\n((?:[A-Za-z]+.*\n)+)", plan)
        for s in scans:
            loc = re.search(r"Location: .*?\[file:.*?/([a-z]+)\.parquet\]", s)
            pf = re.search(r"PushedFilters: (.*)", s)
            rs = re.search(r"ReadSchema: (.*)", s)
            print(f"- scan `{loc.group(1) if loc else '?'}`: ReadSchema `{rs.group(1) if rs else ''}`"
                  + (f"; PushedFilters `{pf.group(1)}`" if pf else ""))
        print()
    spark.stop()


if __name__ == "__main__":
    main()
