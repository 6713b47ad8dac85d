"""Check closest/farthest pairs at a scale where the all-pairs oracle is too slow.

Closest: an exact x-sorted sweep (independent of the grid algorithm).
Farthest: all pairs over the hull vertices found by the DuckDB slope form.
Usage: python tools/check_pairs.py [sf_dir]
"""
import itertools
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from planekit.plans.catalog import QUERIES, _hull_sql  # noqa: E402
from planekit.plans.views import cte  # noqa: E402
from planekit.session import local_session  # noqa: E402

d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
con = duckdb.connect()
for t in ("orders",):
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
spark = local_session(8, 16); spark.sparkContext.setLogLevel("ERROR")
for view in ("iso", "pts"):
    pts = sorted(set(con.execute(cte(view) + f"SELECT x, y FROM {view}").fetchall()))
    # closest: x-sorted sweep with exact integer distances (independent of the grid)
    best, pairs = None, []
    for i, (ax, ay) in enumerate(pts):
        for j in range(i + 1, len(pts)):
            bx, by = pts[j]
            dx = bx - ax
            if best is not None and dx * dx > best:
                break
            d2 = dx * dx + (by - ay) ** 2
            if best is None or d2 < best:
                best, pairs = d2, [(ax, ay, bx, by)]
            elif d2 == best:
                pairs.append((ax, ay, bx, by))
    got = sorted((r.ax, r.ay, r.bx, r.by, r.d2) for r in QUERIES[f"closest_pairs{'' if view == 'iso' else '_pts'}"](spark, d).collect())
    print(view, "closest", got == sorted(p + (best,) for p in pairs), got[:2])
    # farthest: all pairs over the DuckDB slope-form hull vertices
    hull = con.execute(cte(view) + ", " + _hull_sql(view, None)).fetchall()
    far, fp = None, []
    for a, b in itertools.combinations(sorted(hull), 2):
        d2 = (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2
        if far is None or d2 > far:
            far, fp = d2, [(a[0], a[1], b[0], b[1])]
        elif d2 == far:
            fp.append((a[0], a[1], b[0], b[1]))
    got = sorted((r.ax, r.ay, r.bx, r.by, r.d2) for r in QUERIES[f"farthest_pairs{'' if view == 'iso' else '_pts'}"](spark, d).collect())
    print(view, "farthest", got == sorted(p + (far,) for p in fp), got[:2])
