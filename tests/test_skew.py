"""Skewed inputs: a third of all rows in one tiny spot (hot grid cell, crowded
delta-cells, one hot group).  Results must equal brute force."""

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from planekit import closest_pairs, convex_hull, farthest_pairs, spatial_count, spatial_join


def _skewed(n=3000, seed=7):
    rng = np.random.default_rng(seed)
    spread = rng.integers(0, 1_000_000, size=(2 * n // 3, 2))
    hot = rng.integers(500_000, 500_040, size=(n // 3, 2))   # a third in a 40 x 40 spot
    pts = np.unique(np.vstack([spread, hot]), axis=0)
    return pts


def _brute_closest(pts):
    best, pairs = None, []
    p = [tuple(map(int, r)) for r in pts]
    for i in range(len(p)):
        d = (pts[i + 1:, 0] - pts[i, 0]) ** 2 + (pts[i + 1:, 1] - pts[i, 1]) ** 2
        if len(d) == 0:
            continue
        m = int(d.min())
        if best is None or m < best:
            best, pairs = m, []
        if m == best:
            for j in np.nonzero(d == m)[0]:
                a, b = sorted((p[i], p[i + 1 + int(j)]))
                pairs.append((a[0], a[1], b[0], b[1], m))
    return sorted(set(pairs))


def test_closest_with_crowded_cells(spark):
    pts = _skewed()
    df = spark.createDataFrame([tuple(map(int, r)) for r in pts], "x long, y long").repartition(7)
    assert rows(closest_pairs(df), "ax", "ay", "bx", "by", "d2") == _brute_closest(pts)


def test_join_and_count_with_hot_cell(spark):
    pts = _skewed()
    p = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(pts)], "id long, x long, y long")
    wins = [(0, 499_990, 499_990, 500_050, 500_050), (1, 500_000, 500_000, 500_010, 500_010),
            (2, 0, 0, 1_000_000, 1_000_000), (3, 400_000, 400_000, 600_000, 600_000)]
    w = spark.createDataFrame(wins, "id long, x1 long, y1 long, x2 long, y2 long")
    expect = sorted((i, j) for i, (a, b) in enumerate(pts) for j, x1, y1, x2, y2 in wins
                    if x1 < a < x2 and y1 < b < y2)
    for cell in (None, 8.0):
        assert rows(spatial_join(p, w, "within", cell=cell)) == expect
    counts = {}
    for i, _ in expect:
        counts[i] = counts.get(i, 0) + 1
    assert rows(spatial_count(p, w, "within")) == sorted(counts.items())


def test_hull_with_hot_group(spark):
    pts = _skewed()
    g = np.where(np.arange(len(pts)) % 3 == 0, 1, 0)   # group 1 also holds a third of the rows
    df = spark.createDataFrame([(int(k), int(a), int(b)) for k, (a, b) in zip(g, pts)],
                               "g long, x long, y long").repartition(9)
    per_group = rows(convex_hull(df, group_by="g", fanin=2))
    for k in (0, 1):
        sub = df.where(F.col("g") == k)
        assert [r[1:] for r in per_group if r[0] == k] == rows(convex_hull(sub.coalesce(1)))
    assert len(rows(farthest_pairs(df))) >= 1


def test_large_windows_do_not_share_one_cell(spark):
    from planekit.operators.join import _own_cells
    from planekit.plans.grid import SideStats, point_cells
    rng = np.random.default_rng(4)
    points = [(i, int(x), int(y)) for i, (x, y) in enumerate(rng.integers(0, 1_000_000, (2000, 2)))]
    size = lambda k: 600_000 if k % 25 == 0 else 900
    windows = [(k, int(x), int(y), int(x) + size(k), int(y) + size(k)) for k, (x, y) in enumerate(rng.integers(0, 1_000_000, (500, 2)))]
    p = spark.createDataFrame(points, "id long, x long, y long")
    w = spark.createDataFrame(windows, "id long, x1 long, y1 long, x2 long, y2 long")
    cols = ("x1", "y1", "x2", "y2")
    stats = SideStats(w, cols)
    levels = stats.levels()
    finer = stats.finer(levels)
    assert finer[20] > 0
    own = _own_cells(w, cols, levels, finer).groupBy("id").count()
    assert own.agg(F.max("count")).first()[0] <= stats.fine_cells(finer)
    cells = point_cells(p, levels, "x", "y", finer=finer).where("_L = 20").groupBy("_cx", "_cy").count()
    assert cells.agg(F.max("count")).first()[0] < 200  # all 2000 in one cell of the plain level
    want = sorted((i, k) for i, x, y in points for k, a, b, c, d in windows if a < x < c and b < y < d)
    assert rows(spatial_join(p, w, "within")) == want


def test_join_tasks_follow_rows_not_bytes(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = spark.createDataFrame([(k, k % 100 * 10, k // 100 * 10, k % 100 * 10 + 15, k // 100 * 10 + 15) for k in range(2000)],
                                  "id long, x1 long, y1 long, x2 long, y2 long")
        j = spatial_join(r, r, "intersects")
        # bytes of a few tasks at most, which adaptive execution would join to one
        assert j.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
