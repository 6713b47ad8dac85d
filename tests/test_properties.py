"""Property tests: small integer inputs vs brute force; invariance under
partition count and grid cell size (the grid changes cost, never results)."""

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from planekit.operators.join import points_outside_rects
from planekit import (
    closest_pairs,
    convex_hull,
    farthest_pairs,
    rect_union_vertices,
    spatial_join,
)
from planekit.operators._geom_local import hull_ccw

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

coord = st.integers(min_value=-20, max_value=20)
point = st.tuples(coord, coord)
rect = st.tuples(coord, coord, st.integers(0, 12), st.integers(0, 12)).map(
    lambda t: (t[0], t[1], t[0] + t[2], t[1] + t[3]))


def _brute_pairs(pts, pick):
    pts = sorted(set(pts))
    ds = {(a, b): (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 for a, b in itertools.combinations(pts, 2)}
    if not ds:
        return []
    best = pick(ds.values())
    return sorted((a[0], a[1], b[0], b[1], d) for (a, b), d in ds.items() if d == best)


@SETTINGS
@given(st.lists(point, min_size=0, max_size=40), st.integers(1, 6))
def test_pairs_vs_brute(spark, pts, nparts):
    df = spark.createDataFrame(pts, "x long, y long").repartition(nparts)
    got_c = rows(closest_pairs(df), "ax", "ay", "bx", "by", "d2")
    got_f = rows(farthest_pairs(df), "ax", "ay", "bx", "by", "d2")
    assert got_c == _brute_pairs(pts, min)
    assert got_f == _brute_pairs(pts, max)


@SETTINGS
@given(st.lists(point, min_size=0, max_size=60), st.integers(1, 6))
def test_hull_vs_local_and_partitions(spark, pts, nparts):
    import numpy as np
    df = spark.createDataFrame(pts, "x long, y long").repartition(nparts)
    expect = sorted(hull_ccw(np.array([p[0] for p in pts], dtype=np.int64),
                             np.array([p[1] for p in pts], dtype=np.int64)))
    assert rows(convex_hull(df, fanin=2)) == expect


@SETTINGS
@given(st.lists(point, max_size=30), st.lists(rect, max_size=12), st.sampled_from([None, 1.0, 4.0, 64.0]))
def test_point_join_vs_brute(spark, pts, rects, cell):
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, x long, y long")
    w = spark.createDataFrame([(i,) + r for i, r in enumerate(rects)], "id long, x1 long, y1 long, x2 long, y2 long")
    for pred, inside in (("within", lambda a, b, r: r[0] < a < r[2] and r[1] < b < r[3]),
                         ("within_closed", lambda a, b, r: r[0] <= a <= r[2] and r[1] <= b <= r[3])):
        expect = sorted((i, j) for i, (a, b) in enumerate(pts) for j, r in enumerate(rects) if inside(a, b, r))
        assert rows(spatial_join(p, w, pred, cell=cell)) == expect


@SETTINGS
@given(st.lists(rect, max_size=15), st.lists(rect, max_size=15), st.sampled_from([None, 1.0, 2.0, 32.0]))
def test_rect_join_vs_brute(spark, a, b, cell):
    A = spark.createDataFrame([(i,) + r for i, r in enumerate(a)], "id long, x1 long, y1 long, x2 long, y2 long")
    B = spark.createDataFrame([(i,) + r for i, r in enumerate(b)], "id long, x1 long, y1 long, x2 long, y2 long")
    expect = sorted((i, j) for i, r in enumerate(a) for j, s in enumerate(b)
                    if r[0] <= s[2] and s[0] <= r[2] and r[1] <= s[3] and s[1] <= r[3])
    assert rows(spatial_join(A, B, "intersects", cell=cell)) == expect


def _raster_vertices(rects):
    """Boundary vertices from a unit raster: a lattice point is a vertex iff
    its 4 surrounding unit squares' coverage is a corner pattern."""
    cov = set()
    for x1, y1, x2, y2 in rects:
        for i in range(x1, x2):
            for j in range(y1, y2):
                cov.add((i, j))
    xs = {v for r in rects for v in (r[0], r[2])}
    ys = {v for r in rects for v in (r[1], r[3])}
    out = []
    for x in xs:
        for y in ys:
            ne, nw, sw, se = (x, y) in cov, (x - 1, y) in cov, (x - 1, y - 1) in cov, (x, y - 1) in cov
            n = ne + nw + sw + se
            if n in (1, 3) or (n == 2 and ne == sw):
                out.append((x, y))
    return sorted(out)


@SETTINGS
@given(st.lists(rect, max_size=10))
def test_union_vs_raster(spark, rects):
    df = spark.createDataFrame(rects, "x1 long, y1 long, x2 long, y2 long")
    expect = _raster_vertices(rects)
    assert rows(rect_union_vertices(df)) == expect
    assert rows(rect_union_vertices(df, rows_per_tile=2)) == expect


@SETTINGS
@given(st.lists(point, min_size=0, max_size=80), st.integers(1, 4))
def test_hull_catalyst_prefilter_same(spark, pts, nparts):
    df = spark.createDataFrame([(p[0] % 2, p[0], p[1]) for p in pts], "g long, x long, y long").repartition(nparts)
    assert rows(convex_hull(df, group_by="g", catalyst_prefilter=True)) == rows(convex_hull(df, group_by="g"))
    assert rows(convex_hull(df, catalyst_prefilter=True)) == rows(convex_hull(df))


fcoord = st.integers(min_value=-400, max_value=400).map(lambda v: v / 8.0 + 0.1)  # non-integral doubles


@SETTINGS
@given(st.lists(st.tuples(fcoord, fcoord), min_size=0, max_size=40), st.integers(1, 5))
def test_double_coordinates_vs_exact_brute(spark, pts, nparts):
    from fractions import Fraction
    df = spark.createDataFrame(pts, "x double, y double").repartition(nparts)
    uniq = sorted(set(pts))
    d = {(a, b): (Fraction(a[0]) - Fraction(b[0])) ** 2 + (Fraction(a[1]) - Fraction(b[1])) ** 2
         for a, b in itertools.combinations(uniq, 2)}
    got_c = rows(closest_pairs(df), "ax", "ay", "bx", "by")
    got_f = rows(farthest_pairs(df), "ax", "ay", "bx", "by")
    if not d:
        assert got_c == [] and got_f == []
        return
    lo, hi = min(d.values()), max(d.values())
    assert got_f == sorted((a[0], a[1], b[0], b[1]) for (a, b), v in d.items() if v == hi)
    # closest compares computed squared distances: the exact minimum pair(s)
    # must be among them; distinct exact values never tie in floating point here
    exact_min = sorted((a[0], a[1], b[0], b[1]) for (a, b), v in d.items() if v == lo)
    assert set(exact_min) <= set(got_c)
    import numpy as np
    expect_h = sorted(hull_ccw(np.array([p[0] for p in pts]), np.array([p[1] for p in pts])))
    assert rows(convex_hull(df)) == expect_h


@SETTINGS
@given(st.lists(point, max_size=30), st.lists(rect, max_size=12), st.booleans())
def test_points_outside_vs_brute(spark, pts, rects, closed):
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, x long, y long")
    w = spark.createDataFrame(rects, "rx1 long, ry1 long, rx2 long, ry2 long")
    def inside(a, b, r):
        return (r[0] <= a <= r[2] and r[1] <= b <= r[3]) if closed else (r[0] < a < r[2] and r[1] < b < r[3])
    expect = sorted((i,) for i, (a, b) in enumerate(pts) if not any(inside(a, b, r) for r in rects))
    got = points_outside_rects(p, w, "x", "y", ("rx1", "ry1", "rx2", "ry2"), closed=closed)
    assert rows(got, "id") == expect


@SETTINGS
@given(st.lists(rect, max_size=10))
def test_union_double_coordinates(spark, rects):
    # the same rectangles at a non-integral scale: vertices scale with them
    scaled = [tuple(v * 0.375 for v in r) for r in rects]
    df = spark.createDataFrame(scaled, "x1 double, y1 double, x2 double, y2 double")
    expect = sorted((x * 0.375, y * 0.375) for x, y in _raster_vertices(rects))
    assert rows(rect_union_vertices(df)) == expect
