"""Hulls and farthest pairs as large as their input, spread over buckets of edge angles."""

import math
import random

import numpy as np
import pytest

from conftest import rows
from planekit import convex_hull, farthest_pairs
from planekit.operators import hull as H
from planekit.operators._geom_local import ANGLE_MARGIN, buckets_of, cones, farthest_on_hull, hull_ccw, opposite


def _hull(points):
    xs, ys = (np.array([p[i] for p in points]) for i in (0, 1))
    return sorted(hull_ccw(xs, ys))


def _circle(n, r=10**6):
    return sorted({(round(r * math.cos(2 * math.pi * k / n)), round(r * math.sin(2 * math.pi * k / n))) for k in range(n)})


SHAPES = {
    "circle": _circle(400),
    "parabola": [(k, k * k) for k in range(-100, 100)],  # all edges within a narrow range of angles
    "far": [(x + 1_700_000_000_000_000_000, y - 1_700_000_000_000_000_000) for x, y in _circle(300, 5000)],
    "line": [(k, 2 * k) for k in range(50)],
    "vertical": [(3, k) for k in range(50)],
    "one": [(4, 4)] * 40,
    "two": [(4, 4), (1, 9)] * 20,
    "square": [(x, y) for x in range(12) for y in range(12)],
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_buckets_change_nothing(spark, name):
    points = SHAPES[name]
    df = spark.createDataFrame(points, "x long, y long").repartition(6)
    assert rows(convex_hull(df, fanin=4, vertices=10)) == _hull(points)
    xs, ys = (np.array([p[i] for p in points]) for i in (0, 1))
    best, pairs = farthest_on_hull(hull_ccw(xs, ys))
    want = sorted((*a, *b, best) for a, b in pairs)
    assert rows(farthest_pairs(df, fanin=4, vertices=10), "ax", "ay", "bx", "by", "d2") == want


def test_only_large_groups_are_cut(spark):
    big, small = _circle(600), [(1, 1), (5, 2), (2, 9), (3, 3)]
    data = [("big", *p) for p in big] + [("small", *p) for p in small] + [(None, *p) for p in small]
    df = spark.createDataFrame(data, "g string, x long, y long").repartition(5)
    part = H._partial_hulls(df, ["g"], "x", "y")
    cuts = H._angle_cuts(part, ["g"], 100)
    assert list(cuts) == [("big",)] and len(cuts[("big",)]) >= 5
    dealt = H._deal(part, ["g"], "x", "y", cuts, both=False)
    assert dealt.where("g = 'big'").groupBy("_hk").count().agg({"count": "max"}).first()[0] < 250
    got = sorted(map(tuple, convex_hull(df, group_by="g", vertices=100).collect()), key=str)
    want = [("big", *p) for p in _hull(big)] + [(g, *p) for g in ("small", None) for p in _hull(small)]
    assert got == sorted(want, key=str)
    far = lambda p: max((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 for a in p for b in p)
    best = {r.g: r.d2 for r in farthest_pairs(df, group_by="g", vertices=100).collect()}
    assert best == {"big": far(big), "small": far(small), None: far(small)}


def test_doubles_in_buckets_are_exact(spark):
    rng = random.Random(3)
    points = [(math.cos(a) * 0.1 + 7, math.sin(a) * 0.1 - 3) for a in (rng.random() * 7 for _ in range(500))]
    df = spark.createDataFrame(points, "x double, y double").repartition(4)
    assert rows(convex_hull(df, vertices=25)) == _hull(points)
    best, pairs = farthest_on_hull(hull_ccw(*(np.array([p[i] for p in points]) for i in (0, 1))))
    assert rows(farthest_pairs(df, vertices=25), "ax", "ay", "bx", "by") == sorted((*a, *b) for a, b in pairs)


def test_no_task_holds_a_hull_as_large_as_its_input(spark):
    n = 40_000
    points = [(k, k * (n - k)) for k in range(n)]  # all of them vertices
    df = spark.createDataFrame(points, "x long, y long").repartition(8)
    part = H._partial_hulls(df, [], "x", "y")
    cuts = H._angle_cuts(part, [], 4_000)
    sizes = [r["count"] for r in H._deal(part, [], "x", "y", cuts, both=False).groupBy("_hk").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 8_000 and sum(sizes) < 1.1 * n
    assert convex_hull(df, vertices=4_000).count() == n


def test_cones_go_round_once_and_buckets_cover_them():
    hull = hull_ccw(*(np.array([p[i] for p in _circle(200)]) for i in (0, 1)))
    xs, ys = (np.array([p[i] for p in hull]) for i in (0, 1))
    into, out = cones(xs, ys, np.zeros(len(hull)))
    assert math.isclose(float(((out - into) % (2 * math.pi)).sum()), 2 * math.pi)
    cuts = np.sort(into)[::17][1:]
    row, bucket = buckets_of(into, out, cuts)
    pairs = set(zip(row.tolist(), bucket.tolist()))
    assert len(pairs) == len(row)
    for k, a in enumerate(into):
        assert (k, int(np.searchsorted(cuts, a, "right"))) in pairs
        assert (k, int(np.searchsorted(cuts, out[k], "right"))) in pairs
    assert np.allclose(opposite(opposite(into)), into) and ANGLE_MARGIN < 1e-9


@pytest.mark.parametrize("vertices", [4, 50_000])
def test_farthest_pairs_whose_square_no_bigint_holds(spark, vertices):
    wide = 27_000_000_000
    points = [(0, 0), (wide, 0), (wide, 50_000_000), (0, 50_000_000), *((k * 3_000_000_000, 7 * k) for k in range(1, 9))]
    df = spark.createDataFrame(points, "x long, y long").repartition(3)
    got = farthest_pairs(df, vertices=vertices)
    d2 = wide ** 2 + 50_000_000 ** 2
    assert d2 > 1 << 63
    assert rows(got) == [(0, 0, wide, 50_000_000, d2, math.sqrt(d2)), (0, 50_000_000, wide, 0, d2, math.sqrt(d2))]
    # a bigint wherever it is wide enough
    near = spark.createDataFrame([(0, 0), (2_000_000_000, 5)], "x long, y long")
    assert dict(farthest_pairs(near).dtypes)["d2"] == "bigint"
