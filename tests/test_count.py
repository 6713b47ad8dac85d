"""Counting windows without pairs: against all pairs, in every physical form."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01, rows
from planekit import spatial_count
from planekit.operators.count import count_meeting
from planekit.operators._rank_local import Dominance, borders, strip_of
from planekit.plans.catalog import QUERIES

WIN = "id long, x1 long, y1 long, x2 long, y2 long"


def _meets(p, w, predicate):
    x1, x2, y1, y2 = min(w[1], w[3]), max(w[1], w[3]), min(w[2], w[4]), max(w[2], w[4])
    if predicate == "intersects":
        return min(p[1], p[3]) <= x2 and x1 <= max(p[1], p[3]) and min(p[2], p[4]) <= y2 and y1 <= max(p[2], p[4])
    if predicate == "within":
        return x1 < p[1] < x2 and y1 < p[2] < y2
    return x1 <= p[1] <= x2 and y1 <= p[2] <= y2


def _brute(probes, windows, predicate):
    out = {}
    for p in probes:
        out.setdefault(p[0], set()).update(w[0] for w in windows if w[0] is not None and _meets(p, w, predicate))
    return sorted((i, len(s)) for i, s in out.items())


def _shapes(rng, n, points=False, first=0):
    side = lambda: rng.choice([0, 1, 2, 5, 40])
    at = [(first + i, rng.randint(0, 30), rng.randint(0, 30)) for i in range(n)]
    return at if points else [(i, x + side(), y, x, y + side()) for i, x, y in at]


@pytest.mark.parametrize("predicate,repeat", [("within", True), ("within_closed", False), ("intersects", False), ("intersects", True)])
def test_counts_match_all_pairs(spark, predicate, repeat):
    rng = random.Random(len(predicate) + repeat)
    points = predicate != "intersects"
    probes, windows = _shapes(rng, 60, points), _shapes(rng, 50)
    if repeat:  # ids on several rows: their matches may coincide
        probes += _shapes(rng, 20, points)
        windows += _shapes(rng, 20) + [(None, 0, 0, 30, 30)]
    P = spark.createDataFrame(probes, "id long, x long, y long" if points else WIN).repartition(3)
    W = spark.createDataFrame(windows, WIN).repartition(3)
    want = _brute(probes, windows, predicate)
    assert rows(spatial_count(P, W, predicate, how="left")) == want
    assert rows(spatial_count(P, W, predicate)) == [r for r in want if r[1]]


@pytest.mark.parametrize("closed,strips,group", [(True, 7, 16), (False, 2, 10)])
def test_strips_and_slices_count_the_same(spark, closed, strips, group):
    rng = random.Random(strips)
    points = [(str(i), rng.randint(0, 20), rng.randint(0, 20)) for i in range(150)]
    probes = [(i, x, y, x, y) for i, x, y in points]
    if closed:
        probes = [(i, x, y, x + rng.randint(0, 9), y + rng.randint(0, 9)) for i, x, y, _, _ in probes]
    # a third of the windows begin at the same x, a third of the probes stand at one place
    probes[:50] = [(i, 7, 7, 7 + 3 * closed, 7) for i, *_ in probes[:50]]
    windows = [(7 if k % 3 == 0 else rng.randint(0, 20), rng.randint(0, 20), rng.randint(0, 9), rng.randint(0, 9)) for k in range(120)]
    windows = [(x, y, x + w, y + h) for x, y, w, h in windows]
    P = spark.createDataFrame(probes, "_pid string, _px1 long, _py1 long, _px2 long, _py2 long").repartition(4)
    W = spark.createDataFrame(windows, "_wx1 long, _wy1 long, _wx2 long, _wy2 long").repartition(4)
    inside = (lambda p, w: p[1] <= w[2] and w[0] <= p[3] and p[2] <= w[3] and w[1] <= p[4]) if closed else (
        lambda p, w: w[0] < p[1] < w[2] and w[1] < p[2] < w[3])
    want = sorted((p[0], sum(inside(p, w) for w in windows)) for p in probes)
    assert rows(count_meeting(P, W, closed, local=0, strips=strips, group=group, sample=60)) == want
    assert rows(count_meeting(P, W, closed)) == want


def test_counts_of_nothing_and_of_missing_coordinates(spark):
    none = spark.createDataFrame([], WIN)
    some = spark.createDataFrame([(1, 0, 0, 2, 2), (2, None, 0, 2, 2), (None, 1, 1, 1, 1)], WIN)
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(spatial_count(none, some, "intersects")) == []
    assert rows(spatial_count(some, none, "intersects")) == []
    assert key(spatial_count(some, none, "intersects", how="left")) == [(1, 0), (2, 0), (None, 0)]
    assert key(spatial_count(some, some, "intersects", how="left")) == [(1, 1), (2, 0), (None, 1)]


def test_counts_with_infinite_borders_far_coordinates_and_decimals(spark):
    inf, far = float("inf"), 1_700_000_000_000_000_000
    w = spark.createDataFrame([(1, -inf, 0.0, inf, 2.0), (2, 0.5, -inf, 0.5, inf)], "id long, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(1, 0.5, 1.0), (2, 1e300, 1.0), (3, 0.0, 3.0)], "id long, x double, y double")
    assert rows(spatial_count(p, w, "within", how="left")) == [(1, 1), (2, 1), (3, 0)]
    assert rows(spatial_count(p, w, "within_closed", how="left")) == [(1, 2), (2, 1), (3, 0)]
    big = spark.createDataFrame([(1, far, far, far + 1, far + 1), (2, far + 1, far, far + 3, far + 3)], WIN)
    assert rows(spatial_count(big, big, "intersects")) == [(1, 2), (2, 2)]
    pt = spark.createDataFrame([(7, far + 2, far + 1)], "id long, x long, y long")
    assert rows(spatial_count(pt, big, "within")) == [(7, 1)]
    dec = big.selectExpr("id", *[f"cast({c} - {far} as decimal(20,1)) as {c}" for c in ("x1", "y1", "x2", "y2")])
    assert rows(spatial_count(dec, dec, "intersects")) == [(1, 2), (2, 2)]


def test_counting_lists_no_pairs(spark):
    for name in ("join_mixed_scale_rects", "spatial_count_point", "spatial_count_rect"):
        plan = QUERIES[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan, name


def test_dominance_and_strips_match_a_scan():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 64, 300):
        a, b = rng.integers(0, 12, n), rng.integers(0, 12, n)
        qa, qb = rng.integers(-1, 14, 50), rng.integers(-1, 14, 50)
        points = Dominance(a, b)
        for ca in (True, False):
            for cb in (True, False):
                before = (a[None] <= qa[:, None] if ca else a[None] < qa[:, None]) & (b[None] <= qb[:, None] if cb else b[None] < qb[:, None])
                assert points.count(qa, qb, ca, cb).tolist() == before.sum(axis=1).tolist()
        first, second = borders(a, b, 5)
        want = [sum((f, s) <= (x, y) for f, s in zip(first, second)) for x, y in zip(a, b)]
        assert strip_of(first, second, a, b).tolist() == want


def test_probes_are_counted_in_tasks_of_bounded_size(spark, monkeypatch):
    from planekit.operators import join as J
    monkeypatch.setattr(J, "SPREAD", 100)
    df = spark.range(1000).coalesce(1)
    sizes = [r["count"] for r in J._spread(df, 1000).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    assert J._spread(df, 90) is df
    probes = spark.createDataFrame([(i % 900, i % 37, i % 41) for i in range(1000)], "id long, x long, y long")
    windows = spark.createDataFrame([(k, k, k, k + 9, k + 9) for k in range(30)], "id long, x1 long, y1 long, x2 long, y2 long")
    got = dict(rows(spatial_count(probes, windows, "within", how="left")))
    want = {}
    for i in range(1000):
        want.setdefault(i % 900, set()).update(k for k in range(30) if k < i % 37 < k + 9 and k < i % 41 < k + 9)
    assert got == {i: len(s) for i, s in want.items()}
