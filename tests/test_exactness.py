"""Exact answers for bigints beyond 2**53, 32-bit and infinite coordinates; text fields and group keys unaltered."""

import random

import pytest
from conftest import rows
from planekit import closest_pairs, convex_hull, farthest_pairs, parse_probes, parse_shapes, spatial_join, write_csv
from planekit.operators._geom_local import prefilter
from planekit.operators.pairs import coincident_points
from planekit.plans.grid import SideStats, open_ended
from planekit.plans.guard import size_guard
from pyspark.sql import functions as F

OFFSETS = [0, 2**53, -(2**60), 1_700_000_000_000_000_000]


def brute_hull(points):
    points = sorted(set(points))

    def half(ps):
        out = []
        for p in ps:
            while len(out) > 1 and ((out[-1][0] - out[-2][0]) * (p[1] - out[-2][1])
                                    <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0])):
                out.pop()
            out.append(p)
        return out[:-1]

    return sorted(half(points) + half(points[::-1])) if len(points) > 2 else points


def brute_pairs(points, best):
    points = sorted(set(points))
    pairs = [((ax - bx) ** 2 + (ay - by) ** 2, ax, ay, bx, by)
             for i, (ax, ay) in enumerate(points) for bx, by in points[i + 1:]]
    d2 = best(p[0] for p in pairs)
    return sorted((*p[1:], d2) for p in pairs if p[0] == d2)


def circle(n, radius, offset):
    rng = random.Random(n)
    out = set()
    while len(out) < n:
        x = rng.randrange(-radius, radius + 1)
        out.add((offset + x, -offset + round((radius**2 - x * x) ** 0.5) * rng.choice((-1, 1))))
    return sorted(out)


@pytest.mark.parametrize("offset", OFFSETS)
def test_hull_and_pairs_at_offsets(spark, offset):
    points = circle(100, 1500, offset) + [(offset + i % 9, -offset + i // 9) for i in range(60)]
    df = spark.createDataFrame(points, "x long, y long").repartition(3)
    assert rows(convex_hull(df)) == brute_hull(points)
    assert rows(farthest_pairs(df), "ax", "ay", "bx", "by", "d2") == brute_pairs(points, max)
    assert rows(closest_pairs(df), "ax", "ay", "bx", "by", "d2") == brute_pairs(points, min)


def test_sparse_far_points(spark):
    points = [(1_700_000_000_000_000_000 + 1000 * i, 100 * (i % 2) * i) for i in range(10)]
    df = spark.createDataFrame(points, "x long, y long")
    assert rows(closest_pairs(df), "ax", "ay", "bx", "by", "d2") == brute_pairs(points, min)
    flat = spark.createDataFrame([(x, 5) for x, _ in points], "x long, y long")
    assert rows(closest_pairs(flat), "ax", "d2") == sorted((x, 10**6) for x, _ in points[:-1])


def test_prefilter_drops_nothing_where_doubles_would_round():
    import numpy as np
    xs = np.array([0, 2**60, 2**60 + 1, 5] * 8)
    assert prefilter(xs, xs).all() and not prefilter(np.arange(0), np.arange(0)).any()


def test_32_bit_coordinates_do_not_overflow(spark):
    points = [(i * 100_000, -(i * i) % 70_000) for i in range(40)]
    df = spark.createDataFrame(points, "x int, y int")
    assert rows(closest_pairs(df), "ax", "ay", "bx", "by", "d2") == brute_pairs(points, min)
    wide = spark.createDataFrame([(1, -2**31, -2**31, 2**31 - 1, 2**31 - 1)], "id long, x1 int, y1 int, x2 int, y2 int")
    ids = df.withColumn("id", F.col("x"))
    assert spatial_join(ids, wide, "within").count() == 40


def test_infinite_window_borders(spark):
    inf = float("inf")
    points = spark.createDataFrame([(i, float(i), float(-i)) for i in range(-20, 20)], "id long, x double, y double")
    windows = spark.createDataFrame([(0, 0.0, 0.0, inf, -inf), (1, -inf, -inf, inf, inf), (2, 3.0, -5.0, 5.0, -3.0)],
                                    "id long, x1 double, y1 double, x2 double, y2 double")
    want = sorted([(i, 0) for i in range(1, 20)] + [(i, 1) for i in range(-20, 20)] + [(4, 2)])
    assert rows(spatial_join(points, windows, "within")) == want
    assert spatial_join(windows, windows, "intersects").count() == 9
    lost = points.unionByName(spark.createDataFrame([(99, inf, 0.0)], "id long, x double, y double"))
    assert rows(convex_hull(lost)) == rows(convex_hull(points))
    assert closest_pairs(lost).count() == closest_pairs(points).count()


def test_group_keys_come_back_unaltered(spark):
    keys = [2**53, 2**53 + 1, None, -(2**63)]
    data = [(k, i % 5, i // 5) for k in keys for i in range(25)]
    df = spark.createDataFrame(data, "k long, x long, y long").repartition(4)
    got = {(r.k, r.x, r.y) for r in convex_hull(df, group_by="k").collect()}
    assert got == {(k, x, y) for k in keys for x in (0, 4) for y in (0, 4)}
    many = df.withColumns({"t": F.timestamp_micros(F.col("x") * 7 + 1), "b": F.lit(b"\x00\xff"), "d": F.lit(0.1)})
    out = convex_hull(many, group_by=["t", "b", "d"])
    assert dict(out.dtypes) == {"t": "timestamp", "b": "binary", "d": "double", "x": "bigint", "y": "bigint"}
    assert out.select("t", "b", "d").distinct().exceptAll(many.select("t", "b", "d").distinct()).isEmpty()


def test_a_hull_reads_its_input_once(spark):
    # the partial hulls are written while the plan is built; what is left reads only them
    df = spark.range(100).selectExpr("id % 7 AS x", "id % 11 AS y").distinct()
    plan = convex_hull(df)._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "parquet" in plan


def test_levels_follow_small_windows_and_stay_few(spark):
    data = [(i, 0.0, 0.0, 0.5, 0.5) for i in range(400)] + [(i, 0.0, 0.0, 1000.0, 1000.0) for i in range(600)]
    data += [(1, 0.0, 0.0, 0.001, 0.001)]
    stats = SideStats(spark.createDataFrame(data, "id long, x1 double, y1 double, x2 double, y2 double"))
    assert stats.levels() == [-1, 10]
    assert stats.levels(cell=8.0) == [3, 10]
    assert open_ended([0, 3])[-1] == 1024 and len(open_ended([0, 3])) < 14


def test_no_broadcast_of_columns_without_a_size_bound(spark):
    fixed, text = spark.range(3), spark.range(3).selectExpr("id", "cast(id as string) as name")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(size_guard(fixed, 3)) and not hinted(size_guard(text, 3))


def test_trailing_commas_and_both_parsers(spark):
    lines = spark.createDataFrame([("7,1,2,,",), ("8,4,4,0,0,",), ("9,1",), ("",), ("1,2,3,4",)], "value string")
    pts, rects = parse_shapes(lines)
    assert rows(pts) == [(7, 1.0, 2.0)] and rows(rects, "id", "x1", "y1", "x2", "y2") == [(8, 0.0, 0.0, 4.0, 4.0)]
    both = parse_probes(lines)
    assert rows(both, "id", "x1", "y1", "x2", "y2", "is_point") == [
        (7, 1.0, 2.0, 1.0, 2.0, True), (8, 0.0, 0.0, 4.0, 4.0, False)]


def test_sink_keeps_null_fields_modes_and_order(spark, tmpdir_path):
    df = spark.createDataFrame([(1, None, 3), (None, 2, 3)], "a long, b long, c long").orderBy("c", "a")
    out = f"{tmpdir_path}/rows"
    write_csv(df, out, single_file=True)
    assert [r.value for r in spark.read.text(out).collect()] == [",2,3", "1,,3"]
    with pytest.raises(Exception, match="(?i)already exists"):
        write_csv(df, out, mode="errorifexists")
    write_csv(spark.range(3).orderBy(F.desc("id")), out, single_file=True)
    assert [r.value for r in spark.read.text(out).collect()] == ["2", "1", "0"]
    import glob
    assert len(glob.glob(f"{out}/part-*")) == 1


def test_coincident_points_with_ids(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 0, 0)], "id long, x long, y long")
    assert rows(coincident_points(df), "x", "y", "n") == [(0, 0, 3)]
    assert rows(coincident_points(df, id_col="id"), "id", "n") == [(1, 3), (2, 3), (4, 3)]
