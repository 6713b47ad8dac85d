"""Hand fixtures (FIXTURES.md): one per operator and per divergence from the reference."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from planekit import (
    closest_pairs,
    coincident_points,
    collect_matches,
    convex_hull,
    farthest_pairs,
    match_counts,
    range_query,
    rect_union_vertices,
    spatial_count,
    spatial_join,
    spatial_join_mixed,
)

PTS = [("1", 0.0, 0.0), ("2", 5.0, 5.0), ("3", 10.0, 10.0), ("4", 10.1, 5.0)]
WIN2 = [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0), (3, 30.0, 30.0, 40.0, 40.0)]
RECT_SCHEMA = "id long, x1 double, y1 double, x2 double, y2 double"


def pts_df(spark, data):
    return spark.createDataFrame(data, "x double, y double")


def test_r1_range_closed_reversed_corners(spark):
    df = spark.createDataFrame(PTS, "id string, x double, y double")
    out = range_query(df, (10, 10, 0, 0))
    assert rows(out, "id") == [("1",), ("2",), ("3",)]


def test_r1_range_window_from_dataframe(spark):
    df = spark.createDataFrame(PTS, "id string, x double, y double")
    win = spark.createDataFrame([(10.0, 10.0, 0.0, 0.0), (0.0, 0.0, 1.0, 1.0)], "x1 double, y1 double, x2 double, y2 double")
    assert rows(range_query(df, win.coalesce(1)), "id") == [("1",), ("2",), ("3",)]


def test_j1_point_join_open_border(spark):
    p = spark.createDataFrame([(int(i), x, y) for i, x, y in PTS], "id long, x double, y double")
    w = spark.createDataFrame([(7, 0.0, 0.0, 10.0, 10.0)], RECT_SCHEMA)
    assert rows(spatial_join(p, w, "within")) == [(2, 7)]
    assert rows(spatial_join(p, w, "within_closed")) == [(1, 7), (2, 7), (3, 7)]


def _j2(spark):
    w = spark.createDataFrame(WIN2, RECT_SCHEMA)
    probes = spark.createDataFrame(
        [(100, 5.0, 5.0, 12.0, 8.0), (101, 20.0, 10.0, 25.0, 15.0), (102, 50.0, 50.0, 60.0, 60.0)], RECT_SCHEMA)
    return w, probes


def test_j2_rect_join_and_lists(spark):
    w, probes = _j2(spark)
    pairs = spatial_join(probes, w, "intersects")
    assert rows(pairs) == [(100, 1), (100, 2), (101, 2)]
    inner = collect_matches(pairs)
    assert rows(inner) == [(100, [1, 2]), (101, [2])]
    left = collect_matches(pairs, probes=probes)
    assert rows(left) == [(100, [1, 2]), (101, [2]), (102, [])]


def test_j3_mixed(spark):
    w, _ = _j2(spark)
    rects = spark.createDataFrame([(100, 5.0, 5.0, 12.0, 8.0)], RECT_SCHEMA)
    pts = spark.createDataFrame([(200, 15.0, 5.0)], "id long, x double, y double")
    out = collect_matches(spatial_join_mixed(pts, rects, w))
    assert rows(out) == [(100, [1, 2]), (200, [2])]


@pytest.mark.parametrize("cell", [None, 10.0, 1.0, 1000.0])
def test_j4_one_pair_in_many_cells(spark, cell):
    w = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 100.0)], RECT_SCHEMA)
    p = spark.createDataFrame([(9, 0.0, 0.0, 100.0, 100.0)], RECT_SCHEMA)
    assert rows(spatial_join(p, w, "intersects", cell=cell)) == [(9, 1)]


def test_j5_repeated_probe_id_merges(spark):
    w, _ = _j2(spark)
    p = spark.createDataFrame([(5, 1.0, 1.0, 2.0, 2.0), (5, 12.0, 1.0, 13.0, 2.0)], RECT_SCHEMA)
    assert rows(collect_matches(spatial_join(p, w, "intersects"))) == [(5, [1, 2])]


def test_a1_counts(spark):
    w, probes = _j2(spark)
    assert rows(spatial_count(probes, w, "intersects")) == [(100, 2), (101, 1)]
    assert rows(spatial_count(probes, w, "intersects", how="left")) == [(100, 2), (101, 1), (102, 0)]
    m = collect_matches(spatial_join(probes, w, "intersects"), probes=probes)
    assert rows(match_counts(m)) == [(100, 2), (101, 1), (102, 0)]


H1 = [(0, 0), (0, 10), (10, 0), (10, 10), (5, 5), (5, 0), (0, 0)]


def test_h1_hull(spark):
    out = convex_hull(pts_df(spark, [(float(a), float(b)) for a, b in H1]))
    assert rows(out) == [(0.0, 0.0), (0.0, 10.0), (10.0, 0.0), (10.0, 10.0)]


def test_h2_collinear(spark):
    out = convex_hull(pts_df(spark, [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]))
    assert rows(out) == [(0.0, 0.0), (2.0, 2.0)]


def test_h3_small(spark):
    assert convex_hull(pts_df(spark, [])).count() == 0
    assert rows(convex_hull(pts_df(spark, [(3.0, 4.0)]))) == [(3.0, 4.0)]


def test_hull_by_group(spark):
    df = spark.createDataFrame([("a", float(x), float(y)) for x, y in H1] + [("b", 1.0, 1.0), ("b", 2.0, 2.0)],
                               "g string, x double, y double")
    out = convex_hull(df, group_by="g")
    assert rows(out) == [("a", 0.0, 0.0), ("a", 0.0, 10.0), ("a", 10.0, 0.0), ("a", 10.0, 10.0),
                         ("b", 1.0, 1.0), ("b", 2.0, 2.0)]


def test_f1_farthest_ties(spark):
    out = farthest_pairs(pts_df(spark, [(float(a), float(b)) for a, b in H1]))
    assert rows(out, "ax", "ay", "bx", "by", "d2") == [(0.0, 0.0, 10.0, 10.0, 200.0), (0.0, 10.0, 10.0, 0.0, 200.0)]
    assert all(math.isclose(r["dist"], math.sqrt(200)) for r in out.collect())


def test_f2_vertical_and_f3_collinear(spark):
    out = farthest_pairs(pts_df(spark, [(0.0, 0.0), (0.0, 9.0), (1.0, 4.0)]))
    assert rows(out, "ax", "ay", "bx", "by", "dist") == [(0.0, 0.0, 0.0, 9.0, 9.0)]
    out = farthest_pairs(pts_df(spark, [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]))
    assert rows(out, "ax", "ay", "bx", "by") == [(0.0, 0.0, 2.0, 2.0)]


def test_c1_closest_ties(spark):
    out = closest_pairs(pts_df(spark, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]))
    assert rows(out, "ax", "ay", "bx", "by", "dist") == [(0.0, 0.0, 1.0, 0.0, 1.0), (1.0, 0.0, 1.0, 1.0, 1.0)]


def test_c2_closest_across_partitions(spark):
    part1 = [(0, 0), (0, 10), (10, 0), (10, 10), (5, 5), (2, 2), (2, 3)]
    part2 = [(-1, -1), (-1, 11), (11, -1), (11, 11), (5.1, 5), (8, 8), (8, 9)]
    df = pts_df(spark, [(float(a), float(b)) for a, b in part1 + part2]).repartition(2)
    (r,) = closest_pairs(df).collect()
    assert (r["ax"], r["ay"], r["bx"], r["by"]) == (5.0, 5.0, 5.1, 5.0)
    assert abs(r["dist"] - 0.1) < 1e-9


def test_c3_coincident(spark):
    df = spark.createDataFrame([(1, 4.0, 4.0), (2, 4.0, 4.0), (3, 9.0, 9.0)], "id long, x double, y double")
    assert rows(closest_pairs(df), "ax", "ay", "bx", "by") == [(4.0, 4.0, 9.0, 9.0)]
    assert rows(coincident_points(df)) == [(4.0, 4.0, 2)]


def test_c4_one_point_and_far_pair(spark):
    assert closest_pairs(pts_df(spark, [(0.0, 0.0)])).count() == 0
    (r,) = closest_pairs(pts_df(spark, [(0.0, 0.0), (2e9, 0.0)])).collect()
    assert r["dist"] == 2e9


def _union(spark, rects, **kw):
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in rects], "x1 double, y1 double, x2 double, y2 double")
    return rows(rect_union_vertices(df, **kw))


def _pts(*ps):
    return sorted((float(a), float(b)) for a, b in ps)


def test_u1_overlap(spark):
    assert _union(spark, [(0, 0, 2, 2), (1, 1, 3, 3)]) == _pts((0, 0), (0, 2), (1, 2), (1, 3), (2, 0), (2, 1), (3, 1), (3, 3))


def test_u2_side_by_side(spark):
    r = [(0, 0, 1, 1), (1, 0, 2, 1)]
    assert _union(spark, r) == _pts((0, 0), (0, 1), (2, 0), (2, 1))
    assert _union(spark, r, keep_collinear=True) == _pts((0, 0), (0, 1), (2, 0), (2, 1), (1, 0), (1, 1))


def test_u3_hole(spark):
    r = [(0, 0, 3, 1), (0, 2, 3, 3), (0, 0, 1, 3), (2, 0, 3, 3)]
    assert _union(spark, r) == _pts((0, 0), (0, 3), (3, 0), (3, 3), (1, 1), (1, 2), (2, 1), (2, 2))


def test_u4_corner_touch(spark):
    assert _union(spark, [(0, 0, 1, 1), (1, 1, 2, 2)]) == _pts((0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (2, 1), (2, 2))


def test_u5_nested_disjoint_degenerate(spark):
    r = [(0, 0, 4, 4), (1, 1, 2, 2), (9, 9, 10, 10), (5, 0, 5, 3)]
    assert _union(spark, r) == _pts((0, 0), (0, 4), (4, 0), (4, 4), (9, 9), (9, 10), (10, 9), (10, 10))


def test_null_nan_dropped(spark):
    df = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (float("nan"), 2.0), (4.0, 4.0)], "x double, y double")
    assert rows(convex_hull(df)) == [(0.0, 0.0), (4.0, 4.0)]
    assert rows(range_query(df, (0, 0, 10, 10)), "x") == [(0.0,), (4.0,)]


def test_decimal_coordinates(spark):
    from decimal import Decimal as D
    rows_in = [(D("0.10"), D("0.10")), (D("0.10"), D("10.10")), (D("10.10"), D("0.10")),
               (D("10.10"), D("10.10")), (D("5.10"), D("5.10")), (D("5.10"), D("5.20"))]
    df = spark.createDataFrame(rows_in, "x decimal(10,2), y decimal(10,2)")
    assert rows(convex_hull(df)) == [(D("0.10"), D("0.10")), (D("0.10"), D("10.10")),
                                     (D("10.10"), D("0.10")), (D("10.10"), D("10.10"))]
    assert rows(farthest_pairs(df), "ax", "ay", "bx", "by") == [
        (D("0.10"), D("0.10"), D("10.10"), D("10.10")), (D("0.10"), D("10.10"), D("10.10"), D("0.10"))]
    (c,) = closest_pairs(df).collect()
    assert (c["ax"], c["ay"], c["bx"], c["by"]) == (D("5.10"), D("5.10"), D("5.10"), D("5.20"))
    w = spark.createDataFrame([(1, D("0.00"), D("0.00"), D("5.15"), D("5.15"))],
                              "id long, x1 decimal(10,2), y1 decimal(10,2), x2 decimal(10,2), y2 decimal(10,2)")
    p = df.withColumn("id", F.monotonically_increasing_id())
    assert spatial_join(p, w, "within").count() == 2  # (0.10,0.10) and (5.10,5.10)
