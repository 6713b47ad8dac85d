"""Rectangle union by tiles: growth under deep overlap, hot edges and corners, sampled cuts, coordinate types."""

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from conftest import rows
from planekit import rect_union_vertices
from planekit.operators import union
from planekit.operators._tiles_local import TileTree, covered, tile_vertices, whole
from planekit.operators.union import union_tiles
from test_properties import _raster_vertices

SCHEMA = "x1 long, y1 long, x2 long, y2 long"


def _staircase(n, side):
    """n squares, each shifted by one: of about n * side edge crossings only the staircase is border."""
    rects = [(i, i, i + side, i + side) for i in range(n)]
    last = n - 1
    want = {(0, 0), (0, side), (side, 0), (last, last + side), (last + side, last), (last + side, last + side)}
    for i in range(1, n):
        want |= {(i, i - 1 + side), (i, i + side), (i - 1 + side, i), (i + side, i)}
    return rects, sorted(want)


def test_staircase_rows_grow_with_the_border_not_with_crossings(spark):
    held = {}
    for n in (800, 3200):
        rects, want = _staircase(n, 200)
        df = spark.createDataFrame(rects, SCHEMA).repartition(4)
        assert rows(rect_union_vertices(df, rows_per_tile=400)) == want
        held[n] = union_tiles(df, rows_per_tile=400)[0].count()
    # about 200 crossings for each square, but a bounded number of rows
    assert all(rows_held < 3 * n for n, rows_held in held.items())


@pytest.mark.parametrize("sample", [20, 100_000])
def test_any_sample_gives_the_same_vertices(spark, sample):
    rng = random.Random(sample)
    rects = [(x, y, x + rng.randint(1, 9), y + rng.randint(1, 9))
             for x, y in ((rng.randint(0, 60), rng.randint(0, 60)) for _ in range(300))]
    df = spark.createDataFrame(rects, SCHEMA).repartition(3)
    assert rows(rect_union_vertices(df, rows_per_tile=40, sample=sample)) == _raster_vertices(rects)


def test_a_third_of_the_rectangles_share_a_corner_or_an_edge(spark):
    rng = random.Random(3)
    corner = [(0, 0, rng.randint(1, 40), rng.randint(1, 40)) for _ in range(300)]
    edge = [(0, y, rng.randint(1, 40), y + rng.randint(1, 5)) for y in (rng.randint(-60, 60) for _ in range(300))]
    rest = [(x, y, x + 2, y + 2) for x, y in ((rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(300))]
    rects = corner + edge + rest + rest[:5]
    df = spark.createDataFrame(rects, SCHEMA)
    assert rows(rect_union_vertices(df, rows_per_tile=20)) == _raster_vertices(rects)
    tiles, _ = union_tiles(df, rows_per_tile=20)
    assert tiles.groupBy("tile").count().agg({"count": "max"}).first()[0] < 200


def test_collinear_points_do_not_depend_on_tiles(spark):
    rng = random.Random(5)
    rects = [(x, y, x + rng.randint(1, 6), y + rng.randint(1, 6))
             for x, y in ((rng.randint(0, 25), rng.randint(0, 25)) for _ in range(120))]
    df = spark.createDataFrame(rects, SCHEMA)
    one, many = (rows(rect_union_vertices(df, keep_collinear=True, rows_per_tile=n)) for n in (10_000, 20))
    assert one == many and set(_raster_vertices(rects)) < set(one)


def test_exact_far_from_zero_and_for_decimals(spark):
    far = 1_700_000_000_000_000_000
    rects = [(0, 0, 2, 2), (1, 1, 3, 3), (1, 0, 2, 9)]
    want = _raster_vertices(rects)
    moved = spark.createDataFrame([tuple(v + far for v in r) for r in rects], SCHEMA)
    assert rows(rect_union_vertices(moved, rows_per_tile=1)) == [(x + far, y + far) for x, y in want]
    d = lambda v: Decimal(v) + Decimal("0.1")
    exact = spark.createDataFrame([tuple(map(d, r)) for r in rects], "x1 decimal(20,2), y1 decimal(20,2), x2 decimal(20,2), y2 decimal(20,2)")
    assert rows(rect_union_vertices(exact, rows_per_tile=1)) == [(d(x), d(y)) for x, y in want]


def test_nothing_to_cover(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(rect_union_vertices(empty)) == []
    flat = spark.createDataFrame([(0, 0, 0, 5), (None, 0, 1, 1)], SCHEMA)
    assert rows(rect_union_vertices(flat)) == []


def test_tiles_are_cut_until_few_crossings_are_left():
    rng = np.random.default_rng(1)
    at = rng.integers(0, 1000, (400, 2))
    r = whole(pd.DataFrame(np.hstack([at, at + rng.integers(1, 30, (400, 2))]), columns=["x1", "y1", "x2", "y2"]))
    points = lambda cells: sorted((int(x), int(y)) for xs, ys in tile_vertices(r, False, cells) for x, y in zip(xs, ys))
    assert points(50) == points(1 << 20)
    tree = TileTree(r, 20)
    assert tree.leaves > 10 and not any(covered(part) for _, part in tree.cut(r))


def test_a_task_takes_many_batches_through_the_tree_at_once():
    rng = np.random.default_rng(2)
    at = rng.integers(0, 3000, (4000, 2))
    df = pd.DataFrame(np.hstack([at, at + rng.integers(1, 40, (4000, 2))]), columns=["x1", "y1", "x2", "y2"])
    tree = TileTree(whole(df), 40)
    taken = list(union._gathered((whole(df[k:k + 100]) for k in range(0, 4000, 100)), 1500))
    assert [len(r[0]) for r in taken] == [1500, 1500, 1000]
    held = sorted((leaf, *row) for r in taken for leaf, part in tree.cut(r) for row in zip(*(c.tolist() for c in part)))
    assert set(held) == {(leaf, *row) for leaf, part in tree.cut(whole(df)) for row in zip(*(c.tolist() for c in part))}


def test_a_covered_tile_takes_one_rectangle():
    small = pd.DataFrame([(x, y, x + 1, y + 1) for x in range(0, 200, 10) for y in range(0, 200, 10)],
                         columns=["x1", "y1", "x2", "y2"])
    tree = TileTree(whole(small), 10)
    large = pd.DataFrame([(-5 - k, -5, 900, 900) for k in range(50)], columns=small.columns)
    parts = dict(tree.cut(whole(pd.concat([small, large]))))
    alone = dict(tree.cut(whole(large)))
    inner = [leaf for leaf, part in alone.items() if covered(part)]
    assert inner and all(len(parts[leaf][0]) == 1 and covered(parts[leaf]) for leaf in inner)
