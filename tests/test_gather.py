"""Match lists put together by probe id: the same as from pairs, and no pair is shuffled."""

import random

from conftest import SF001
from planekit.operators import gather
from planekit.operators.join import collect_matches, spatial_join_shapes
from planekit.plans.catalog import QUERIES
from planekit.sources.text import read_matches

SHAPES = "id bigint, x1 bigint, y1 bigint, x2 bigint, y2 bigint, is_point boolean"
WINDOWS = "id bigint, x1 bigint, y1 bigint, x2 bigint, y2 bigint"


def _both(spark, shapes, windows):
    s, w = spark.createDataFrame(shapes, SHAPES), spark.createDataFrame(windows, WINDOWS)
    out = [collect_matches(spatial_join_shapes(s, w, lists=lists)).collect() for lists in (False, True)]
    return [sorted(((r.probe_id, r.matches) for r in rows), key=str) for rows in out]


def _box(rng, size):
    x, y = rng.randrange(-500, 500), rng.randrange(-500, 500)
    return x, y, x + rng.randrange(size), y + rng.randrange(size)


def test_lists_equal_those_from_pairs(spark, monkeypatch):
    rng = random.Random(5)
    windows = [(rng.choice([None, *range(150)]), *_box(rng, rng.choice([1, 8, 60, 900]))) for _ in range(200)]
    shapes = []
    for i in range(1500):
        x, y, x2, y2 = _box(rng, rng.choice([2, 40, 1200]))
        point = rng.random() < 0.6
        shapes.append((rng.choice([None, 7, i, i // 2]), x, y, x if point else x2, y if point else y2, point))
    monkeypatch.setattr(gather, "COMPARED", 50)  # an id's rows lie in several blocks
    monkeypatch.setattr(gather, "FEW", 400)
    pairs, lists = _both(spark, shapes, windows)
    assert len(pairs) > 500 and pairs == lists


def test_windows_without_ids_and_far_coordinates(spark):
    far = 1 << 62
    windows = [(None, 0, 0, 10, 10), (3, -far, -far, far, far), (4, far, far, far, far), (4, 20, 20, 20, 20)]
    shapes = [(1, 5, 5, 5, 5, True), (2, far, far, far, far, False), (3, far, far, far, far, True), (4, 20, 20, 20, 20, False)]
    pairs, lists = _both(spark, shapes, windows)
    assert pairs == lists == [(1, [3]), (2, [3, 4]), (4, [3, 4])]
    assert _both(spark, shapes[:1], windows[:1]) == [[(1, [])]] * 2
    assert _both(spark, shapes, windows[:0]) == [[], []]


def test_match_counts_shuffles_no_pairs(spark):
    df = QUERIES["match_counts"](spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "MapInArrow" in plan and "collect_set" not in plan and plan.count("Exchange") == 1


def test_point_and_rectangle_lists_by_probe_id(spark, monkeypatch):
    from planekit.operators import join
    monkeypatch.setattr(join, "GROUP", 0)
    rng = random.Random(6)
    w = spark.createDataFrame([(i % 60, *_box(rng, 200)) for i in range(80)], WINDOWS)
    p = spark.createDataFrame([(f"p{i // 2}", *_box(rng, 90)) for i in range(300)], WINDOWS.replace("id bigint", "id string"))
    for predicate in join.PREDICATES:
        pairs, lists = (collect_matches(join.spatial_join(p, w, predicate, x="x1", y="y1", lists=lists)) for lists in (False, True))
        assert sorted(pairs.collect()) == sorted(lists.collect())
        assert "collect_set" not in spark._jvm.PythonSQLUtils.explainString(lists._jdf.queryExecution(), "simple")


def test_lists_over_parts_of_a_batch_come_sorted(spark, monkeypatch):
    monkeypatch.setattr(gather, "LOOKED_UP", 30)
    monkeypatch.setattr(gather, "HANDED", 100)
    rng = random.Random(8)
    windows = [(rng.choice([None, *range(150)]), *_box(rng, rng.choice([1, 8, 60, 900]))) for _ in range(900)]
    shapes = []
    for i in range(900):
        x, y, x2, y2 = _box(rng, rng.choice([2, 40, 1200]))
        point = rng.random() < 0.5
        shapes.append((rng.choice([None, 7, i, i // 2]), x, y, x if point else x2, y if point else y2, point))
    pairs, lists = _both(spark, shapes, windows)
    assert len(pairs) > 300 and pairs == lists
    s, w = spark.createDataFrame(shapes, SHAPES), spark.createDataFrame(windows, WINDOWS)
    assert all(r.window_id == sorted(r.window_id) for r in spatial_join_shapes(s, w, lists=True).collect())


def test_match_rows_are_read_and_written_by_compiled_casts(spark):
    df = QUERIES["match_counts"](spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "lambda" not in plan and "concat_ws" in plan and "split" in plan
    back = read_matches(spark.createDataFrame([(" 1, 2 ,3",), ("4",)], "value string"))
    assert [tuple(r) for r in back.collect()] == [(1, [2, 3]), (4, [])]
