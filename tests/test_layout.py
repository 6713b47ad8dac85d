"""Hilbert layout, long match lists, and one-file output."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from planekit import collect_matches, range_query, write_csv
from planekit.operators.join import matches_text
from planekit.sources.layout import hilbert_key, write_points
from planekit.sources.sinks import match_chunks, match_lines, write_matches


def test_curve_visits_every_cell_once_and_only_steps_to_neighbours(spark):
    side = 16
    cells = spark.range(side * side).select((F.col("id") / side).cast("long").alias("x"), (F.col("id") % side).alias("y"))
    way = [(r.x, r.y) for r in cells.withColumn("k", hilbert_key(F.col("x"), F.col("y"), 4)).orderBy("k").collect()]
    keys = [r.k for r in cells.select(hilbert_key(F.col("x"), F.col("y"), 4).alias("k")).orderBy("k").collect()]
    assert keys == list(range(side * side))
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(way, way[1:]))


def _touched(path, x1, y1, x2, y2):
    """Row groups, and those whose coordinate ranges meet the window: what a scan with pushed filters reads."""
    total = hit = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            sx, sy = (meta.row_group(g).column(names.index(c)).statistics for c in "xy")
            total += 1
            hit += sx.min <= x2 and sx.max >= x1 and sy.min <= y2 and sy.max >= y1
    return total, hit


def test_a_small_window_reads_few_row_groups(spark, tmpdir_path):
    pts = spark.range(60_000).select("id", (F.rand(1) * 1000).alias("x"), (F.rand(2) * 1000).alias("y"))
    pts = pts.unionByName(spark.createDataFrame([(-1, None, 1.0), (-2, float("nan"), 1.0)], "id long, x double, y double"))
    by_curve, by_x = f"{tmpdir_path}/curve", f"{tmpdir_path}/x"
    write_points(pts, by_curve, files=300)
    pts.repartitionByRange(300, "x").write.parquet(by_x)
    window = (400.0, 400.0, 500.0, 500.0)  # 1 %
    total, hit = _touched(by_curve, *window)
    assert total >= 300 and hit < 0.05 * total
    assert _touched(by_x, *window)[1] > 2 * hit
    stored = spark.read.parquet(by_curve)
    assert stored.count() == 60_002
    assert rows(range_query(stored, window), "id") == rows(range_query(pts, window), "id")
    plan = range_query(stored, window)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(x,400.0)" in plan


def test_layout_of_one_place_of_nothing_and_of_far_integers(spark, tmpdir_path):
    far = 1_700_000_000_000_000_000
    for k, data in enumerate(([(1, 5, 5), (2, 5, 5)], [], [(i, far + i, -far) for i in range(50)])):
        df = spark.createDataFrame(data, "id long, x long, y long")
        write_points(df, f"{tmpdir_path}/{k}", files=3)
        assert rows(spark.read.schema(df.schema).parquet(f"{tmpdir_path}/{k}")) == sorted(data)


def _pairs(spark):
    rng = random.Random(4)
    data = [(7, i) for i in range(30_000)] + [(rng.randint(0, 40), rng.randint(0, 99)) for _ in range(3000)] + [(7, 5)] * 9
    rng.shuffle(data)
    return spark.createDataFrame(data, "probe_id long, window_id long").repartition(5)


def test_long_lists_come_in_ordered_pieces(spark):
    pairs = _pairs(spark)
    got, open_list = {}, None
    chunks = match_chunks(pairs, parts=6)
    for r in chunks.orderBy("part", "k").collect():
        assert r.starts == (open_list is None) and (r.starts or open_list == r.probe_id) and len(r.window_ids) <= 10_000
        got.setdefault(r.probe_id, []).extend(r.window_ids)
        open_list = None if r.ends else r.probe_id
    assert open_list is None
    assert got == {r.probe_id: r.matches for r in collect_matches(pairs).collect()}
    assert chunks.where("probe_id = 7").select("part").distinct().count() > 1


def test_lines_of_pieces_equal_lines_of_lists(spark, tmpdir_path):
    pairs, probes = _pairs(spark), spark.createDataFrame([(7,), (3,), (999,)], "id long")
    want = rows(matches_text(collect_matches(pairs, probes)))
    assert rows(match_lines(pairs, probes), "value") == want
    write_matches(pairs, f"{tmpdir_path}/m", probes=probes)
    assert rows(spark.read.text(f"{tmpdir_path}/m")) == want
    none = spark.createDataFrame([], "probe_id long, window_id long")
    assert rows(match_lines(none)) == [] and rows(match_lines(none, probes), "value") == [("3",), ("7",), ("999",)]


def test_one_file_keeps_order_and_parallel_parts(spark, tmpdir_path):
    df = spark.range(0, 5000, 1, 6).select((F.col("id") * 7 % 5000).alias("a"), F.col("id").alias("b")).orderBy("a")
    one, many = f"{tmpdir_path}/one", f"{tmpdir_path}/many"
    write_csv(df, many)
    write_csv(df, one, single_file=True)
    files = glob.glob(f"{one}/part-*")
    assert len(files) == 1 and glob.glob(f"{one}/_SUCCESS")
    lines = open(files[0]).read()
    assert lines == "".join(open(f).read() for f in sorted(glob.glob(f"{many}/part-*")))
    assert lines.split("\n")[:2] == ["0,0", "1,2143"] and lines.count("\n") == 5000
    write_csv(df.limit(3), one, single_file=True)  # replaces
    assert open(glob.glob(f"{one}/part-*")[0]).read().count("\n") == 3
    with pytest.raises(Exception):
        write_csv(df, one, mode="errorifexists", single_file=True)
    assert not glob.glob(f"{tmpdir_path}/.one*")
    write_csv(spark.createDataFrame([], "a long"), f"{tmpdir_path}/none", single_file=True)
    assert rows(spark.read.text(f"{tmpdir_path}/none")) == []
