"""Text sources and sinks (S1-S7, K1-K7)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from planekit import (
    collect_matches,
    parse_shapes,
    read_matches,
    read_points,
    read_rects,
    spatial_join,
    take_window,
    write_csv,
)
from planekit.operators.join import match_counts, matches_text


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_points_by_position(spark, tmpdir_path):
    p = _write(f"{tmpdir_path}/p.csv", "1,2\n3.5,-4\n1,2,3\n")
    assert rows(read_points(spark, p)) == [(1.0, 2.0), (1.0, 2.0), (3.5, -4.0)]
    q = _write(f"{tmpdir_path}/q.csv", "a,1,2\nb,3,4\n")
    assert rows(read_points(spark, q, with_id=True)) == [("a", 1.0, 2.0), ("b", 3.0, 4.0)]


def test_io1_malformed(spark, tmpdir_path):
    p = _write(f"{tmpdir_path}/bad.csv", "1,abc\n1\n2,3\n")
    with pytest.raises(Exception):
        read_points(spark, p).collect()
    assert rows(read_points(spark, p, strict=False)) == [(2.0, 3.0)]


def test_read_rects_normalised_and_window(spark, tmpdir_path):
    p = _write(f"{tmpdir_path}/r.csv", "10,10,0,0\n1,1,2,2\n")
    assert rows(read_rects(spark, p)) == [(0.0, 0.0, 10.0, 10.0), (1.0, 1.0, 2.0, 2.0)]
    assert take_window(spark, p) == (0.0, 0.0, 10.0, 10.0)


def test_shapes_and_matches_round_trip(spark, tmpdir_path):
    probes = _write(f"{tmpdir_path}/probes.csv", "100,5,5,12,8\n200,15,5\n300,1,2,3,4,5,6\n")
    wins = _write(f"{tmpdir_path}/wins.csv", "1,0,0,10,10\n2,10,0,20,10\n")
    pts, rects = parse_shapes(spark.read.text(probes))
    w = read_rects(spark, wins, with_id=True)
    pairs = spatial_join(pts, w, "within").unionByName(spatial_join(rects, w, "intersects"))
    m = collect_matches(pairs)
    out = f"{tmpdir_path}/matches"
    matches_text(m).write.mode("overwrite").text(out)
    back = read_matches(spark, out)
    assert rows(back) == [(100, [1, 2]), (200, [2])]
    assert rows(match_counts(back)) == [(100, 2), (200, 1)]


def test_io2_write_overwrite_twice(spark, tmpdir_path):
    df = spark.createDataFrame([(1, [2, 3]), (4, [])], "probe_id long, matches array<long>")
    out = f"{tmpdir_path}/o"
    write_csv(df, out)
    write_csv(df, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["1,2,3", "4"]
    with pytest.raises(Exception):
        write_csv(df, out, mode="errorifexists")
    pts = spark.createDataFrame([(1.5, 2.0)], "x double, y double")
    write_csv(pts, f"{tmpdir_path}/p", single_file=True)
    assert rows(read_points(spark, f"{tmpdir_path}/p")) == [(1.5, 2.0)]
