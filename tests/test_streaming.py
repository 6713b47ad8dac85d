"""Streaming probes against static windows (stream-static join)."""

from conftest import rows
from planekit import spatial_join
from planekit.streaming import join_stream, range_stream, write_stream


def test_stream_point_and_rect_probes(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 5.0), (3, 50.0, 50.0)], "id long, x double, y double")
    pts.write.parquet(f"{src}/a")
    w = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)],
                              "id long, x1 double, y1 double, x2 double, y2 double")
    stream = spark.readStream.schema(pts.schema).parquet(f"{src}/a")
    q = write_stream(join_stream(stream, w, "within"), f"{tmpdir_path}/out", f"{tmpdir_path}/ck")
    q.awaitTermination(120)
    assert rows(spark.read.parquet(f"{tmpdir_path}/out")) == [(1, 1), (2, 2)]
    q2 = write_stream(range_stream(stream, (0, 0, 20, 20)), f"{tmpdir_path}/out2", f"{tmpdir_path}/ck2")
    q2.awaitTermination(120)
    assert rows(spark.read.parquet(f"{tmpdir_path}/out2"), "id") == [(1,), (2,)]

    rsrc = f"{tmpdir_path}/rsrc"
    probes = spark.createDataFrame([(100, 5.0, 5.0, 12.0, 8.0), (101, -100.0, -100.0, 100.0, 100.0)],
                                   "id long, x1 double, y1 double, x2 double, y2 double")
    probes.write.parquet(rsrc)
    rstream = spark.readStream.schema(probes.schema).parquet(rsrc)
    q3 = write_stream(join_stream(rstream, w, "intersects"), f"{tmpdir_path}/out3", f"{tmpdir_path}/ck3")
    q3.awaitTermination(120)
    expect = rows(spatial_join(probes, w, "intersects"))
    assert rows(spark.read.parquet(f"{tmpdir_path}/out3")) == expect == [(100, 1), (100, 2), (101, 1), (101, 2)]


def test_stream_equals_batch_random(spark, tmpdir_path):
    """Random probes of random sizes (some far larger than every window):
    the streaming path, with levels clamped to the windows', equals batch."""
    import random
    rnd = random.Random(11)
    wins = [(i, float(x), float(y), float(x + rnd.randint(1, 30)), float(y + rnd.randint(1, 30)))
            for i, (x, y) in enumerate((rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(60))]
    w = spark.createDataFrame(wins, "id long, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([(i, float(rnd.randint(0, 230)), float(rnd.randint(0, 230))) for i in range(300)],
                                "id long, x double, y double")
    rects = spark.createDataFrame(
        [(i, float(x), float(y), float(x + rnd.choice([1, 5, 40, 300])), float(y + rnd.choice([1, 5, 40, 300])))
         for i, (x, y) in enumerate((rnd.randint(-50, 230), rnd.randint(-50, 230)) for _ in range(120))],
        "id long, x1 double, y1 double, x2 double, y2 double")
    for name, df, pred in (("p", pts, "within"), ("r", rects, "intersects")):
        df.write.parquet(f"{tmpdir_path}/{name}")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmpdir_path}/{name}")
        q = write_stream(join_stream(stream, w, pred), f"{tmpdir_path}/{name}_out", f"{tmpdir_path}/{name}_ck")
        q.awaitTermination(180)
        assert rows(spark.read.parquet(f"{tmpdir_path}/{name}_out")) == rows(spatial_join(df, w, pred))
