"""Command-line jobs: text in, text out, in the reference's row formats."""

import os

import pytest

from planekit.jobs import main


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def _lines(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_jobs_end_to_end(spark, tmpdir_path):
    d = tmpdir_path
    pts_id = _write(f"{d}/pts_id.csv", "1,0,0\n2,5,5\n3,10,10\n4,10.1,5\n")
    window = _write(f"{d}/window.csv", "10,10,0,0\n")
    main(["range-query", pts_id, window, f"{d}/rq"], spark=spark)
    assert sorted(_lines(spark, f"{d}/rq")) == ["1", "2", "3"]

    wins = _write(f"{d}/wins.csv", "1,0,0,10,10\n2,10,0,20,10\n3,30,30,40,40\n")
    probes = _write(f"{d}/probes.csv", "100,5,5,12,8\n101,20,10,25,15\n200,15,5\n")
    main(["join", wins, probes, f"{d}/join"], spark=spark)
    assert _lines(spark, f"{d}/join") == ["100,1,2", "101,2", "200,2"]
    with pytest.raises(Exception):
        main(["join", wins, probes, f"{d}/join"], spark=spark)   # exists: refused
    main(["aggregation", wins, probes, f"{d}/agg", "--overwrite"], spark=spark)
    assert _lines(spark, f"{d}/agg") == ["100,2", "101,1", "200,1"]

    pts = _write(f"{d}/pts.csv", "0,0\n0,10\n10,0\n10,10\n5,5\n5,0\n0,0\n")
    main(["convex-hull", pts, f"{d}/hull"], spark=spark)
    assert _lines(spark, f"{d}/hull") == ["0.0,0.0", "0.0,10.0", "10.0,0.0", "10.0,10.0"]
    main(["farthest-pair", pts, f"{d}/far"], spark=spark)
    assert _lines(spark, f"{d}/far") == ["0.0,0.0", "10.0,10.0", "0.0,10.0", "10.0,0.0"]
    close = _write(f"{d}/close.csv", "0,0\n1,0\n1,1\n")
    main(["closest-pair", close, f"{d}/close"], spark=spark)
    assert _lines(spark, f"{d}/close") == ["0.0,0.0", "1.0,0.0", "1.0,0.0", "1.0,1.0"]

    rects = _write(f"{d}/rects.csv", "0,0,2,2\n3,3,1,1\n")
    main(["union", rects, f"{d}/union"], spark=spark)
    assert _lines(spark, f"{d}/union") == ["0.0,0.0", "0.0,2.0", "1.0,2.0", "1.0,3.0",
                                           "2.0,0.0", "2.0,1.0", "3.0,1.0", "3.0,3.0"]


def test_python_workers_need_no_package_on_path(spark, tmpdir_path):
    """Pandas-UDF code is shipped by value: a worker whose path lacks the
    package (a cluster without it installed) still runs the hull."""
    import subprocess
    import sys
    d = tmpdir_path
    pts = _write(f"{d}/p.csv", "0,0\n0,10\n10,0\n10,10\n5,5\n")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, os.path.join(repo, "planekit", "jobs.py"), "convex-hull", pts, f"{d}/h"],
                       cwd="/", env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert sorted(_lines(spark, f"{d}/h")) == ["0.0,0.0", "0.0,10.0", "10.0,0.0", "10.0,10.0"]


def test_new_operators_need_no_package_on_workers_either(tmpdir_path):
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = _write(f"{tmpdir_path}/run.py", f"""
import sys
sys.path.insert(0, {repo!r})
from planekit import convex_hull, farthest_pairs, rect_union_vertices, spatial_count
from planekit.operators.count import count_meeting
from planekit.session import local_session
from planekit.sources.sinks import match_chunks
s = local_session(2)
s.sparkContext.setCheckpointDir({tmpdir_path!r})
r = s.createDataFrame([(i, i, i, i + 3, i + 3) for i in range(40)], "id long, x1 long, y1 long, x2 long, y2 long")
p = s.createDataFrame([(k, k * k) for k in range(-40, 40)], "x long, y long")
w = r.toDF("_wid", "_wx1", "_wy1", "_wx2", "_wy2").drop("_wid")
q = r.selectExpr("cast(id as string) _pid", "x1 _px1", "y1 _py1", "x2 _px2", "y2 _py2")
print("OUT", spatial_count(r, r, "intersects").count(), count_meeting(q, w, local=0, strips=3, group=8).count(),
      rect_union_vertices(r, rows_per_tile=8).count(), convex_hull(p, vertices=10).count(),
      farthest_pairs(p, vertices=10).count(), match_chunks(r.selectExpr("id % 3 probe_id", "id window_id")).count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, script], cwd="/", env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "OUT 40 40 160 80 1 3" in r.stdout, r.stdout
