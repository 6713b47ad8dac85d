"""

Naive = what a direct translation would run: theta joins (nested loop),
all-pairs self-joins, a hull computed in one task.  Registered queries are timed
with their planning jobs, median of three runs.  Usage:
    python tools/naive_forms.py [sf_dir]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from planekit.operators._geom_local import hull_ccw  # noqa: E402
from planekit.plans.catalog import QUERIES  # noqa: E402
from planekit.plans.views import view  # noqa: E402
from planekit.session import local_session  # noqa: E402


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name, df):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name:28s} {time.perf_counter() - t0:8.2f}s", flush=True)

    def own(*names):
        for name in names:
            took = []
            for _ in range(3):
                t0 = time.perf_counter()
                QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - t0)
            print(f"own {name:28s} {sorted(took)[1]:8.2f}s", flush=True)

    p, w, r, iso = (view(spark, d, n) for n in ("pts", "win", "rects", "iso"))
    run("warmup", p.groupBy("x").count())
    run("theta join_point_rect", p.alias("p").join(w.alias("w"), (F.col("p.x") > F.col("w.x1")) & (F.col("p.x") < F.col("w.x2"))
        & (F.col("p.y") > F.col("w.y1")) & (F.col("p.y") < F.col("w.y2"))).select("p.id", "w.id"))
    run("theta join_rect_rect", r.alias("a").join(r.alias("b"), (F.col("a.x1") <= F.col("b.x2")) & (F.col("b.x1") <= F.col("a.x2"))
        & (F.col("a.y1") <= F.col("b.y2")) & (F.col("b.y1") <= F.col("a.y2"))).select("a.id", "b.id"))

    def one_task_hull(it):
        frames = [b for b in it]
        pdf = pd.concat(frames) if frames else pd.DataFrame({"x": [], "y": []})
        h = hull_ccw(pdf["x"].to_numpy(), pdf["y"].to_numpy())
        yield pd.DataFrame(h, columns=["x", "y"]).astype(np.int64)
    # rectangle union with plain theta joins (the oracle's shape run in Spark)
    R = r.select("x1", "y1", "x2", "y2")
    V = R.select(F.col("x1").alias("vx"), "y1", "y2").union(R.select("x2", "y1", "y2"))
    H = R.select(F.col("y1").alias("hy"), "x1", "x2").union(R.select("y2", "x1", "x2"))
    cross = V.alias("v").join(H.alias("h"), (F.col("h.x1") <= F.col("v.vx")) & (F.col("v.vx") <= F.col("h.x2"))
                              & (F.col("v.y1") <= F.col("h.hy")) & (F.col("h.hy") <= F.col("v.y2"))) \
        .select(F.col("v.vx").alias("px"), F.col("h.hy").alias("py"))
    corners = R.select(F.col("x1").alias("px"), F.col("y1").alias("py")).union(R.select("x1", "y2")) \
        .union(R.select("x2", "y1")).union(R.select("x2", "y2"))
    cand = corners.union(cross).distinct()
    hits = cand.join(R, (F.col("x1") <= F.col("px")) & (F.col("px") <= F.col("x2"))
                     & (F.col("y1") <= F.col("py")) & (F.col("py") <= F.col("y2")))
    run("theta rect_union (masks)", hits.groupBy("px", "py").count())
    run("one-task convex_hull", p.select("x", "y").coalesce(1).mapInPandas(one_task_hull, "x long, y long"))
    if "sf0.1" not in d:
        q = iso.select("x", "y").distinct()
        a, b = q.alias("a"), q.alias("b")
        pairs = a.join(b, (F.col("a.x") < F.col("b.x")) | ((F.col("a.x") == F.col("b.x")) & (F.col("a.y") < F.col("b.y")))) \
            .select(((F.col("a.x") - F.col("b.x")) ** 2 + (F.col("a.y") - F.col("b.y")) ** 2).alias("d2"))
        run("all-pairs closest (min d2)", pairs.agg(F.min("d2")))
    own("join_point_rect", "join_rect_rect", "spatial_count_rect", "join_mixed_scale_rects", "convex_hull",
        "rect_union_vertices", "closest_pairs")
    spark.stop()


if __name__ == "__main__":
    main()
