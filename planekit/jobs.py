"""Command-line batch jobs over headerless CSV text, one per query.

    spark-submit planekit/jobs.py <job> <inputs...> <output>    (or: python -m planekit.jobs ...)

| job | inputs | output rows |
| --- | --- | --- |
| range-query | points `id,x,y`; window file (first row `x1,y1,x2,y2`) | `id` |
| join | windows `id,x1,y1,x2,y2`; probes (`id,x1,y1,x2,y2` or `id,x,y` per row) | `id,m1,m2,...` by id |
| aggregation | windows; probes | `id,count` by id |
| convex-hull | points `x,y` | `x,y` hull vertices, sorted |
| farthest-pair | points `x,y` | two rows `x,y` per pair |
| closest-pair | points `x,y` | two rows `x,y` per pair |
| union | rectangles `x1,y1,x2,y2` | `x,y` boundary vertices, sorted (`--keep-collinear`: with corners on straight stretches) |

Each job is the library operator between a text source and a text sink;
outputs are sorted with a distributed ``orderBy`` (range partitioning), never
gathered to one task.  The session comes from ``getOrCreate`` (spark-submit
supplies the master).  ``join`` and ``aggregation`` refuse an existing output
unless ``--overwrite`` is given; the others replace it.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file (spark-submit planekit/jobs.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from planekit.operators.hull import convex_hull, farthest_pairs  # noqa: E402
from planekit.operators.join import spatial_join_shapes  # noqa: E402
from planekit.operators.pairs import closest_pairs  # noqa: E402
from planekit.operators.range import range_query  # noqa: E402
from planekit.operators.union import rect_union_vertices  # noqa: E402
from planekit.sources.sinks import pairs_as_points, write_csv, write_matches  # noqa: E402
from planekit.sources.text import read_points, read_probes, read_rects, take_window  # noqa: E402


def _pairs(spark: SparkSession, windows: str, probes: str) -> DataFrame:
    return spatial_join_shapes(read_probes(spark, probes), read_rects(spark, windows, with_id=True))


def run_range_query(spark, points, window, out, overwrite=True):
    res = range_query(read_points(spark, points, with_id=True), take_window(spark, window))
    write_csv(res.select("id").orderBy("id"), out, "overwrite" if overwrite else "errorifexists")


def run_join(spark, windows, probes, out, overwrite=False):
    write_matches(_pairs(spark, windows, probes), out, "overwrite" if overwrite else "errorifexists")


def run_aggregation(spark, windows, probes, out, overwrite=False):
    pairs = _pairs(spark, windows, probes)
    counts = pairs.groupBy("probe_id").agg(F.count_distinct("window_id").alias("n"))
    write_csv(counts.orderBy("probe_id"), out, "overwrite" if overwrite else "errorifexists")


def run_convex_hull(spark, points, out, overwrite=True):
    hull = convex_hull(read_points(spark, points)).orderBy("x", "y")
    write_csv(hull, out, "overwrite" if overwrite else "errorifexists")


def _write_pairs(pairs: DataFrame, out: str, overwrite: bool) -> None:
    rows = pairs_as_points(pairs.orderBy("ax", "ay", "bx", "by")).orderBy("pair_no", "end")
    write_csv(rows.select("x", "y"), out, "overwrite" if overwrite else "errorifexists")


def run_farthest_pair(spark, points, out, overwrite=True):
    _write_pairs(farthest_pairs(read_points(spark, points)), out, overwrite)


def run_closest_pair(spark, points, out, overwrite=True):
    _write_pairs(closest_pairs(read_points(spark, points)), out, overwrite)


def run_union(spark, rects, out, overwrite=True, keep_collinear=False):
    res = rect_union_vertices(read_rects(spark, rects), keep_collinear=keep_collinear).orderBy("x", "y")
    write_csv(res, out, "overwrite" if overwrite else "errorifexists")


JOBS = {
    "range-query": (run_range_query, ["points", "window"]),
    "join": (run_join, ["windows", "probes"]),
    "aggregation": (run_aggregation, ["windows", "probes"]),
    "convex-hull": (run_convex_hull, ["points"]),
    "farthest-pair": (run_farthest_pair, ["points"]),
    "closest-pair": (run_closest_pair, ["points"]),
    "union": (run_union, ["rects"]),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="planekit.jobs", description=__doc__.split("\n")[0])
    sub = parser.add_subparsers(dest="job", required=True)
    for name, (_, inputs) in JOBS.items():
        p = sub.add_parser(name)
        for i in inputs:
            p.add_argument(i)
        p.add_argument("output")
        p.add_argument("--overwrite", action="store_true", default=None,
                       help="replace an existing output (default for all but join/aggregation)")
        if name == "union":
            p.add_argument("--keep-collinear", action="store_true",
                           help="also keep input corners on a straight stretch of the boundary")
    args = parser.parse_args(argv)
    fn, inputs = JOBS[args.job]
    spark = spark or SparkSession.builder.appName(f"planekit-{args.job}").getOrCreate()
    kwargs = {} if args.overwrite is None else {"overwrite": True}
    if getattr(args, "keep_collinear", False):
        kwargs["keep_collinear"] = True
    fn(spark, *[getattr(args, i) for i in inputs], args.output, **kwargs)


if __name__ == "__main__":
    main(sys.argv[1:])
