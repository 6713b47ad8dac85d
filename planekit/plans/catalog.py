"""The registered queries: each a Spark DataFrame over the driver's tables,
paired with an independent DuckDB oracle (plain theta joins / brute force).

Spark side: the scalable operators of ``planekit.operators``.  Oracle side:
the naive relational form over the same views (``planekit.plans.views``).
Column names and types are aligned on both sides (ids and counts bigint).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planekit.functions.geom import euclidean, normalize_rect, sq_dist
from planekit.operators.join import (
    collect_matches,
    join_points_rects,
    match_counts,
    matches_text,
    spatial_count,
    spatial_join,
    spatial_join_mixed,
    spatial_join_shapes,
)
from planekit.operators.hull import convex_hull, farthest_pairs
from planekit.operators.pairs import closest_pairs, coincident_points, distinct_points
from planekit.operators.range import range_query
from planekit.operators.union import rect_union_vertices
from planekit.plans.views import cte, table, view
from planekit.session import shared_dir
from planekit.sources.layout import write_points
from planekit.sources.sinks import match_lines, pairs_as_points, row_text
from planekit.sources.text import parse_probes, parse_shapes, read_matches, read_points, read_rects, take_window

# the range-query window, corners deliberately given in reversed order
RANGE_WINDOW = (20_000_000, 20_000_000, 5_000_000, 5_000_000)
# a hundredth of the square that iso covers
ISO_WINDOW = (400_000, 300_000, 500_000, 400_000)


def q_range_query(spark: SparkSession, d: str) -> DataFrame:
    return range_query(view(spark, d, "pts"), RANGE_WINDOW).select("id")


def q_range_query_raw(spark: SparkSession, d: str) -> DataFrame:
    # stored columns: the window reaches the Parquet scan as pushed filters
    o = table(spark, d, "orders")
    return range_query(o, (150_000.0, 100, 50_000.0, 600), x="o_totalprice", y="o_custkey") \
        .select(F.col("o_orderkey").alias("id"))


def q_normalize_rect(spark: SparkSession, d: str) -> DataFrame:
    # cbox stores its corners reversed; normalisation restores x1<=x2, y1<=y2
    return normalize_rect(view(spark, d, "cbox")).select("id", "x1", "y1", "x2", "y2")


def q_join_point_rect(spark: SparkSession, d: str) -> DataFrame:
    return spatial_join(view(spark, d, "pts"), view(spark, d, "win"), "within")


def q_join_rect_rect(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "rects")
    return spatial_join(r, r, "intersects")


def q_join_box_win(spark: SparkSession, d: str) -> DataFrame:
    return spatial_join(normalize_rect(view(spark, d, "cbox")), view(spark, d, "win"), "intersects")


def _mixed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Probe text rows of both arities, built from pts and cbox."""
    p = view(spark, d, "pts").select(F.concat_ws(",", "id", "x", "y").alias("value"))
    b = view(spark, d, "cbox").select(F.concat_ws(",", "id", "x1", "y1", "x2", "y2").alias("value"))
    return p.unionByName(b)


def q_join_mixed(spark: SparkSession, d: str) -> DataFrame:
    return spatial_join_shapes(parse_probes(_mixed_lines(spark, d), coord_type="bigint"), view(spark, d, "win"))


def q_collect_matches(spark: SparkSession, d: str) -> DataFrame:
    pairs = spatial_join(view(spark, d, "pts"), view(spark, d, "win"), "within", lists=True)
    m = collect_matches(pairs)
    return m.select("probe_id", F.array_join("matches", ",").alias("matches"))


def q_match_counts(spark: SparkSession, d: str) -> DataFrame:
    # join -> match rows as text -> parsed back -> counted (the reference's chain)
    pairs = spatial_join_shapes(parse_probes(_mixed_lines(spark, d), coord_type="bigint"), view(spark, d, "win"), lists=True)
    return match_counts(read_matches(matches_text(collect_matches(pairs))))


def q_spatial_count_point(spark: SparkSession, d: str) -> DataFrame:
    return spatial_count(view(spark, d, "pts"), view(spark, d, "win"), "within")


def q_spatial_count_rect(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "rects")
    return spatial_count(r, r, "intersects")


def q_spatial_count_left(spark: SparkSession, d: str) -> DataFrame:
    return spatial_count(view(spark, d, "pts"), view(spark, d, "win"), "within", how="left")


def q_convex_hull(spark: SparkSession, d: str) -> DataFrame:
    return convex_hull(view(spark, d, "pts"))


def q_convex_hull_by_group(spark: SparkSession, d: str) -> DataFrame:
    return convex_hull(view(spark, d, "ptsg"), group_by="grp")


def q_farthest_pairs(spark: SparkSession, d: str) -> DataFrame:
    return farthest_pairs(view(spark, d, "iso"))


def q_farthest_pairs_pts(spark: SparkSession, d: str) -> DataFrame:
    return farthest_pairs(view(spark, d, "pts"))


def q_closest_pairs(spark: SparkSession, d: str) -> DataFrame:
    return closest_pairs(view(spark, d, "iso"))


def q_closest_pairs_pts(spark: SparkSession, d: str) -> DataFrame:
    return closest_pairs(view(spark, d, "pts"))


def q_distinct_points(spark: SparkSession, d: str) -> DataFrame:
    # the corners of all part rectangles, as a set
    r = view(spark, d, "rects")
    corners = r.select(F.explode(F.array(
        F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")),
        F.struct(F.col("x1").alias("x"), F.col("y2").alias("y")),
        F.struct(F.col("x2").alias("x"), F.col("y1").alias("y")),
        F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p")).select("p.x", "p.y")
    return distinct_points(corners)


def q_pair_distance(spark: SparkSession, d: str) -> DataFrame:
    # distance from each matched point to its window's lower-left corner
    p = view(spark, d, "pts").select(F.col("id").alias("probe_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    w = normalize_rect(view(spark, d, "win")).withColumnRenamed("id", "window_id")
    j = join_points_rects(p, w, "px", "py", ("x1", "y1", "x2", "y2"), closed=False)
    return j.select("probe_id", "window_id", sq_dist("px", "py", "x1", "y1").alias("d2"),
                    euclidean("px", "py", "x1", "y1").alias("dist"))


def q_rect_union_vertices(spark: SparkSession, d: str) -> DataFrame:
    return rect_union_vertices(view(spark, d, "rects"))


def q_rect_union_boundary_points(spark: SparkSession, d: str) -> DataFrame:
    return rect_union_vertices(view(spark, d, "rects"), keep_collinear=True)


def q_join_point_rect_closed(spark: SparkSession, d: str) -> DataFrame:
    return spatial_join(view(spark, d, "pts"), view(spark, d, "win"), "within_closed")


def q_collect_matches_left(spark: SparkSession, d: str) -> DataFrame:
    # every probe, matched or not: unmatched probes get an empty list
    p = view(spark, d, "pts")
    m = collect_matches(spatial_join(p, view(spark, d, "win"), "within"), probes=p)
    return m.select("probe_id", F.array_join("matches", ",").alias("matches"))


def q_range_query_text(spark: SparkSession, d: str) -> DataFrame:
    # points rendered as "id,x,y" text rows, read back by position, then queried
    lines = view(spark, d, "pts").select(F.concat_ws(",", "id", "x", "y").alias("value"))
    pts = read_points(lines, with_id=True, id_type="bigint")
    return range_query(pts, RANGE_WINDOW).select("id")


def q_convex_hull_iso(spark: SparkSession, d: str) -> DataFrame:
    return convex_hull(view(spark, d, "iso"))


def _text(df: DataFrame, *fields) -> DataFrame:
    return df.select(F.concat_ws(",", *[F.col(f).cast("string") for f in fields]).alias("value"))


def q_join_mixed_split(spark: SparkSession, d: str) -> DataFrame:
    # the two kinds as two frames, each joined by its own operator
    pts, rects = parse_shapes(_mixed_lines(spark, d), coord_type="bigint")
    return spatial_join_mixed(pts, rects, view(spark, d, "win"))


def q_read_points_text(spark: SparkSession, d: str) -> DataFrame:
    # "x,y" rows with a field too many, read by position
    return read_points(_text(view(spark, d, "iso"), "x", "y", "id"))


def q_read_rects_text(spark: SparkSession, d: str) -> DataFrame:
    return read_rects(_text(view(spark, d, "cbox"), "x1", "y1", "x2", "y2"))


def q_read_rects_id_text(spark: SparkSession, d: str) -> DataFrame:
    return read_rects(_text(view(spark, d, "cbox"), "id", "x1", "y1", "x2", "y2"), with_id=True)


def q_range_query_window_text(spark: SparkSession, d: str) -> DataFrame:
    # the window is the first row of a file of rectangles: here the smallest id's
    rows = view(spark, d, "cbox").orderBy("id")
    return range_query(view(spark, d, "pts"), take_window(_text(rows, "x1", "y1", "x2", "y2"))).select("id")


def q_pairs_as_points(spark: SparkSession, d: str) -> DataFrame:
    # the two-line form of the farthest pairs, as row text; pair_no is an arbitrary number
    return row_text(pairs_as_points(farthest_pairs(view(spark, d, "iso"))).select("end", "x", "y"))


def q_row_text_nulls(spark: SparkSession, d: str) -> DataFrame:
    # null fields stay empty fields
    return row_text(view(spark, d, "far").select("id", "grp", F.lit(3).alias("three")))


def q_coincident_points(spark: SparkSession, d: str) -> DataFrame:
    return coincident_points(view(spark, d, "lattice"), id_col="id")


def q_closest_pairs_ties(spark: SparkSession, d: str) -> DataFrame:
    return closest_pairs(view(spark, d, "lattice"))


def q_farthest_pairs_ties(spark: SparkSession, d: str) -> DataFrame:
    return farthest_pairs(view(spark, d, "lattice"))


def q_convex_hull_far(spark: SparkSession, d: str) -> DataFrame:
    return convex_hull(view(spark, d, "far"))


def q_closest_pairs_far(spark: SparkSession, d: str) -> DataFrame:
    return closest_pairs(view(spark, d, "far"))


def q_convex_hull_nullkey(spark: SparkSession, d: str) -> DataFrame:
    # shown as text: a nullable bigint would pass through a float on its way to pandas
    return convex_hull(view(spark, d, "far"), group_by="grp").withColumn("grp", F.col("grp").cast("string"))


def q_join_mixed_scale(spark: SparkSession, d: str) -> DataFrame:
    return spatial_join(view(spark, d, "iso"), view(spark, d, "mixwin"), "within")


def q_join_mixed_scale_rects(spark: SparkSession, d: str) -> DataFrame:
    w = view(spark, d, "mixwin")
    return spatial_count(w, w, "intersects")


def q_range_query_layout(spark: SparkSession, d: str) -> DataFrame:
    # the points stored along a Hilbert curve, then queried from there
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    write_points(view(spark, d, "iso"), path, files=16)
    return range_query(spark.read.parquet(path), ISO_WINDOW).select("id")


def q_match_lines(spark: SparkSession, d: str) -> DataFrame:
    # row text of match lists put together from their pieces, probes without a match too
    p = view(spark, d, "pts")
    return match_lines(spatial_join(p, view(spark, d, "win"), "within"), probes=p)


def q_spatial_count_mixed_left(spark: SparkSession, d: str) -> DataFrame:
    # points counted in windows of very different sizes, without listing pairs
    return spatial_count(view(spark, d, "iso"), view(spark, d, "mixwin"), "within", how="left")


def q_rect_union_mixed(spark: SparkSession, d: str) -> DataFrame:
    # deep overlap: a few windows cover most of the others
    return rect_union_vertices(view(spark, d, "mixwin"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "range_query": q_range_query,
    "range_query_raw": q_range_query_raw,
    "normalize_rect": q_normalize_rect,
    "join_point_rect": q_join_point_rect,
    "join_rect_rect": q_join_rect_rect,
    "join_box_win": q_join_box_win,
    "join_mixed": q_join_mixed,
    "collect_matches": q_collect_matches,
    "match_counts": q_match_counts,
    "spatial_count_point": q_spatial_count_point,
    "spatial_count_rect": q_spatial_count_rect,
    "spatial_count_left": q_spatial_count_left,
    "convex_hull": q_convex_hull,
    "convex_hull_by_group": q_convex_hull_by_group,
    "farthest_pairs": q_farthest_pairs,
    "farthest_pairs_pts": q_farthest_pairs_pts,
    "closest_pairs": q_closest_pairs,
    "closest_pairs_pts": q_closest_pairs_pts,
    "distinct_points": q_distinct_points,
    "pair_distance": q_pair_distance,
    "rect_union_vertices": q_rect_union_vertices,
    "rect_union_boundary_points": q_rect_union_boundary_points,
    "join_point_rect_closed": q_join_point_rect_closed,
    "collect_matches_left": q_collect_matches_left,
    "range_query_text": q_range_query_text,
    "convex_hull_iso": q_convex_hull_iso,
    "join_mixed_split": q_join_mixed_split,
    "read_points_text": q_read_points_text,
    "read_rects_text": q_read_rects_text,
    "read_rects_id_text": q_read_rects_id_text,
    "range_query_window_text": q_range_query_window_text,
    "pairs_as_points": q_pairs_as_points,
    "row_text_nulls": q_row_text_nulls,
    "coincident_points": q_coincident_points,
    "closest_pairs_ties": q_closest_pairs_ties,
    "farthest_pairs_ties": q_farthest_pairs_ties,
    "convex_hull_far": q_convex_hull_far,
    "closest_pairs_far": q_closest_pairs_far,
    "convex_hull_nullkey": q_convex_hull_nullkey,
    "join_mixed_scale": q_join_mixed_scale,
    "join_mixed_scale_rects": q_join_mixed_scale_rects,
    "range_query_layout": q_range_query_layout,
    "match_lines": q_match_lines,
    "spatial_count_mixed_left": q_spatial_count_mixed_left,
    "rect_union_mixed": q_rect_union_mixed,
}

_W = RANGE_WINDOW
_PT_IN_WIN = "p.x > w.x1 AND p.x < w.x2 AND p.y > w.y1 AND p.y < w.y2"
_NBOX = ("SELECT id, least(x1, x2) AS x1, least(y1, y2) AS y1, "
         "greatest(x1, x2) AS x2, greatest(y1, y2) AS y2 FROM cbox")
_RR = "a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2"
_MIXED_PAIRS = (
    f"SELECT p.id AS probe_id, w.id AS window_id FROM pts p JOIN win w ON {_PT_IN_WIN} "
    f"UNION ALL SELECT a.id AS probe_id, b.id AS window_id FROM ({_NBOX}) a JOIN win b ON {_RR}"
)

ORACLE: dict[str, str] = {
    "range_query": cte("pts") + (
        f"SELECT id FROM pts WHERE x BETWEEN {min(_W[0], _W[2])} AND {max(_W[0], _W[2])} "
        f"AND y BETWEEN {min(_W[1], _W[3])} AND {max(_W[1], _W[3])}"),
    "range_query_raw": (
        "SELECT o_orderkey AS id FROM orders WHERE o_totalprice BETWEEN 50000.0 AND 150000.0 "
        "AND o_custkey BETWEEN 100 AND 600"),
    "normalize_rect": cte("cbox") + _NBOX,
    "join_point_rect": cte("pts", "win") + (
        f"SELECT p.id AS probe_id, w.id AS window_id FROM pts p JOIN win w ON {_PT_IN_WIN}"),
    "join_rect_rect": cte("rects") + (
        f"SELECT a.id AS probe_id, b.id AS window_id FROM rects a JOIN rects b ON {_RR}"),
    "join_box_win": cte("cbox", "win") + (
        f"SELECT a.id AS probe_id, b.id AS window_id FROM ({_NBOX}) a JOIN win b ON {_RR}"),
    "join_mixed": cte("pts", "cbox", "win") + _MIXED_PAIRS,
    "collect_matches": cte("pts", "win") + (
        "SELECT probe_id, array_to_string(list_sort(list_distinct(list(window_id))), ',') AS matches "
        f"FROM (SELECT p.id AS probe_id, w.id AS window_id FROM pts p JOIN win w ON {_PT_IN_WIN}) "
        "GROUP BY probe_id"),
    "match_counts": cte("pts", "cbox", "win") + (
        "SELECT probe_id, count(DISTINCT window_id) AS n_matches "
        f"FROM ({_MIXED_PAIRS}) GROUP BY probe_id"),
    "spatial_count_point": cte("pts", "win") + (
        "SELECT p.id AS probe_id, count(DISTINCT w.id) AS n_matches "
        f"FROM pts p JOIN win w ON {_PT_IN_WIN} GROUP BY p.id"),
    "spatial_count_rect": cte("rects") + (
        "SELECT a.id AS probe_id, count(DISTINCT b.id) AS n_matches "
        f"FROM rects a JOIN rects b ON {_RR} GROUP BY a.id"),
    "spatial_count_left": cte("pts", "win") + (
        "SELECT p.id AS probe_id, count(DISTINCT w.id) AS n_matches "
        f"FROM pts p LEFT JOIN win w ON {_PT_IN_WIN} GROUP BY p.id"),
}


def _hull_sql(src: str, key: str | None) -> str:
    """Slope form: per x the lowest and highest point; a top point is an upper
    vertex iff every slope to the right is below every slope from the left
    (mirror for the bottom).  Quadratic in distinct x per group: oracle only."""
    k = f"{key}, " if key else ""
    on = f"a.{key} = b.{key}" if key else "TRUE"
    ka = f"a.{key}, " if key else ""
    return (
        f"P AS (SELECT DISTINCT {k}x, y FROM {src}),\n"
        f"C AS (SELECT {k}x, min(y) AS lo, max(y) AS hi FROM P GROUP BY {k}x),\n"
        f"U AS (SELECT {ka}a.x, a.hi AS y,"
        " max(CASE WHEN b.x > a.x THEN (b.hi - a.hi) / (b.x - a.x) END) AS rs,"
        " min(CASE WHEN b.x < a.x THEN (a.hi - b.hi) / (a.x - b.x) END) AS ls"
        f" FROM C a JOIN C b ON {on} GROUP BY {ka}a.x, a.hi),\n"
        f"L AS (SELECT {ka}a.x, a.lo AS y,"
        " min(CASE WHEN b.x > a.x THEN (b.lo - a.lo) / (b.x - a.x) END) AS rs,"
        " max(CASE WHEN b.x < a.x THEN (a.lo - b.lo) / (a.x - b.x) END) AS ls"
        f" FROM C a JOIN C b ON {on} GROUP BY {ka}a.x, a.lo)\n"
        f"SELECT {k}x, y FROM U WHERE rs IS NULL OR ls IS NULL OR rs < ls\n"
        f"UNION SELECT {k}x, y FROM L WHERE rs IS NULL OR ls IS NULL OR rs > ls"
    )


def _pairs_sql(src: str, agg: str) -> str:
    """Brute force over all pairs of distinct points, ties kept."""
    return (
        f"P AS (SELECT DISTINCT x, y FROM {src}),\n"
        "D AS (SELECT a.x AS ax, a.y AS ay, b.x AS bx, b.y AS \"by\","
        " (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2"
        " FROM P a JOIN P b ON a.x < b.x OR (a.x = b.x AND a.y < b.y))\n"
        f"SELECT ax, ay, bx, \"by\", d2, sqrt(d2) AS dist FROM D WHERE d2 = (SELECT {agg}(d2) FROM D)"
    )


def _union_sql(collinear: bool, src: str = "rects") -> str:
    keep = "mask IN (1, 2, 4, 8, 7, 11, 13, 14, 5, 10)"
    if collinear:
        keep += " OR (mask IN (3, 6, 12, 9) AND corner = 1)"
    return (
        "R AS (SELECT least(x1, x2) AS x1, least(y1, y2) AS y1, greatest(x1, x2) AS x2,"
        f" greatest(y1, y2) AS y2 FROM {src} WHERE x1 <> x2 AND y1 <> y2),\n"
        "V AS (SELECT x1 AS x, y1, y2 FROM R UNION ALL SELECT x2, y1, y2 FROM R),\n"
        "H AS (SELECT y1 AS y, x1, x2 FROM R UNION ALL SELECT y2, x1, x2 FROM R),\n"
        "C AS (SELECT x1 AS x, y1 AS y, 1 AS corner FROM R UNION ALL SELECT x1, y2, 1 FROM R"
        " UNION ALL SELECT x2, y1, 1 FROM R UNION ALL SELECT x2, y2, 1 FROM R"
        " UNION ALL SELECT v.x, h.y, 0 FROM V v JOIN H h"
        " ON h.x1 <= v.x AND v.x <= h.x2 AND v.y1 <= h.y AND h.y <= v.y2),\n"
        "D AS (SELECT x, y, max(corner) AS corner FROM C GROUP BY x, y),\n"
        "M AS (SELECT d.x, d.y, d.corner, bit_or("
        "(CASE WHEN r.x1 <= d.x AND d.x < r.x2 AND r.y1 <= d.y AND d.y < r.y2 THEN 1 ELSE 0 END)"
        " | (CASE WHEN r.x1 < d.x AND d.x <= r.x2 AND r.y1 <= d.y AND d.y < r.y2 THEN 2 ELSE 0 END)"
        " | (CASE WHEN r.x1 < d.x AND d.x <= r.x2 AND r.y1 < d.y AND d.y <= r.y2 THEN 4 ELSE 0 END)"
        " | (CASE WHEN r.x1 <= d.x AND d.x < r.x2 AND r.y1 < d.y AND d.y <= r.y2 THEN 8 ELSE 0 END)"
        ") AS mask FROM D d JOIN R r"
        " ON r.x1 <= d.x AND d.x <= r.x2 AND r.y1 <= d.y AND d.y <= r.y2 GROUP BY d.x, d.y, d.corner)\n"
        f"SELECT x, y FROM M WHERE {keep}"
    )


ORACLE.update({
    "convex_hull": cte("pts") + ", " + _hull_sql("pts", None),
    "convex_hull_by_group": cte("ptsg") + ", " + _hull_sql("ptsg", "grp"),
    "farthest_pairs": cte("iso") + ", " + _pairs_sql("iso", "max"),
    "farthest_pairs_pts": cte("pts") + ", " + _pairs_sql("pts", "max"),
    "closest_pairs": cte("iso") + ", " + _pairs_sql("iso", "min"),
    "closest_pairs_pts": cte("pts") + ", " + _pairs_sql("pts", "min"),
    "distinct_points": cte("rects") + (
        "SELECT DISTINCT x, y FROM (SELECT x1 AS x, y1 AS y FROM rects UNION ALL SELECT x1, y2 FROM rects"
        " UNION ALL SELECT x2, y1 FROM rects UNION ALL SELECT x2, y2 FROM rects)"),
    "pair_distance": cte("pts", "win") + (
        "SELECT p.id AS probe_id, w.id AS window_id,"
        " (p.x - w.x1) * (p.x - w.x1) + (p.y - w.y1) * (p.y - w.y1) AS d2,"
        " sqrt((p.x - w.x1) * (p.x - w.x1) + (p.y - w.y1) * (p.y - w.y1)) AS dist"
        f" FROM pts p JOIN win w ON {_PT_IN_WIN}"),
    "rect_union_vertices": cte("rects") + ", " + _union_sql(False),
    "rect_union_boundary_points": cte("rects") + ", " + _union_sql(True),
})

_PT_IN_WIN_CLOSED = "p.x >= w.x1 AND p.x <= w.x2 AND p.y >= w.y1 AND p.y <= w.y2"

ORACLE.update({
    "join_point_rect_closed": cte("pts", "win") + (
        f"SELECT p.id AS probe_id, w.id AS window_id FROM pts p JOIN win w ON {_PT_IN_WIN_CLOSED}"),
    "collect_matches_left": cte("pts", "win") + (
        "SELECT p.id AS probe_id,"
        " coalesce(array_to_string(list_sort(list_distinct(list(w.id))), ','), '') AS matches"
        f" FROM pts p LEFT JOIN win w ON {_PT_IN_WIN} GROUP BY p.id"),
    "range_query_text": ORACLE["range_query"],
    "convex_hull_iso": cte("iso") + ", " + _hull_sql("iso", None),
})

# far views: the hull and distances are taken of the offsets, which doubles hold exactly
_NEAR = ("near AS (SELECT grp, x - 1700000000000000000 AS x, y + 1700000000000000000 AS y FROM far)")
_BACK = "x + 1700000000000000000 AS x, y - 1700000000000000000 AS y"
_BOX = ("least(x1, x2)::DOUBLE AS x1, least(y1, y2)::DOUBLE AS y1, "
        "greatest(x1, x2)::DOUBLE AS x2, greatest(y1, y2)::DOUBLE AS y2")

ORACLE.update({
    "join_mixed_split": ORACLE["join_mixed"],
    "read_points_text": cte("iso") + "SELECT x::DOUBLE AS x, y::DOUBLE AS y FROM iso",
    "read_rects_text": cte("cbox") + f"SELECT {_BOX} FROM cbox",
    "read_rects_id_text": cte("cbox") + f"SELECT id, {_BOX} FROM cbox",
    "range_query_window_text": cte("pts", "cbox") + (
        "SELECT p.id FROM pts p, (SELECT * FROM cbox ORDER BY id LIMIT 1) w"
        " WHERE p.x BETWEEN least(w.x1, w.x2) AND greatest(w.x1, w.x2)"
        " AND p.y BETWEEN least(w.y1, w.y2) AND greatest(w.y1, w.y2)"),
    "pairs_as_points": cte("iso") + ", F AS (WITH " + _pairs_sql("iso", "max") + ")\n" + (
        "SELECT '0,' || ax || ',' || ay AS value FROM F UNION ALL SELECT '1,' || bx || ',' || \"by\" FROM F"),
    "row_text_nulls": cte("far") + "SELECT id || ',' || coalesce(grp::VARCHAR, '') || ',3' AS value FROM far",
    "coincident_points": cte("lattice") + (
        "SELECT x, y, n, id FROM (SELECT x, y, id, count(*) OVER (PARTITION BY x, y) AS n FROM lattice) WHERE n > 1"),
    "closest_pairs_ties": cte("lattice") + ", " + _pairs_sql("lattice", "min"),
    "farthest_pairs_ties": cte("lattice") + ", " + _pairs_sql("lattice", "max"),
    "convex_hull_far": cte("far") + f", {_NEAR}, H AS (WITH " + _hull_sql("near", None) + f") SELECT {_BACK} FROM H",
    "closest_pairs_far": cte("far") + f", {_NEAR}, H AS (WITH " + _pairs_sql("near", "min") + (
        ") SELECT ax + 1700000000000000000 AS ax, ay - 1700000000000000000 AS ay, bx + 1700000000000000000 AS bx,"
        " \"by\" - 1700000000000000000 AS \"by\", d2, dist FROM H"),
    # null is a group of its own: joined as a value that no key has
    "convex_hull_nullkey": cte("far") + (
        f", {_NEAR}, keyed AS (SELECT coalesce(grp, -1) AS grp, x, y FROM near), H AS (WITH "
        + _hull_sql("keyed", "grp") + f") SELECT nullif(grp, -1)::VARCHAR AS grp, {_BACK} FROM H"),
    "join_mixed_scale": cte("iso", "mixwin") + (
        f"SELECT p.id AS probe_id, w.id AS window_id FROM iso p JOIN mixwin w ON {_PT_IN_WIN}"),
    "join_mixed_scale_rects": cte("mixwin") + (
        "SELECT a.id AS probe_id, count(DISTINCT b.id) AS n_matches "
        f"FROM mixwin a JOIN mixwin b ON {_RR} GROUP BY a.id"),
    "range_query_layout": cte("iso") + (
        f"SELECT id FROM iso WHERE x BETWEEN {ISO_WINDOW[0]} AND {ISO_WINDOW[2]} AND y BETWEEN {ISO_WINDOW[1]} AND {ISO_WINDOW[3]}"),
    "match_lines": cte("pts", "win") + (
        "SELECT p.id AS probe_id, p.id || CASE WHEN count(w.id) > 0 THEN ',' || array_to_string(list_sort(list_distinct(list(w.id) FILTER (w.id IS NOT NULL))), ',') ELSE '' END AS value"
        f" FROM pts p LEFT JOIN win w ON {_PT_IN_WIN} GROUP BY p.id"),
    "spatial_count_mixed_left": cte("iso", "mixwin") + (
        "SELECT p.id AS probe_id, count(DISTINCT w.id) AS n_matches "
        f"FROM iso p LEFT JOIN mixwin w ON {_PT_IN_WIN} GROUP BY p.id"),
    "rect_union_mixed": cte("mixwin") + ", " + _union_sql(False, "mixwin"),
})
