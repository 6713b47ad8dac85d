"""planekit: planar spatial queries on Spark DataFrames.

Range queries, point/rectangle spatial joins with per-probe match lists and
counts, convex hulls, closest and farthest pairs with all ties, and the
boundary vertices of a union of rectangles — each a DataFrame-in,
DataFrame-out function that runs distributed.
"""

from planekit.functions import euclidean, normalize_rect, point_in_rect, rects_intersect, sq_dist  # noqa: E402,F401
from planekit.operators import (  # noqa: E402,F401
    canonical_pairs,
    closest_pairs,
    coincident_points,
    collect_matches,
    convex_hull,
    distinct_points,
    extremum_with_ties,
    farthest_pairs,
    match_counts,
    matches_text,
    points_outside_rects,
    range_query,
    rect_union_vertices,
    spatial_count,
    spatial_join,
    spatial_join_mixed,
    spatial_join_shapes,
)
from planekit.sources import (  # noqa: E402,F401
    hilbert_key,
    hilbert_order,
    match_chunks,
    match_lines,
    pairs_as_points,
    parse_probes,
    parse_shapes,
    read_matches,
    read_points,
    read_probes,
    read_rects,
    read_shapes,
    row_text,
    take_window,
    write_csv,
    write_matches,
    write_points,
)
