from planekit.operators.count import count_meeting  # noqa: F401
from planekit.operators.hull import convex_hull, farthest_pairs, octagon_filter  # noqa: F401
from planekit.operators.join import (  # noqa: F401
    collect_matches,
    join_points_rects,
    join_rects_rects,
    match_counts,
    matches_text,
    points_outside_rects,
    spatial_count,
    spatial_join,
    spatial_join_mixed,
    spatial_join_shapes,
)
from planekit.operators.pairs import (  # noqa: F401
    canonical_pairs,
    closest_pairs,
    coincident_points,
    distinct_points,
    extremum_with_ties,
)
from planekit.operators.range import range_query, window_bounds  # noqa: F401
from planekit.operators.union import rect_union_vertices  # noqa: F401
