from planekit.functions.geom import (  # noqa: F401
    cross,
    euclidean,
    normalize_rect,
    point_in_rect,
    point_lt,
    rects_intersect,
    sq_dist,
    valid_coords,
)
