"""Scalar column expressions for planar geometry (all JVM-side, codegen'd).

Points are two numeric columns, rectangles four.  Nothing here leaves the
JVM: every function returns a ``Column`` built from ``pyspark.sql.functions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_rect(df: DataFrame, x1="x1", y1="y1", x2="x2", y2="y2") -> DataFrame:
    """Order the corners so that x1 <= x2 and y1 <= y2 (corners come in any order)."""
    cx1, cy1, cx2, cy2 = _c(x1), _c(y1), _c(x2), _c(y2)
    return df.withColumns({
        "x1": F.least(cx1, cx2), "y1": F.least(cy1, cy2),
        "x2": F.greatest(cx1, cx2), "y2": F.greatest(cy1, cy2),
    })


def point_in_rect(px, py, x1, y1, x2, y2, closed: bool = True) -> Column:
    """Point containment: closed (range query) or open (point join) borders."""
    px, py, x1, y1, x2, y2 = map(_c, (px, py, x1, y1, x2, y2))
    if closed:
        return (px >= x1) & (px <= x2) & (py >= y1) & (py <= y2)
    return (px > x1) & (px < x2) & (py > y1) & (py < y2)


def rects_intersect(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """Closed rectangle intersection: a shared edge or corner counts."""
    ax1, ay1, ax2, ay2, bx1, by1, bx2, by2 = map(_c, (ax1, ay1, ax2, ay2, bx1, by1, bx2, by2))
    return (ax1 <= bx2) & (bx1 <= ax2) & (ay1 <= by2) & (by1 <= ay2)


def sq_dist(ax, ay, bx, by) -> Column:
    """Squared Euclidean distance; exact for integer coordinates."""
    ax, ay, bx, by = map(_c, (ax, ay, bx, by))
    dx, dy = ax - bx, ay - by
    return dx * dx + dy * dy


def euclidean(ax, ay, bx, by) -> Column:
    """Euclidean distance (root taken once, on the squared distance)."""
    return F.sqrt(sq_dist(ax, ay, bx, by))


def cross(ox, oy, ax, ay, bx, by) -> Column:
    """z of (a - o) x (b - o): > 0 for a counter-clockwise turn o -> a -> b."""
    ox, oy, ax, ay, bx, by = map(_c, (ox, oy, ax, ay, bx, by))
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def point_lt(ax, ay, bx, by) -> Column:
    """Lexicographic (x, then y) order of two points: the canonical pair order."""
    ax, ay, bx, by = map(_c, (ax, ay, bx, by))
    return (ax < bx) | ((ax == bx) & (ay < by))


def valid_coords(df: DataFrame, *cols: str) -> Column:
    """Row filter: every coordinate present and not NaN (our null/NaN policy).

    NaN is only tested on floating columns, so integer coordinates keep a
    plain ``IS NOT NULL`` that Parquet can push down.  Infinite coordinates
    are kept here: a window may have infinite borders, while points at
    infinity are dropped where a distance or a hull is asked for
    (``finite_coords``).
    """
    types = dict(df.dtypes)
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        if types.get(c) in ("double", "float"):
            term = term & ~F.isnan(F.col(c))
        cond = term if cond is None else cond & term
    return cond if cond is not None else F.lit(True)


def finite_coords(df: DataFrame, *cols: str) -> Column:
    """``valid_coords`` and no infinity: points that have distances."""
    types = dict(df.dtypes)
    cond = valid_coords(df, *cols)
    for c in cols:
        if types.get(c) in ("double", "float"):
            cond = cond & (F.abs(F.col(c)) < float("inf"))
    return cond


def widened(c, dtype: str) -> Column:
    """A coordinate in the widest type of its kind: integers as bigint, floats as double."""
    if dtype in ("tinyint", "smallint", "int"):
        return _c(c).cast("bigint")
    return _c(c).cast("double") if dtype == "float" else _c(c)
