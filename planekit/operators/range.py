"""Range query (closed window) over points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.functions.geom import valid_coords


def window_bounds(window) -> tuple:
    """A query window as (x1, y1, x2, y2) with corners ordered.

    ``window`` is a 4-tuple in any corner order or a DataFrame whose first
    row (file order) holds the four corner columns ``x1 y1 x2 y2`` — the one
    bounded row is taken to the driver, as a query constant.
    """
    if isinstance(window, DataFrame):
        row = window.select("x1", "y1", "x2", "y2").first()
        if row is None:
            raise ValueError("window DataFrame is empty")
        window = tuple(row)
    x1, y1, x2, y2 = window
    return min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)


def range_query(points: DataFrame, window, x: str = "x", y: str = "y") -> DataFrame:
    """Points inside the closed window; all input columns are kept.

    The predicate is plain comparisons against literals, so on stored columns
    Catalyst pushes it into the Parquet scan (row-group skipping) and the
    stage stays in whole-stage codegen.  No shuffle.
    """
    x1, y1, x2, y2 = window_bounds(window)
    return points.where(
        valid_coords(points, x, y)
        & F.col(x).between(F.lit(x1), F.lit(x2))
        & F.col(y).between(F.lit(y1), F.lit(y2))
    )
