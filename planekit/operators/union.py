"""Boundary vertices of the union of axis-parallel rectangles.

Around a point the rectangles cover some of its four quadrants.  One or three
covered quadrants, or two diagonal ones, make it a corner of the union (of its outer
border or of a hole); two adjacent ones a point on a straight stretch, kept only
with ``keep_collinear=True`` and only where it is a corner of an input rectangle (the
vertices a polygon-union library leaves in place).

The plane is cut into tiles by a tree over a bounded sample: each cut is the median
edge, on the axis that leaves fewer edges in tiles not covered by one rectangle.  One
pass sends every rectangle, clipped, to the tiles that it touches without covering
them; tiles that a sampled rectangle covers take nothing, as no vertex lies there.
So the shuffle follows the border, not the crossings of edges: under deep overlap
almost all crossings lie in covered tiles.  Clipped rectangles that look alike within
a tile are one row, which takes care of many rectangles with a common edge or
corner.  A task cuts a tile further, down to a bounded number of edge crossings, and
finds the quadrants by a difference array over its edge lines.

The sample decides only how the plane is cut, never the result.  Coordinates of any
type are compared, never computed with, so results are exact.  Rectangles of zero
width or height add no area and are dropped first; null and NaN coordinates too.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.functions.geom import valid_coords
from planekit.operators import _tiles_local
from planekit.operators._tiles_local import COLS, TileTree, tile_vertices, whole

cloudpickle.register_pickle_by_value(_tiles_local)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: rectangles (clipped) that a tile holds at most about
ROWS_PER_TILE = 1024
#: rectangles that the tiles are cut by, at most about; a tile gets at least ``LEAST`` of them
SAMPLE, LEAST = 100_000, 16
#: rectangles that a task takes through the tree at once, and clipped ones that it gives back at once
TAKEN, GIVEN = 200_000, 50_000


def _rects(df: DataFrame, cols) -> DataFrame:
    x1, y1, x2, y2 = cols
    d = df.where(valid_coords(df, x1, y1, x2, y2)).select(
        F.least(x1, x2).alias("x1"), F.least(y1, y2).alias("y1"),
        F.greatest(x1, x2).alias("x2"), F.greatest(y1, y2).alias("y2"))
    return d.where((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")))


def _gathered(parts: Iterable[list[np.ndarray]], rows: int = TAKEN) -> Iterator[list[np.ndarray]]:
    """The arrays of several parts joined to at least ``rows`` rows each time (fewer at the end)."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= rows:
            yield [np.concatenate(c) for c in zip(*held)]
            held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def union_tiles(R: DataFrame, rows_per_tile: int = ROWS_PER_TILE, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """``tile`` and the clipped rectangles (``COLS``) that it holds, and the number of tiles."""
    n = R.count()
    share = min(1.0, sample / n) if n else 1.0
    some = (R if share == 1.0 else R.sample(False, share, seed=7)).toPandas()
    tree = TileTree(whole(some), max(int(rows_per_tile * share), 1 if share == 1.0 else LEAST))

    def cut(batches):
        for r in _gathered(map(whole, batches)):
            dealt = ([*part, np.full(len(part[0]), leaf)] for leaf, part in tree.cut(r))
            for rows in _gathered(dealt, GIVEN):
                yield pd.DataFrame(dict(zip([*COLS, "tile"], rows)))

    types = dict(R.dtypes)
    flags = ", ".join(f"{c} boolean" for c in COLS[4:])
    schema = ", ".join(f"{c} {types[c]}" for c in COLS[:4]) + f", {flags}, tile long"
    return R.mapInPandas(cut, schema), tree.leaves


def rect_union_vertices(rects: DataFrame, x1: str = "x1", y1: str = "y1", x2: str = "x2",
                        y2: str = "y2", keep_collinear: bool = False,
                        rows_per_tile: int = ROWS_PER_TILE, sample: int = SAMPLE) -> DataFrame:
    """Distinct vertices ``x, y`` of the union's boundary (shells and holes).

    ``rows_per_tile`` and ``sample`` set how finely the plane is cut.  A table without
    rectangles gives no row.  Repeated rectangles count once.
    """
    R = _rects(rects, (x1, y1, x2, y2))
    tiles, n_tiles = union_tiles(R, rows_per_tile, sample)
    types = dict(R.dtypes)

    def vertices(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"x": x, "y": y}) for x, y in tile_vertices([pdf[c].to_numpy() for c in COLS], keep_collinear)]
        return pd.concat(found) if found else pd.DataFrame({"x": pdf["x1"][:0], "y": pdf["y1"][:0]})

    # a tile's work is far more than its bytes say: tasks by the number of tiles
    spread = tiles.repartition(max(1, min(n_tiles, 4096)), "tile")
    return spread.groupBy("tile").applyInPandas(vertices, f"x {types['x1']}, y {types['y1']}")
