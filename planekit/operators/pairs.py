"""Closest pairs (all ties), exact, without an all-pairs join.

1. Seed an upper bound: cut the bounding box into ``k x k`` cells with
   ``k*k < n``; by pigeonhole some cell holds two points, and for every cell
   the pair (min point, max point) is a real pair.  One ``groupBy`` with
   partial aggregation: a hot cell costs nothing extra.
2. Refine: with cells of side ``delta`` (the bound), count points per cell.
   If the fullest cell holds ``c > MAX_CELL`` points, sub-cells of side
   ``delta / m`` with ``m*m < c`` again force a pair inside one of them, so
   the bound drops by ``m / sqrt(2)``; repeat.  Every step is one aggregate.
3. Join: any pair at distance <= delta lies in the same or adjacent cells of
   side delta.  Each point is replicated to its own cell and 4 of its 8
   neighbours (a half neighbourhood: every adjacent cell pair is covered in
   exactly one direction) and equi-joined on the cell; within one cell
   ``a < b`` keeps each unordered pair once.  With at most MAX_CELL points per
   cell the join is linear in n.
4. Ties: the candidate pairs (within delta) are written once to the
   checkpoint folder; their minimum squared distance (an aggregate) is
   joined back to them.

Points are a set: repeated coordinates count once (``coincident_points``
reports them, with their ids).  Integer coordinates are first moved to the
set's own origin, so bigints of any size keep every unit: integer cells are
integer quotients, integer distances exact (two points at the
closest distance may be up to 2 * 10**9 apart; beyond, bigint raises).
Doubles compare computed squared distances; points at infinity are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.functions.geom import finite_coords, point_lt, sq_dist, widened
from planekit.plans.guard import size_guard
from planekit.session import cut_lineage

MAX_CELL = 64
# cells a hair wider than delta: floating cell indices never split a pair at distance delta
_WIDEN = 1.0 + 1e-9


def distinct_points(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Distinct (x, y) in bigint or double; sort with ``orderBy(x, y)`` where an order is wanted."""
    t = dict(points.dtypes)
    return (points.where(finite_coords(points, x, y))
            .select(widened(x, t[x]).alias(x), widened(y, t[y]).alias(y)).dropDuplicates([x, y]))


def coincident_points(points: DataFrame, x: str = "x", y: str = "y", id_col: str | None = None) -> DataFrame:
    """Locations held by more than one row, with their multiplicity (distance-0 groups).

    With ``id_col`` also one row per point there (``x, y, n, id``), never all
    pairs of them: the counts are joined back, so a location of any size is
    streamed and not gathered.
    """
    held = (points.where(finite_coords(points, x, y)).groupBy(x, y)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    if id_col is None:
        return held
    return points.select(x, y, F.col(id_col).alias("id")).join(held, [x, y]).select(x, y, "n", "id")


def canonical_pairs(pairs: DataFrame) -> DataFrame:
    """Order the two ends of each pair so that (ax, ay) < (bx, by); drop self-pairs."""
    swap = point_lt("bx", "by", "ax", "ay")
    out = pairs.withColumns({
        "ax": F.when(swap, F.col("bx")).otherwise(F.col("ax")),
        "ay": F.when(swap, F.col("by")).otherwise(F.col("ay")),
        "bx": F.when(swap, F.col("ax")).otherwise(F.col("bx")),
        "by": F.when(swap, F.col("ay")).otherwise(F.col("by")),
    })
    return out.where(~((F.col("ax") == F.col("bx")) & (F.col("ay") == F.col("by"))))


def extremum_with_ties(df: DataFrame, col: str, how: str = "min") -> DataFrame:
    """Every row whose ``col`` equals the minimum (or maximum).

    The extremum is a global aggregate (partial per task, one row) joined
    back by equality under a broadcast of that single row, never a window
    over the whole input in one partition.
    """
    agg = F.min(col) if how == "min" else F.max(col)
    best = df.agg(agg.alias("_best"))
    # null-safe equality adds no inferred ``isnotnull`` filter to ``df``, so
    # both branches keep one plan and Spark reuses their shuffles
    return df.join(F.broadcast(best), F.col(col).eqNullSafe(F.col("_best"))).drop("_best")


def _cells(side: float | int, origin):
    """Cell of a point: integer quotient for integers (moved to the origin), floor for others."""
    if isinstance(side, int):
        return [F.expr(f"{c} div {side}L") for c in "xy"]
    return [F.floor((F.col(c) - o).cast("double") / F.lit(side)) for c, o in zip("xy", origin)]


def _double_d2(ax, ay, bx, by):
    """Squared distance in double, of differences taken in the coordinates' own type."""
    return sum(((F.col(p) - F.col(q)).cast("double") * (F.col(p) - F.col(q)).cast("double")
                for p, q in ((ax, bx), (ay, by))), F.lit(0.0))


def _cell_pair_bound(P: DataFrame, side: float | int, origin) -> tuple[float | None, int]:
    """(min squared distance over (min, max) pairs of shared cells, max points per cell)."""
    cx, cy = _cells(side, origin)
    cells = P.groupBy(cx.alias("cx"), cy.alias("cy")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("x", "y")).alias("a"),
        F.max(F.struct("x", "y")).alias("b"),
    )
    d2 = _double_d2("a.x", "a.y", "b.x", "b.y")
    r = cells.agg(F.min(F.when(F.col("n") > 1, d2)).alias("d2"),
                  F.max("n").alias("cmax")).first()
    return (None if r["d2"] is None else float(r["d2"])), int(r["cmax"] or 0)


def _cover(bound: float, span: float, integral: bool) -> float | int:
    """A cell side that any two points at squared distance ``bound`` or less span at most once.

    For doubles it is wider than the distance by the rounding of cell indices,
    which grows with the number of cells across ``span``.
    """
    delta = math.sqrt(bound) * _WIDEN
    return max(1, math.ceil(delta)) if integral else (delta + span * 2.0**-50) or 1.0


def closest_pairs(points: DataFrame, x: str = "x", y: str = "y",
                  max_cell: int = MAX_CELL) -> DataFrame:
    """All pairs of distinct points at minimum distance: ``ax ay bx by d2 dist``.

    ``(ax, ay) < (bx, by)``; fewer than two distinct points give no row.
    """
    # the distinct set is read by a few small aggregates and by the final
    # join: write it once to the shared checkpoint folder (spark.checkpoint.dir),
    # which cuts the lineage and survives the loss of any executor
    P = cut_lineage(distinct_points(points, x, y).select(F.col(x).alias("x"), F.col(y).alias("y")))
    return _closest(P, max_cell)


def _closest(P: DataFrame, max_cell: int) -> DataFrame:
    ctype = dict(P.dtypes)["x"]
    integral = ctype == "bigint" and dict(P.dtypes)["y"] == "bigint"
    st = P.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
               F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    n = st["n"]
    out_cols = ["ax", "ay", "bx", "by", "d2", "dist"]
    if n < 2:
        return P.select(*[F.lit(None).cast(ctype if c != "dist" else "double").alias(c)
                          for c in out_cols]).where(F.lit(False))
    origin = [F.lit(st[c]).cast(t) for c, t in (("x0", ctype), ("y0", dict(P.dtypes)["y"]))]
    if integral:  # offsets are exact; for doubles they would round, so those stay where they are
        P = P.select(*[(F.col(c) - o).alias(c) for c, o in zip("xy", origin)])
    span = float(max(st["x1"] - st["x0"], st["y1"] - st["y0"]))

    # 1. seed: k*k < n cells over the bounding box
    k = max(1, math.isqrt(n - 1))
    side = span / (k - 0.5) if k > 1 else span * 2.0 + 1.0
    best, seed_cmax = _cell_pair_bound(P, math.ceil(side) if integral else side, origin)
    if best is None:  # cells rounded up may hold one point each
        best = span * span * 2.0
    # a delta-cell (delta <= sqrt(2) * side) overlaps at most 3 x 3 seed cells,
    # so the seed's fullest cell already bounds every delta-cell: when that
    # bound is small the separate check is skipped
    crowded = 9 * seed_cmax > max_cell
    # 2. refine while some delta-cell is crowded
    while crowded:
        delta = _cover(best, span, integral)
        _, cmax = _cell_pair_bound(P, delta, origin)
        if cmax <= max_cell:
            break
        # (m + 1)^2 < cmax: the crowded cell's points meet in fewer sub-cells
        # than there are points, even if sub-cell borders are off by rounding
        m = max(2, math.isqrt(cmax - 1) - 1)
        sub, _ = _cell_pair_bound(P, -(-delta // m) if integral else delta / m, origin)
        if sub is None or sub >= best:
            break
        best = sub
    delta = _cover(best, span, integral)

    # 3. half-neighbourhood join on delta-cells: a guest copy of q goes to
    # cell(q) - o for o in {(0,0), (1,0), (-1,1), (0,1), (1,1)}; for any two
    # adjacent cells exactly one of them receives the other's copy
    cx, cy = _cells(delta, origin)
    home = P.select(F.col("x").alias("ax"), F.col("y").alias("ay"),
                    cx.alias("hcx"), cy.alias("hcy"))
    offs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
                     for i, j in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))])
    guest = (P.select(F.col("x").alias("bx"), F.col("y").alias("by"), cx.alias("cx"), cy.alias("cy"),
                      F.explode(offs).alias("o"))
             .select("bx", "by", (F.col("cx") - F.col("o.i")).alias("gcx"),
                     (F.col("cy") - F.col("o.j")).alias("gcy"),
                     ((F.col("o.i") == 0) & (F.col("o.j") == 0)).alias("same")))
    guest = size_guard(guest, 5 * n)  # n is exact: 5 copies per point
    # a prefilter in double, wide enough for its rounding; the minimum is taken exactly below
    near = _double_d2("ax", "ay", "bx", "by") <= F.lit(best * (1.0 + 1e-9))
    joined = (home.join(guest, (F.col("hcx") == F.col("gcx")) & (F.col("hcy") == F.col("gcy")))
              .where((~F.col("same") | point_lt("ax", "ay", "bx", "by")) & near))
    cand = (canonical_pairs(joined.select("ax", "ay", "bx", "by"))
            .withColumn("d2", sq_dist("ax", "ay", "bx", "by")))
    # 4. all ties at the minimum.  The candidates (pairs within delta) are
    # written once: with AQE on, Spark does not reuse the neighbourhood
    # join's shuffles across the two branches of the extremum, so without
    # this the largest shuffle of the operator would run twice
    cand = cut_lineage(cand)
    best_pairs = extremum_with_ties(cand, "d2", "min").withColumn("dist", F.sqrt("d2"))
    if integral:
        best_pairs = best_pairs.withColumns({c: F.col(c) + origin[c[1] == "y"] for c in out_cols[:4]})
    return best_pairs.select(*out_cols)
