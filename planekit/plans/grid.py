"""Multi-level uniform grid: turns spatial theta joins into equi-joins.

A rectangle of extent ``e`` (its longer side) has the exponent
``ceil(log2(e))``; the levels of a join are a set of such exponents, and a
rectangle lives on the smallest level not below its own exponent, where cells
have side ``2**level``.  So on its own level and on every coarser one it
covers at most 2 x 2 cells: a rectangle is replicated into a bounded number of
cells however large it is, and no broadcast of a side of unknown size is ever
needed.  The join is a hash (or sort-merge) equi-join on ``(level, cx, cy)``
followed by the exact residual predicate.

Levels follow the rectangles' own sizes, small ones too: a level is kept if
at least one in ``RARE`` rectangles live there; rarer sizes move up to the next
level that is kept (the largest always is).  So cells fit their rectangles
whatever else the table holds, and points are replicated to few levels.

Exactness rests on monotone floating division: for a fixed positive cell
side ``cs``, ``a <= b`` implies ``floor(a / cs) <= floor(b / cs)``, so a point
inside a rectangle falls in one of the rectangle's cells when both use the
same expression for ``cs``.  The grid changes cost, never results.

Where points meet rectangles, a level whose cells are few (``ACROSS``) has them
halved: its rectangles then cover more than 2 x 2 cells, but points and rectangles
are spread over more keys, and a cell holds fewer that do not meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a size that fewer than one in RARE rectangles have gets no level of its own
RARE = 100
#: a level is cut finer until its cells number so many along an axis, by up to ``FINEST`` halvings,
#: as long as its rectangles make at most ``MOST`` copies for each rectangle of their side
ACROSS, FINEST, MOST = 64, 4, 32
#: exponents of doubles: the largest cell holds every finite coordinate
LOWEST, HIGHEST = -1074, 1024
_LARGEST = 1.7976931348623157e308


def cell_side(level) -> Column:
    """Side of a cell on ``level`` (a column or an int); exact power-of-two scaling."""
    lv = level if isinstance(level, Column) else F.lit(int(level))
    return F.pow(F.lit(2.0), lv.cast("double"))


def _finite(v: Column) -> Column:
    return F.greatest(F.least(v.cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST))


def fine_side(level: Column, finer: dict[int, int]) -> Column:
    """Side of the cells of a level that ``finer`` halves so many times."""
    by = F.lit(0)
    for lv, k in finer.items():
        by = F.when(level == lv, F.lit(k)).otherwise(by)
    return cell_side(level - by)


def cell_of(v, side: Column) -> Column:
    """Cell index of coordinate ``v`` for cells of ``side`` (floor, not truncation).

    Infinite borders count as the largest double; a quotient beyond bigint
    saturates, which keeps the order.
    """
    v = F.col(v) if isinstance(v, str) else v
    return F.floor(_finite(v) / side)


def rect_extent(x1, y1, x2, y2) -> Column:
    """The longer side, in double (integer spans cannot overflow)."""
    c = [(F.col(a) if isinstance(a, str) else a).cast("double") for a in (x1, y1, x2, y2)]
    return F.greatest(c[2] - c[0], c[3] - c[1])


def extent_exponent(extent: Column) -> Column:
    """``ceil(log2(extent))`` for positive extents, else null.

    The level set (an aggregate) and every row's level are computed from this
    one expression, so they agree bit for bit (Spark's log2 is StrictMath-based,
    identical on every executor).
    """
    return F.ceil(F.log2(F.when(extent > 0, F.least(extent, F.lit(_LARGEST))))).cast("int")


def level_of(extent: Column, levels: list[int]) -> Column:
    """The smallest of ``levels`` (ascending) not below the extent's exponent."""
    own = F.coalesce(extent_exponent(extent), F.lit(LOWEST))
    out = F.lit(levels[-1])
    for lv in reversed(levels[:-1]):
        out = F.when(own <= lv, F.lit(lv)).otherwise(out)
    return out


class SideStats:
    """What the grid needs to know about one rectangle side.

    ``counts``: how many rectangles have each exponent (None: no extent), a
    histogram bounded by the double exponent range (in practice a handful of
    rows); ``n``, ``lo`` and ``hi``: number of rows and bounds of all coordinates;
    ``box``: bounds ``x1, y1, x2, y2``.  Only the four coordinate columns are read.  ``SideStats.many`` gathers the
    statistics of several sides in ONE job.
    """

    def __init__(self, df: DataFrame | None = None, cols=("x1", "y1", "x2", "y2"), rows=None):
        if rows is None:
            rows = SideStats._rows([(df, cols)])[0]
        self.counts = {r["_exp"]: int(r["n"]) for r in rows}
        self.n = sum(self.counts.values())
        self.box = [f((r[c] for r in rows), default=None) for f, c in ((min, "x1"), (min, "y1"), (max, "x2"), (max, "y2"))]
        self.lo, self.hi = (min(self.box[:2]), max(self.box[2:])) if rows else (None, None)

    @staticmethod
    def _rows(sides) -> list:
        parts = []
        for i, (df, cols) in enumerate(sides):
            x1, y1, x2, y2 = cols
            parts.append(df.select(
                F.lit(i).alias("_side"), extent_exponent(rect_extent(x1, y1, x2, y2)).alias("_exp"),
                *[_finite(F.col(c)).alias(f"_{k}") for c, k in zip(cols, ("x1", "y1", "x2", "y2"))]))
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        got = u.groupBy("_side", "_exp").agg(F.count(F.lit(1)).alias("n"), F.min("_x1").alias("x1"), F.min("_y1").alias("y1"),
                                             F.max("_x2").alias("x2"), F.max("_y2").alias("y2")).collect()
        return [[r for r in got if r["_side"] == i] for i in range(len(sides))]

    @staticmethod
    def many(sides) -> list["SideStats"]:
        """Statistics of several ``(df, cols)`` sides from one aggregate job."""
        return [SideStats(rows=r) for r in SideStats._rows(sides)]

    def shares(self, *spans: float) -> float:
        """About the sum, over the rectangles, of the part of the spans that they cover."""
        size = {e: 0.75 * math.ldexp(1.0, min(e, HIGHEST - 1)) for e in self.counts if e is not None}
        return sum(self.counts[e] * math.prod(min(s / span, 1.0) for span in spans) for e, s in size.items())

    def levels(self, cell: float | None = None) -> list[int]:
        """Ascending levels for this side; ``cell`` sets the finest cell side instead."""
        sizes = sorted(e for e in self.counts if e is not None)
        if not sizes:
            # no extent anywhere: the density of the rectangles sets one level
            span = (self.hi - self.lo) / max(1.0, self.n ** 0.5) if self.n and self.hi > self.lo else 1.0
            kept = [max(LOWEST, min(HIGHEST, math.ceil(math.log2(min(span, _LARGEST) or 1.0))))]
        else:
            kept, waiting = [], 0
            for e in sizes:
                waiting += self.counts[e]
                if waiting * RARE >= self.n or e == sizes[-1]:
                    kept.append(e)
                    waiting = 0
        if cell:
            finest = math.ceil(math.log2(cell))
            kept = sorted({max(e, finest) for e in kept})
        return kept

    def finer(self, levels: list[int]) -> dict[int, int]:
        """How often the cells of each level are halved, so that few large rectangles do not share few cells."""
        at = dict.fromkeys(levels, 0)
        for e, n in self.counts.items():
            at[levels[0] if e is None else next((lv for lv in levels if e <= lv), levels[-1])] += n
        out = {}
        for lv, n in at.items():
            k = 0
            while (k < FINEST and lv - k > LOWEST + 1 and 0 < n * (2 ** (k + 1) + 1) ** 2 <= MOST * self.n
                   and self.hi / 2 - self.lo / 2 < math.ldexp(ACROSS / 2, min(lv - k, HIGHEST - 7))):
                k += 1
            out[lv] = k
        return out

    def fine_cells(self, finer: dict[int, int]) -> int:
        """At most how many cells a rectangle covers."""
        return (2 ** max(finer.values(), default=0) + 2) ** 2


def copies(stats: SideStats, own: list[int], other: list[int]) -> int:
    """How many (rectangle, level) rows a side makes: its own level and the other side's higher ones."""
    total = 0
    for e, n in stats.counts.items():
        level = own[0] if e is None else next((lv for lv in own if e <= lv), own[-1])
        total += n * (1 + sum(lv > level for lv in other))
    return total


def open_ended(levels: list[int]) -> list[int]:
    """``levels`` and ever coarser ones, for rectangles whose sizes are not known (a stream)."""
    out, step = list(levels), 3
    while out[-1] < HIGHEST:
        out.append(min(HIGHEST, out[-1] + step))
        step *= 2
    return out


def point_cells(df: DataFrame, levels: list[int], x, y, prefix: str = "_", finer: dict[int, int] | None = None) -> DataFrame:
    """One row per level in ``levels``: the cell holding the point on that level (halved as ``finer`` says)."""
    lv, cx, cy = f"{prefix}L", f"{prefix}cx", f"{prefix}cy"
    out = df.withColumn(lv, F.explode(F.array(*[F.lit(int(v)) for v in levels])))
    side = fine_side(F.col(lv), finer or {})
    return out.withColumn(cx, cell_of(x, side)).withColumn(cy, cell_of(y, side))
