"""Spatial joins (point-in-rectangle, rectangle intersection) and their
per-probe aggregates (sorted match lists, match counts).

Physical form: multi-level grid equi-join (``planekit.plans.grid``) plus the
exact residual predicate.  Every pair is produced exactly once: a point has
one cell per level and meets a window only on the window's level; two
rectangles meet only on the coarser of their two levels and, within it, only
in the cell holding the reference corner ``(max(a.x1, b.x1), max(a.y1, b.y1))``
of their intersection.  So no ``distinct`` shuffle is needed.  Pairs of
many rows are listed by tile instead (``planekit.operators.tiles``), where every
row is shuffled about once and not once per level.  A side is
broadcast only when its size is proven small (exact row count from the
statistics job times the bounded replication, against
``spark.sql.autoBroadcastJoinThreshold``); otherwise the join is a
sort-merge join (``planekit.plans.guard``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planekit.functions.geom import point_in_rect, rects_intersect, valid_coords, widened
from planekit.operators.count import count_meeting, countable
from planekit.operators import tiles
from planekit.operators.gather import GROUP, HELD, gathered
from planekit.plans.guard import dealt_by, threshold_bytes
from planekit.plans.guard import size_guard as _size_guard
from planekit.plans.grid import (
    SideStats,
    cell_of,
    cell_side,
    copies,
    fine_side,
    level_of,
    open_ended,
    point_cells,
    rect_extent,
)

PREDICATES = ("within", "within_closed", "intersects")

# a rectangle covers at most 2 x 2 cells on its level (3 x 3 allowing for
# rounding at cell borders): the bound used to size a side before broadcasting
CELLS_PER_RECT = 9
#: probes that a task of a count takes at most about
SPREAD = 500_000


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_g")])


def _own_cells(rects: DataFrame, cols: tuple[str, str, str, str], levels: list[int],
               finer: dict[int, int] | None = None) -> DataFrame:
    """Each rectangle once per cell that it covers on its own level (halved as ``finer`` says)."""
    x1, y1, x2, y2 = cols
    side = fine_side(F.col("_glvl"), finer or {})
    return (rects.withColumn("_glvl", level_of(rect_extent(*cols), levels))
            .withColumn("_grcx", F.explode(F.sequence(cell_of(x1, side), cell_of(x2, side))))
            .withColumn("_grcy", F.explode(F.sequence(cell_of(y1, side), cell_of(y2, side)))))


def join_points_rects(points: DataFrame, rects: DataFrame, px: str, py: str,
                      rcols: tuple[str, str, str, str], closed: bool,
                      cell: float | None = None, stats: SideStats | None = None) -> DataFrame:
    """All (point row, rectangle row) pairs with the point in the rectangle.

    Column names of the two inputs must be disjoint; all are kept.  ``rects``
    must be normalised (x1 <= x2, y1 <= y2).  ``points`` may be a streaming
    DataFrame: cell size and levels come from the static rectangle side.
    """
    rx1, ry1, rx2, ry2 = rcols
    stats = stats or SideStats(rects, rcols)
    levels = stats.levels(cell)
    finer = {} if cell else stats.finer(levels)
    most = stats.n * stats.fine_cells(finer)
    Rc = _own_cells(rects, rcols, levels, finer)
    Pc = point_cells(points, levels, px, py, prefix="_gp", finer=finer)
    Pc, Rc = dealt_by(Pc, Rc, most, ["_gpL", "_gpcx", "_gpcy"], ["_glvl", "_grcx", "_grcy"], Rc)
    Rc = _size_guard(Rc, most)
    j = Pc.join(
        Rc,
        (F.col("_gpL") == F.col("_glvl"))
        & (F.col("_gpcx") == F.col("_grcx"))
        & (F.col("_gpcy") == F.col("_grcy")),
    ).where(point_in_rect(px, py, rx1, ry1, rx2, ry2, closed=closed))
    return _drop_helpers(j)


def points_outside_rects(points: DataFrame, rects: DataFrame, px: str, py: str,
                         rcols: tuple[str, str, str, str], closed: bool = False,
                         cell: float | None = None, stats: SideStats | None = None) -> DataFrame:
    """Rows of ``points`` inside no rectangle (anti-join; open borders by default).

    A point can only meet a rectangle on that rectangle's grid level, so it
    is anti-joined once per level present among the rectangles (a handful):
    it survives only if no level finds a containing rectangle.  An anti-join
    emits no pairs, so cost does not grow with how many rectangles cover a
    point.
    """
    rx1, ry1, rx2, ry2 = rcols
    stats = stats or SideStats(rects, rcols)
    levels = stats.levels(cell)
    Rc = _own_cells(rects, rcols, levels)
    out = points
    for lv in levels:
        pside = cell_side(lv)
        pc = out.withColumn("_gpcx", cell_of(px, pside)).withColumn("_gpcy", cell_of(py, pside))
        rl = _size_guard(Rc.where(F.col("_glvl") == lv), stats.n * CELLS_PER_RECT)
        out = pc.join(
            rl,
            (F.col("_gpcx") == F.col("_grcx")) & (F.col("_gpcy") == F.col("_grcy"))
            & point_in_rect(px, py, rx1, ry1, rx2, ry2, closed=closed),
            "left_anti",
        ).drop("_gpcx", "_gpcy")
    return out


def _rect_cells_multi(df: DataFrame, own: str, other_levels: list[int],
                      cols: tuple[str, str, str, str], tag: str) -> DataFrame:
    """Cells of each rectangle on its own level and on each higher level of the other side."""
    x1, y1, x2, y2 = cols
    lv = f"_g{tag}L"
    higher = F.filter(F.array(*[F.lit(int(v)) for v in other_levels]), lambda v: v > F.col(own))
    out = df.withColumn(lv, F.explode(F.array_union(F.array(F.col(own)), higher)))
    side = cell_side(F.col(lv))
    out = out.withColumn(f"_g{tag}cx", F.explode(F.sequence(cell_of(x1, side), cell_of(x2, side))))
    return out.withColumn(f"_g{tag}cy", F.explode(F.sequence(cell_of(y1, side), cell_of(y2, side))))


def _dealt(Ac: DataFrame, Bc: DataFrame, rows_b: int, rows_a: int | None) -> tuple[DataFrame, DataFrame]:
    guarded, rows = (Ac, rows_a) if rows_a is not None and rows_a < rows_b else (Bc, rows_b)
    return dealt_by(Ac, Bc, rows, ["_gaL", "_gacx", "_gacy"], ["_gbL", "_gbcx", "_gbcy"], guarded)


def join_rects_rects(a: DataFrame, b: DataFrame, acols: tuple[str, str, str, str],
                     bcols: tuple[str, str, str, str], cell: float | None = None,
                     stats: tuple[SideStats, SideStats] | None = None, meets=None) -> DataFrame:
    """All (a row, b row) pairs of intersecting rectangles (closed borders), once each.

    ``a`` may be a streaming DataFrame: then its sizes cannot be gathered up
    front, so its levels are those of ``b`` and ever coarser ones (a dozen at
    most), on which ``b`` is emitted too: no rectangle covers more cells than
    on its own level.
    """
    if stats is not None:
        sa, sb = stats
    elif a.isStreaming:
        sa, sb = None, SideStats(b, bcols)
    else:
        sa, sb = SideStats.many([(a, acols), (b, bcols)])
    lb = sb.levels(cell)
    la = open_ended(lb) if sa is None else sa.levels(cell)
    A = a.withColumn("_galvl", level_of(rect_extent(*acols), la))
    B = b.withColumn("_gblvl", level_of(rect_extent(*bcols), lb))
    Ac = _rect_cells_multi(A, "_galvl", lb, acols, "a")
    Bc = _rect_cells_multi(B, "_gblvl", la, bcols, "b")
    Ac, Bc = _dealt(Ac, Bc, copies(sb, lb, la) * CELLS_PER_RECT, None if sa is None else copies(sa, la, lb) * CELLS_PER_RECT)
    # broadcast the side with the smaller proven size, if it fits at all
    rows_b = copies(sb, lb, la) * CELLS_PER_RECT
    rows_a = None if sa is None else copies(sa, la, lb) * CELLS_PER_RECT
    if rows_a is not None and rows_a < rows_b:
        Ac = _size_guard(Ac, rows_a)
    else:
        Bc = _size_guard(Bc, rows_b)
    ax1, ay1, ax2, ay2 = acols
    bx1, by1, bx2, by2 = bcols
    side = cell_side(F.col("_gaL"))
    j = Ac.join(
        Bc,
        (F.col("_gaL") == F.col("_gbL"))
        & (F.col("_gacx") == F.col("_gbcx"))
        & (F.col("_gacy") == F.col("_gbcy")),
    ).where(
        # meet on the coarser of the two levels only
        ((F.col("_galvl") == F.col("_gaL")) | (F.col("_gblvl") == F.col("_gbL")))
        & (rects_intersect(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) if meets is None else meets)
        # and only in the cell of the reference corner
        & (cell_of(F.greatest(F.col(ax1), F.col(bx1)), side) == F.col("_gacx"))
        & (cell_of(F.greatest(F.col(ay1), F.col(by1)), side) == F.col("_gacy"))
    )
    return _drop_helpers(j)


def _prep_points(df: DataFrame, pid: str, x: str, y: str) -> DataFrame:
    t = dict(df.dtypes)
    return df.where(valid_coords(df, x, y)).select(
        F.col(pid).alias("_pid"), widened(x, t[x]).alias("_px"), widened(y, t[y]).alias("_py"))


def _prep_rects(df: DataFrame, rid: str, cols, tag: str) -> DataFrame:
    x1, y1, x2, y2 = cols
    t = dict(df.dtypes)
    d = df.where(valid_coords(df, x1, y1, x2, y2))
    x1, y1, x2, y2 = (widened(c, t[c]) for c in cols)
    return d.select(
        F.col(rid).alias(f"_{tag}id"),
        F.least(x1, x2).alias(f"_{tag}x1"), F.least(y1, y2).alias(f"_{tag}y1"),
        F.greatest(x1, x2).alias(f"_{tag}x2"), F.greatest(y1, y2).alias(f"_{tag}y2"),
    )


def _gathered(P: DataFrame, W: DataFrame, pcols, pid: Column, is_point: Column, over: int = 0) -> DataFrame | None:
    """Whole lists of prepared frames by probe id; ``None`` where they are to be grouped from pairs."""
    wcols = ("_wx1", "_wy1", "_wx2", "_wy2")
    types = {t for c, t in P.dtypes + W.dtypes if c in (*pcols, *wcols)}
    if types != {"bigint"} or P.isStreaming or W.isStreaming or (held := W.count()) > HELD or (n := P.count()) <= over:
        return None
    corners = [f"_{c}" for c in ("x1", "y1", "x2", "y2")]
    return gathered(
        P.select(pid.alias("_pid"), is_point.alias("_open"), *[F.col(c).alias(to) for c, to in zip(pcols, corners)]),
        W.select("_wid", *[F.col(c).alias(to) for c, to in zip(wcols, corners)]), n, held)


def _by_tile(P: DataFrame, W: DataFrame, pcols, wcols, stats: tuple[SideStats | None, SideStats], predicate: str) -> DataFrame | None:
    """The pairs of prepared frames by tile; ``None`` for few rows, and where one side is to be broadcast."""
    sp, sw = stats
    if not tiles.listable(P, W, pcols, wcols):
        return None
    least = sw.n if sp is None else min(sp.n, sw.n)
    if 2 * (8 + 8 * len(wcols)) * CELLS_PER_RECT * least <= threshold_bytes(P.sparkSession):
        return None
    sp = sp or SideStats(P, pcols)
    return tiles.listed(P, W, pcols, wcols, (sp, sw), predicate) if sp.n + sw.n >= tiles.FROM else None


def _grouped(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("probe_id").agg(F.collect_set("window_id").alias("window_id"))


def spatial_join(probes: DataFrame, windows: DataFrame, predicate: str = "within",
                 probe_id: str = "id", window_id: str = "id", x: str = "x", y: str = "y",
                 probe_rect=("x1", "y1", "x2", "y2"), window_rect=("x1", "y1", "x2", "y2"),
                 cell: float | None = None, lists: bool = False) -> DataFrame:
    """Pairs ``(probe_id, window_id)`` of probes meeting windows.

    predicate ``within``: probe points strictly inside a window (open border,
    as the point join); ``within_closed``: closed border; ``intersects``:
    probe rectangles meeting a window (closed).  Inner join semantics; use
    ``collect_matches``/``spatial_count`` with ``probes=`` for the left form.
    ``lists``: as for ``spatial_join_shapes``, by probe id for more than ``GROUP`` probes.
    """
    if predicate not in PREDICATES:
        raise ValueError(f"predicate must be one of {PREDICATES}")
    W = _prep_rects(windows, window_id, window_rect, "w")
    wcols = ("_wx1", "_wy1", "_wx2", "_wy2")
    stats = None
    if predicate == "intersects":
        P = _prep_rects(probes, probe_id, probe_rect, "p")
        if probes is windows and tuple(probe_rect) == tuple(window_rect) and not probes.isStreaming:
            sw = SideStats(W, wcols)  # a self-join: one side's statistics serve both
            stats = (sw, sw)
        pcols = ("_px1", "_py1", "_px2", "_py2")
    else:
        P, pcols = _prep_points(probes, probe_id, x, y), ("_px", "_py", "_px", "_py")
    if lists:
        whole = _gathered(P, W, pcols, F.col("_pid"), F.lit(predicate == "within"), over=GROUP)
        if whole is not None:
            return whole
    if cell is None and not (probes.isStreaming or windows.isStreaming):
        if predicate != "intersects":
            stats = None, SideStats(W, wcols)
        elif stats is None:
            stats = tuple(SideStats.many([(P, pcols), (W, wcols)]))
        if (pairs := _by_tile(P, W, pcols, wcols, stats, predicate)) is not None:
            return _grouped(pairs) if lists else pairs
    if predicate == "intersects":
        j = join_rects_rects(P, W, pcols, wcols, cell=cell, stats=stats)
    else:
        j = join_points_rects(P, W, "_px", "_py", wcols, closed=(predicate == "within_closed"), cell=cell,
                              stats=stats and stats[1])
    pairs = j.select(F.col("_pid").alias("probe_id"), F.col("_wid").alias("window_id"))
    return _grouped(pairs) if lists else pairs


def spatial_join_mixed(points: DataFrame, rects: DataFrame, windows: DataFrame,
                       probe_id: str = "id", window_id: str = "id",
                       cell: float | None = None) -> DataFrame:
    """Mixed probe kinds: points use the open point join, rectangles intersection.

    The grid statistics of the rectangle probes and of the windows come from
    one job and serve both joins.
    """
    W = _prep_rects(windows, window_id, ("x1", "y1", "x2", "y2"), "w")
    R = _prep_rects(rects, probe_id, ("x1", "y1", "x2", "y2"), "p")
    P = _prep_points(points, probe_id, "x", "y")
    wcols, rcols = ("_wx1", "_wy1", "_wx2", "_wy2"), ("_px1", "_py1", "_px2", "_py2")
    if rects.isStreaming or points.isStreaming:
        sr, sw = None, SideStats(W, wcols)
    else:
        sr, sw = SideStats.many([(R, rcols), (W, wcols)])
    pp = join_points_rects(P, W, "_px", "_py", wcols, closed=False, cell=cell, stats=sw)
    rr = join_rects_rects(R, W, rcols, wcols, cell=cell, stats=(sr, sw))
    out = [j.select(F.col("_pid").alias("probe_id"), F.col("_wid").alias("window_id")) for j in (pp, rr)]
    return out[0].unionByName(out[1])


def spatial_join_shapes(shapes: DataFrame, windows: DataFrame, window_id: str = "id",
                        cell: float | None = None, lists: bool = False) -> DataFrame:
    """Mixed probes in one frame (``parse_probes``), one scan and one join.

    A point is a rectangle without extent that meets a window only strictly
    inside; a rectangle meets it by closed intersection.  With ``lists`` a probe
    id comes once and ``window_id`` is the array of all it meets, for
    ``collect_matches``: bigint corners and up to ``HELD`` windows are joined by
    probe id, and no pair is shuffled; others are grouped from their pairs.
    """
    W = _prep_rects(windows, window_id, ("x1", "y1", "x2", "y2"), "w")
    P = _prep_rects(shapes.withColumn("_shape", F.struct("id", "is_point")), "_shape", ("x1", "y1", "x2", "y2"), "p")
    pcols, wcols = ("_px1", "_py1", "_px2", "_py2"), ("_wx1", "_wy1", "_wx2", "_wy2")
    if lists:
        whole = _gathered(P, W, pcols, F.col("_pid.id"), F.col("_pid.is_point"))
        if whole is not None:
            return whole
    meets = F.when(F.col("_pid.is_point"), point_in_rect("_px1", "_py1", *wcols, closed=False)).otherwise(
        rects_intersect(*pcols, *wcols))
    j = join_rects_rects(P, W, pcols, wcols, cell=cell, meets=meets)
    pairs = j.select(F.col("_pid.id").alias("probe_id"), F.col("_wid").alias("window_id"))
    return _grouped(pairs) if lists else pairs


def _with_unmatched(pairs: DataFrame, probes: DataFrame | None, probe_id: str) -> DataFrame:
    """Left form without a join: every probe id contributes a (id, null) row."""
    if probes is None:
        return pairs
    ids = probes.select(F.col(probe_id).alias("probe_id"),
                        F.lit(None).cast(pairs.schema["window_id"].dataType).alias("window_id"))
    return pairs.unionByName(ids)


def collect_matches(pairs: DataFrame, probes: DataFrame | None = None,
                    probe_id: str = "id") -> DataFrame:
    """Per probe id, the sorted list of distinct window ids it meets.

    Repeated probe ids merge (union of their matches).  ``collect_set`` is
    combined map-side, so each probe's list is deduplicated before the
    shuffle; the list holds the answer for that probe and nothing more.
    With ``probes`` given, probes without a match get an empty list.  Without
    them, lists of a join (``lists=True``) are whole and only sorted.
    """
    if probes is None and dict(pairs.dtypes)["window_id"].startswith("array<"):
        return pairs.select("probe_id", F.sort_array("window_id").alias("matches"))
    src = _with_unmatched(pairs, probes, probe_id)
    return src.groupBy("probe_id").agg(
        F.array_sort(F.collect_set("window_id")).alias("matches"))


def match_counts(matches: DataFrame) -> DataFrame:
    """Number of matches per probe from the list form (``size``)."""
    return matches.select("probe_id", F.size("matches").cast("bigint").alias("n_matches"))


def _pair_counts(probes: DataFrame, windows: DataFrame, predicate: str, cell: float | None) -> DataFrame:
    """``probe_id, n_matches`` by listing the pairs of prepared frames: distinct window ids per probe id."""
    wcols, pcols = ("_wx1", "_wy1", "_wx2", "_wy2"), ("_px1", "_py1", "_px2", "_py2")
    if predicate == "intersects":
        pairs = join_rects_rects(probes, windows, pcols, wcols, cell=cell)
    else:
        pairs = join_points_rects(probes, windows, "_px1", "_py1", wcols, closed=predicate == "within_closed", cell=cell)
    return pairs.groupBy(F.col("_pid").alias("probe_id")).agg(F.count_distinct("_wid").alias("n_matches"))


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt to tasks of about ``SPREAD`` of its ``rows`` rows, by all columns, so that a hot id is spread too.

    Sums by id hold every id that a task has; a scan's tasks are as large as the files.
    """
    tasks = -(-rows // SPREAD)
    return df if tasks < 2 else df.repartition(tasks, *df.columns)


def _repeated_ids(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | F.col(col).isNull()).select(
        F.col(col).alias("_again"))


def _count_without_pairs(P: DataFrame, W: DataFrame, predicate: str, cell: float | None) -> list[DataFrame]:
    """Parts ``probe_id, n_matches`` that add up, by probe id; only ids that stand on several rows are listed as pairs."""
    again = [_repeated_ids(P, "_pid"), _repeated_ids(W, "_wid")]
    some = {r["side"] for r in again[0].select(F.lit(0).alias("side")).unionByName(
        again[1].select(F.lit(1).alias("side"))).distinct().collect()}
    parts, once_p, once_w = [], P, W
    if 0 in some:
        same = F.col("_pid").eqNullSafe(F.col("_again"))
        parts.append(_pair_counts(P.join(again[0], same, "left_semi"), W, predicate, cell))
        once_p = P.join(again[0], same, "left_anti")
    if 1 in some:
        same = F.col("_wid") == F.col("_again")
        parts.append(_pair_counts(once_p, W.join(again[1], same, "left_semi"), predicate, cell))
        once_w = W.join(again[1], same, "left_anti")
    id_type = dict(P.dtypes)["_pid"]
    counted = count_meeting(once_p.withColumn("_pid", F.col("_pid").cast("string")), once_w, closed=predicate != "within")
    return [counted.select(F.col("_pid").cast(id_type).alias("probe_id"), F.col("n").alias("n_matches")), *parts]


def spatial_count(probes: DataFrame, windows: DataFrame, predicate: str = "within",
                  how: str = "inner", probe_id: str = "id", window_id: str = "id",
                  x: str = "x", y: str = "y", probe_rect=("x1", "y1", "x2", "y2"),
                  window_rect=("x1", "y1", "x2", "y2"), cell: float | None = None) -> DataFrame:
    """Per probe id, how many distinct windows it meets; ``how='left'`` keeps zeros.

    Counted without listing pairs (``planekit.operators.count``) where ids are
    unique; rows that share an id with others are joined, as their matches may
    coincide.  Windows without an id do not count.  Streams, and coordinates
    other than integers and doubles, are joined and counted.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if predicate not in PREDICATES:
        raise ValueError(f"predicate must be one of {PREDICATES}")
    rects = probe_rect if predicate == "intersects" else (x, y, x, y)
    P, W = _prep_rects(probes, probe_id, rects, "p"), _prep_rects(windows, window_id, window_rect, "w")
    W = W.where(F.col("_wid").isNotNull())
    pcols, wcols = ("_px1", "_py1", "_px2", "_py2"), ("_wx1", "_wy1", "_wx2", "_wy2")
    same = dict(P.dtypes)["_px1"] == dict(W.dtypes)["_wx1"]
    if probes.isStreaming or windows.isStreaming or not (same and countable(P, pcols) and countable(W, wcols)):
        parts = [_pair_counts(P, W, predicate, cell)]
    else:
        rows = P.count()
        parts = _count_without_pairs(_spread(P, rows), W, predicate, cell)
    add_up = len(parts) > 1
    if how == "left":  # probes that no part has: unmatched, or without coordinates
        zeros = probes.select(F.col(probe_id).alias("probe_id"), F.lit(0).cast("long").alias("n_matches"))
        parts.append(zeros if probes.isStreaming else _spread(zeros, zeros.count()))
        add_up = True
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if add_up:
        out = out.groupBy("probe_id").agg(F.sum("n_matches").alias("n_matches"))
    return out if how == "left" else out.where("n_matches > 0")


def matches_text(matches: DataFrame) -> DataFrame:
    """The reference's row text ``id,m1,m2,...`` (ids ascending)."""
    return matches.select(F.concat_ws(",", F.col("probe_id").cast("string"),
                                      F.col("matches").cast("array<string>")).alias("value"))
