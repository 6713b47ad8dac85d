"""Convex hull (overall or per group) and farthest pairs.

Plan, all distributed:

1. ``mapInPandas`` over the input partitions, in ONE pass and with no
   shuffle: each Arrow batch (two numeric columns) is pruned by the octagon
   of its own 8 extreme points (vectorised numpy), and the survivors are
   folded into an exact monotone-chain hull per group of the partition.
   (Optionally, ``catalyst_prefilter=True`` first drops points strictly
   inside the global/per-group octagon in the JVM; that costs an extra
   aggregate pass, and per group a shuffle of all points by key, so it only
   pays when Arrow transfer is the bottleneck.)
2. Reduction: the partial hulls are re-shuffled by group key and a salt of
   ``FANIN`` values (source partition modulo ``FANIN``) and hulled again, so
   that of P source partitions no salted group receives more than P / FANIN
   partial hulls, and no final group more than ``FANIN``, even for a group
   holding a third of all rows.
3. The partial hulls are written once, each vertex with the angles of its two
   edges.  A group with more than ``VERTICES`` of them is cut into buckets of
   edge angles (quantiles of its own edges); a vertex goes to the buckets that
   its angles span.  The vertices in a bucket decide the hull there, whatever
   lies elsewhere, so each bucket is hulled by itself and keeps the vertices
   whose incoming edge is its own: a hull as large as its input is spread over
   tasks.  Angles are doubles with a margin; they only decide who meets whom,
   orientation stays exact.
4. ``groupBy(keys, bucket).applyInPandas``: the hull there.  For farthest pairs
   a bucket also holds the vertices of opposite directions, as the ends of a
   diameter are extreme in opposite ones; rotating calipers where a group is one
   bucket.

Coordinates keep their type: integer columns give exact results; doubles are
exact too (orientation has a rational fallback), ties decided exactly.  Group
keys pass Python as strings and come back in their own type unaltered (a
bigint key never becomes a float, with or without null keys).
"""

from __future__ import annotations

import math
import sys
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.functions.geom import cross, finite_coords
from planekit.operators import _geom_local
from planekit.operators._geom_local import (
    buckets_of,
    cones,
    farthest_in_bucket,
    farthest_on_hull,
    group_hulls,
    hull_ccw,
    hull_in_bucket,
    opposite,
)
from planekit.plans.guard import size_guard
from planekit.session import cut_lineage

# the in-task helpers travel with the Pandas UDFs (pickled by value), so the
# Python workers never need this package installed or on their path
cloudpickle.register_pickle_by_value(_geom_local)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FANIN = 64
#: vertices of partial hulls that one group, or bucket of a group, holds at most about
VERTICES = 50_000
_BUCKET = "_hk"
_INTO, _OUT = "_into", "_out"
# fold the per-partition buffer into its hull past this many rows
_BUFFER_ROWS = 50_000

_DIRS = [  # counter-clockwise order of the octagon's extreme points
    ("min", "x"), ("min", "s"), ("min", "y"), ("max", "t"),
    ("max", "x"), ("max", "s"), ("max", "y"), ("min", "t"),
]


def _octagon(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Per group: 8 extreme points as columns e0x, e0y, ..., e7x, e7y."""
    exprs = {"x": F.col(x), "y": F.col(y), "s": F.col(x) + F.col(y), "t": F.col(x) - F.col(y)}
    aggs = []
    for k, (fn, e) in enumerate(_DIRS):
        by = F.min_by if fn == "min" else F.max_by
        aggs.append(by(F.struct(F.col(x).alias("x"), F.col(y).alias("y")), exprs[e]).alias(f"_e{k}"))
    g = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return g.select(*keys, *[F.col(f"_e{k}.{c}").alias(f"_e{k}{c}") for k in range(8) for c in "xy"])


def _strictly_inside(x: str, y: str, double: bool):
    """Column: point strictly inside the octagon (degenerate edges ignored)."""
    cond, any_edge = F.lit(True), F.lit(False)
    for k in range(8):
        n = (k + 1) % 8
        ax, ay, bx, by = (F.col(f"_e{k}x"), F.col(f"_e{k}y"), F.col(f"_e{n}x"), F.col(f"_e{n}y"))
        degenerate = (ax == bx) & (ay == by)
        c = cross(ax, ay, bx, by, F.col(x), F.col(y))
        if double:
            scale = F.abs((bx - ax) * (F.col(y) - ay)) + F.abs((by - ay) * (F.col(x) - ax))
            positive = c > scale * F.lit(1e-12)
        else:
            positive = c > 0
        cond = cond & (degenerate | positive)
        any_edge = any_edge | ~degenerate
    return cond & any_edge


def octagon_filter(points: DataFrame, x: str = "x", y: str = "y", keys=()) -> DataFrame:
    """Drop points strictly inside the octagon of extremes (never a hull vertex)."""
    keys = list(keys)
    types = dict(points.dtypes)
    # integer columns: exact bigint arithmetic (ANSI raises on overflow);
    # doubles: a relative margin so rounding never drops a boundary point
    double = types[x] in ("double", "float") or types[y] in ("double", "float")
    octo = _octagon(points, keys, x, y)
    if keys:
        # one row per group: broadcast only under the proven bound (the exact
        # group count), else a sort-merge join (AQE splits a hot group's side)
        joined = points.join(size_guard(octo, octo.count()), on=keys, how="inner")
    else:
        joined = _with_one_row(points, octo)
    kept = joined.where(~_strictly_inside(x, y, double))
    return kept.select(*points.columns)


def _with_one_row(points: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the single row of a global aggregate as literals (8 bounded points)."""
    r = one.first()
    if r is None:
        return points.where(F.lit(False))
    return points.withColumns({c: F.lit(r[c]) for c in one.columns})


def _schema(df: DataFrame, keys: list[str], x: str, y: str) -> str:
    t = dict(df.dtypes)
    return ", ".join([f"`{k}` {t[k]}" for k in keys] + [f"`{x}` {t[x]}", f"`{y}` {t[y]}"])


def _key_to_text(name: str, dtype: str):
    if dtype == "binary":
        return F.hex(name).alias(name)
    if dtype == "timestamp":
        return F.unix_micros(name).cast("string").alias(name)
    return F.col(name).cast("string").alias(name)


def _text_to_key(name: str, dtype: str):
    if dtype == "binary":
        return F.unhex(name).alias(name)
    if dtype == "timestamp":
        return F.timestamp_micros(F.col(name).cast("bigint")).alias(name)
    return F.col(name).cast(dtype).alias(name)


def _partial_hull_fn(keys: list[str], x: str, y: str):
    """mapInPandas body: fold the partition's batches into one hull per group.

    The buffer is folded when it has doubled since the last fold; a fold that
    does not halve it (points on a curve, or as many groups as points) is
    passed on instead of being held and folded again.  So the work is linear
    in the rows (up to the sort) and the memory bounded.
    """
    def run(batches):
        buf: list[pd.DataFrame] = []
        rows, fold_at = 0, _BUFFER_ROWS
        for b in batches:
            if len(b) == 0:
                continue
            buf.append(b[keys + [x, y]])
            rows += len(b)
            if rows >= fold_at:
                folded = group_hulls(pd.concat(buf, ignore_index=True), keys, x, y)
                if 2 * len(folded) > rows:
                    yield folded
                    buf, rows, fold_at = [], 0, _BUFFER_ROWS
                else:
                    buf, rows = [folded], len(folded)
                    fold_at = max(_BUFFER_ROWS, 2 * rows)
        if buf:
            yield group_hulls(pd.concat(buf, ignore_index=True), keys, x, y)
    return run


def _with_cones_fn(keys: list[str], x: str, y: str):
    """mapInPandas body: the hull per group, each vertex with the angles of its edges."""
    fold = _partial_hull_fn(keys, x, y)

    def run(batches):
        for pdf in fold(batches):
            group = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy() if keys else np.zeros(len(pdf))
            into, out = cones(pdf[x].to_numpy(), pdf[y].to_numpy(), group)
            yield pdf.assign(**{_INTO: into, _OUT: out})
    return run


def _partial_hulls(points: DataFrame, keys: list[str], x: str, y: str, fanin: int = FANIN) -> DataFrame:
    """Partial hulls with text keys and edge angles, written once; at most ``fanin`` of them per group."""
    types = dict(points.dtypes)
    text = points.select(*[_key_to_text(k, types[k]) for k in keys], x, y)
    schema = _schema(text, keys, x, y)
    salted = text.mapInPandas(_partial_hull_fn(keys, x, y), schema).withColumn("_salt", F.spark_partition_id() % fanin)
    cones_schema = f"{schema}, {_INTO} double, {_OUT} double"
    return cut_lineage(salted.repartition(*keys, "_salt").drop("_salt").mapInPandas(_with_cones_fn(keys, x, y), cones_schema))


def _angle_cuts(partial: DataFrame, keys: list[str], vertices: int) -> dict[tuple, np.ndarray]:
    """The angles that cut a group with more than ``vertices`` vertices into buckets (about as many numbers as buckets)."""
    sizes = partial.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > vertices).collect()
    if not sizes:
        return {}
    want = {tuple(r[k] for k in keys): -(-r["_n"] // vertices) for r in sizes}
    parts = max(want.values())
    angles = F.percentile_approx(_INTO, F.array(*[F.lit(i / parts) for i in range(1, parts)]), 100 * parts)
    # edges of a lone vertex have no angle; quantiles skip NaN only if they are null
    seen = partial.withColumn(_INTO, F.nanvl(_INTO, F.lit(None).cast("double")))
    big = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), angles.alias("_cuts")).where(F.col("_n") > vertices)
    out = {}
    for r in big.collect():
        key = tuple(r[k] for k in keys)
        even = np.arange(1, want[key]) * parts // want[key] - 1
        out[key] = np.unique(np.array(r["_cuts"] or [], np.float64)[np.clip(even, 0, None)] if r["_cuts"] else np.zeros(0))
    return out


def _deal(partial: DataFrame, keys: list[str], x: str, y: str, cuts: dict[tuple, np.ndarray], both: bool) -> DataFrame:
    """Vertices with their ``_BUCKET``; ``both``: also those of opposite directions, marked ``_far``."""
    whole = partial.select(*keys, x, y, F.isnan(_INTO).alias("_alone"), F.lit(0).alias(_BUCKET), F.lit(False).alias("_far"))
    if not cuts:
        return whole
    schema = f"{_schema(partial, keys, x, y)}, _alone boolean, {_BUCKET} int, _far boolean"

    def deal(batches):
        for pdf in batches:
            pdf = pdf.assign(_alone=pdf[_INTO].isna())
            groups = pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]
            for key, part in groups:
                own = cuts.get(tuple(None if pd.isna(v) else v for v in (key if isinstance(key, tuple) else (key,))))
                into, out = part[_INTO].to_numpy(), part[_OUT].to_numpy()
                sides = [(False, into, out)] + [(True, opposite(into), opposite(out))] * (both and own is not None)
                for far, a, b in sides:
                    row, bucket = (np.arange(len(part)), 0) if own is None else buckets_of(a, b, own)
                    yield part.iloc[row][keys + [x, y, "_alone"]].assign(**{_BUCKET: bucket, "_far": far})

    return partial.mapInPandas(deal, schema)


def _cuts_of(pdf: pd.DataFrame, keys: list[str], cuts: dict[tuple, np.ndarray]) -> np.ndarray | None:
    return cuts.get(tuple(None if pd.isna(v) else v for v in (pdf[k].iloc[0] for k in keys)))


def _prepare(points: DataFrame, x: str, y: str, keys: list[str], catalyst_prefilter: bool) -> DataFrame:
    pts = points.where(finite_coords(points, x, y)).select(*keys, x, y)
    return octagon_filter(pts, x, y, keys) if catalyst_prefilter else pts


def convex_hull(points: DataFrame, x: str = "x", y: str = "y", group_by=None, fanin: int = FANIN,
                catalyst_prefilter: bool = False, vertices: int = VERTICES) -> DataFrame:
    """Strict hull vertices (``[group cols,] x, y``), distinct; sort with ``orderBy``.

    Points interior to a hull edge are not vertices; one point is its own
    hull; collinear input gives the two ends; no point gives no row.
    """
    keys = [group_by] if isinstance(group_by, str) else list(group_by or [])
    types = dict(points.dtypes)
    partial = _partial_hulls(_prepare(points, x, y, keys, catalyst_prefilter), keys, x, y, fanin)
    schema, cuts = _schema(partial, keys, x, y), _angle_cuts(partial, keys, vertices)

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        own = _cuts_of(pdf, keys, cuts)
        if own is None:
            return group_hulls(pdf, keys, x, y)
        hull = hull_in_bucket(pdf[x].to_numpy(), pdf[y].to_numpy(), bool(pdf["_alone"].all()), own, int(pdf[_BUCKET].iloc[0]))
        out = pd.DataFrame({c: pd.Series([v[i] for v in hull], dtype=pdf[c].dtype) for i, c in enumerate((x, y))})
        return out.assign(**{k: pdf[k].iloc[0] for k in keys})[keys + [x, y]]

    out = _deal(partial, keys, x, y, cuts, both=False).groupBy(*keys, _BUCKET).applyInPandas(final, schema)
    return out.select(*[_text_to_key(k, types[k]) for k in keys], x, y)


def _squares_fit(partial: DataFrame, x: str, y: str) -> bool:
    """Whether a bigint holds the square of the bounding box's diagonal."""
    r = partial.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    return r[0] is None or (r[1] - r[0]) ** 2 + (r[3] - r[2]) ** 2 < 1 << 63


def farthest_pairs(points: DataFrame, x: str = "x", y: str = "y", group_by=None, fanin: int = FANIN,
                   catalyst_prefilter: bool = False, vertices: int = VERTICES) -> DataFrame:
    """All pairs of distinct points at maximum distance: ``ax ay bx by d2 dist``.

    ``(ax, ay) < (bx, by)`` in (x, y) order; ``d2`` is the squared distance
    (exact for integer input: a bigint, or decimal(38,0) where the points span
    so much that a bigint could not hold it), ``dist`` its root.  Fewer than 2
    distinct points give no row.  Pairs are found by rotating calipers on the hull,
    never by an all-pairs join.
    """
    keys = [group_by] if isinstance(group_by, str) else list(group_by or [])
    types = dict(points.dtypes)
    partial = _partial_hulls(_prepare(points, x, y, keys, catalyst_prefilter), keys, x, y, fanin)
    cuts, t = _angle_cuts(partial, keys, vertices), dict(partial.dtypes)
    ints = ("tinyint", "smallint", "int", "bigint")
    integral = t[x] in ints and t[y] in ints
    floating = t[x] in ("double", "float") or t[y] in ("double", "float")
    # integers -> bigint (exact d2); doubles -> double; decimals keep their type
    ctype = "bigint" if integral else ("double" if floating or t[x] != t[y] else t[x])
    dtype = ("bigint" if _squares_fit(partial, x, y) else "decimal(38,0)") if integral else "double"
    cols = ["ax", "ay", "bx", "by", "d2", "dist"]
    schema = ", ".join([f"`{k}` {t[k]}" for k in keys] + [f"{c} {ctype}" for c in cols[:4]]
                       + [f"d2 {dtype}", "dist double", "_exact string"])

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        own, xs, ys = _cuts_of(pdf, keys, cuts), pdf[x].to_numpy(), pdf[y].to_numpy()
        if own is None:
            best, pairs = farthest_on_hull(hull_ccw(xs, ys))
        else:
            far = pdf["_far"].to_numpy()
            best, pairs = farthest_in_bucket((xs[~far], ys[~far]), (xs[far], ys[far]), own, int(pdf[_BUCKET].iloc[0]))
        rows = []
        for (ax, ay), (bx, by) in pairs:
            d2 = int(best) if integral else float(best)
            rows.append((ax, ay, bx, by, d2, math.sqrt(float(best))))
        out = pd.DataFrame(rows, columns=cols)
        if integral:
            out = out.astype({c: np.int64 for c in cols[:4]})
            out["d2"] = out["d2"].astype(np.int64) if dtype == "bigint" else out["d2"].map(Decimal)
        elif ctype == "double":
            out = out.astype({c: np.float64 for c in cols[:5]})
        else:
            out = out.astype({"d2": np.float64})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out.assign(_exact=str(best))[keys + cols + ["_exact"]]

    found = _deal(partial, keys, x, y, cuts, both=True).groupBy(*keys, _BUCKET).applyInPandas(final, schema)
    if cuts:
        found = _best_of_buckets(found, keys, t)
    return found.select(*[_text_to_key(k, types[k]) for k in keys], *cols)


def _best_of_buckets(found: DataFrame, keys: list[str], types: dict[str, str]) -> DataFrame:
    """Of the buckets' best pairs those at their group's maximum, compared exactly (one number per bucket)."""
    found = cut_lineage(found)

    def most(pdf: pd.DataFrame) -> pd.DataFrame:
        best = max(pdf["_exact"], key=Fraction)
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "_best": best}])

    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["_best string"])
    best = found.select(*keys, "_exact").distinct().withColumn("_one", F.lit(1)).groupBy(*keys, "_one").applyInPandas(most, schema)
    same = F.col("_exact") == F.col("_best")
    for k in keys:
        same = same & found[k].eqNullSafe(best[k])
    return found.join(best.hint("merge") if keys else F.broadcast(best), same, "left_semi").dropDuplicates()
