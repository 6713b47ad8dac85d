"""In-task geometry helpers (numpy / plain Python) used inside Pandas UDFs.

Small and exact: orientation is computed with Python ints for integer
coordinates and, for doubles, with a floating filter backed by exact
rational arithmetic when the sign is in doubt.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd

# relative error bound of the floating orientation determinant
_ORIENT_BOUND = 3.3306690738754716e-16


def orient(ax, ay, bx, by, cx, cy):
    """> 0 if a -> b -> c turns counter-clockwise, < 0 clockwise, 0 collinear (exact sign)."""
    vals = (ax, ay, bx, by, cx, cy)
    if all(isinstance(v, int) for v in vals):
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    if not all(isinstance(v, (int, float)) for v in vals):  # e.g. Decimal: exact
        ax, ay, bx, by, cx, cy = (Fraction(v) for v in vals)
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    left = (bx - ax) * (cy - ay)
    right = (by - ay) * (cx - ax)
    det = left - right
    if abs(det) > _ORIENT_BOUND * (abs(left) + abs(right)):
        return det
    fa, fb, fc = (Fraction(ax), Fraction(ay)), (Fraction(bx), Fraction(by)), (Fraction(cx), Fraction(cy))
    return (fb[0] - fa[0]) * (fc[1] - fa[1]) - (fb[1] - fa[1]) * (fc[0] - fa[0])


def sq_dist_exact(ax, ay, bx, by):
    """Exact squared distance: Python int for ints, Fraction for floats."""
    if isinstance(ax, int) and isinstance(ay, int) and isinstance(bx, int) and isinstance(by, int):
        return (ax - bx) ** 2 + (ay - by) ** 2
    dx = Fraction(ax) - Fraction(bx)
    dy = Fraction(ay) - Fraction(by)
    return dx * dx + dy * dy


def _from_origin(v: np.ndarray) -> np.ndarray | None:
    """Coordinates as doubles without loss: integers as offsets from their minimum.

    None where that would round: offsets of 2**52 and more, or Decimals.
    """
    if v.dtype.kind == "f":
        return v.astype(np.float64)
    if v.dtype.kind != "i" or int(v.max()) - int(v.min()) >= 1 << 52:
        return None
    return (v - v.min()).astype(np.float64)


def prefilter(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Mask of points NOT strictly inside the octagon of 8 extreme points.

    Vectorised Akl-Toussaint step; floating with a safety margin, so it only
    ever drops points that are inside by more than the rounding error.  Where
    doubles cannot hold the coordinates exactly, nothing is dropped.
    """
    n = len(xs)
    fx, fy = (_from_origin(xs), _from_origin(ys)) if n else (None, None)
    if fx is None or fy is None:
        return np.ones(n, dtype=bool)
    s, t = fx + fy, fx - fy
    idx = [int(np.argmin(fx)), int(np.argmin(s)), int(np.argmin(fy)), int(np.argmax(t)),
           int(np.argmax(fx)), int(np.argmax(s)), int(np.argmax(fy)), int(np.argmin(t))]
    poly = []
    for i in idx:
        p = (fx[i], fy[i])
        if not poly or poly[-1] != p:
            poly.append(p)
    while len(poly) > 1 and poly[0] == poly[-1]:
        poly.pop()
    if len(poly) < 3:
        return np.ones(n, dtype=bool)
    inside = np.ones(n, dtype=bool)
    for k in range(len(poly)):
        (ax, ay), (bx, by) = poly[k], poly[(k + 1) % len(poly)]
        left = (bx - ax) * (fy - ay)
        right = (by - ay) * (fx - ax)
        margin = 1e-12 * (np.abs(left) + np.abs(right)) + 1e-300
        inside &= (left - right) > margin
    return ~inside


def _py(values) -> list:
    """numpy array -> list of Python ints or floats (ints stay exact)."""
    return values.tolist()


def hull_ccw(xs: np.ndarray, ys: np.ndarray) -> list[tuple]:
    """Strict convex hull vertices in counter-clockwise order (monotone chain).

    Duplicates are removed; collinear points on an edge are not vertices.
    0 points -> [], 1 point -> [p], all collinear -> the two ends.
    """
    if len(xs) == 0:
        return []
    keep = prefilter(xs, ys)
    pts = sorted(set(zip(_py(xs[keep]), _py(ys[keep]))))
    if len(pts) <= 2:
        return pts
    lower: list = []
    for p in pts:
        while len(lower) >= 2 and orient(*lower[-2], *lower[-1], *p) <= 0:
            lower.pop()
        lower.append(p)
    upper: list = []
    for p in reversed(pts):
        while len(upper) >= 2 and orient(*upper[-2], *upper[-1], *p) <= 0:
            upper.pop()
        upper.append(p)
    return lower[:-1] + upper[:-1]


def _area2(a, b, c):
    return abs(orient(*a, *b, *c))


def farthest_on_hull(hull: list[tuple]) -> tuple[object, list[tuple]]:
    """All vertex pairs at maximum distance, via rotating calipers (O(h)).

    Every diameter pair of a convex polygon is antipodal, and every antipodal
    pair has one end on an edge whose farthest vertex (or, for a parallel
    edge, one of the two) is the other end; the candidate set below contains
    all of them.  Returns ``(max squared distance, [(a, b), ...])`` with
    ``a < b`` in (x, y) order.
    """
    h = len(hull)
    if h < 2:
        return None, []
    if h == 2:
        a, b = sorted(hull)
        return sq_dist_exact(*a, *b), [(a, b)]
    cand = set()
    j = 1
    for i in range(h):
        ni = (i + 1) % h
        steps = 0
        while steps < h and _area2(hull[i], hull[ni], hull[(j + 1) % h]) > _area2(hull[i], hull[ni], hull[j]):
            j = (j + 1) % h
            steps += 1
        for v in (j, (j + 1) % h):
            cand.add((i, v))
            cand.add((ni, v))
    best, pairs = None, []
    for i, v in cand:
        if i == v:
            continue
        a, b = sorted((hull[i], hull[v]))
        d = sq_dist_exact(*a, *b)
        if best is None or d > best:
            best, pairs = d, [(a, b)]
        elif d == best:
            pairs.append((a, b))
    return best, sorted(set(pairs))


def _groups(pdf: pd.DataFrame, keys: list[str], x: str, y: str):
    """``(key values, xs, ys)`` of each group, from one sort."""
    if not keys:
        yield (), pdf[x].to_numpy(), pdf[y].to_numpy()
        return
    code = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    order = np.argsort(code, kind="stable")
    firsts = np.flatnonzero(np.diff(code[order], prepend=-1))
    values = list(zip(*(pdf[k].to_numpy()[order[firsts]].tolist() for k in keys)))
    xs, ys = pdf[x].to_numpy()[order], pdf[y].to_numpy()[order]
    for key, lo, hi in zip(values, firsts, np.append(firsts[1:], len(order))):
        yield key, xs[lo:hi], ys[lo:hi]


def group_hulls(pdf: pd.DataFrame, keys: list[str], x: str, y: str) -> pd.DataFrame:
    """The rows of ``pdf`` that are hull vertices of their group, once each."""
    rows, own = [], []
    for key, xs, ys in _groups(pdf, keys, x, y):
        hull = hull_ccw(xs, ys) if len(xs) > 1 else list(zip(xs.tolist(), ys.tolist()))
        rows += hull
        own += [key] * len(hull)
    out = pd.DataFrame({x: pd.Series([r[0] for r in rows], dtype=pdf[x].dtype),
                        y: pd.Series([r[1] for r in rows], dtype=pdf[y].dtype)})
    for i, k in enumerate(keys):
        out[k] = pd.Series([key[i] for key in own], dtype=object)
    return out[keys + [x, y]]


#: safety margin of an angle (radians); far above the rounding of differences and arctan2
ANGLE_MARGIN = 1e-12


def _directions(x0, y0, x1, y1) -> np.ndarray:
    """Angles in (-pi, pi] of the vectors from one array of points to another."""
    def minus(a, b):
        if a.dtype.kind == "i" and len(a) and max(map(abs, map(int, (a.max(), a.min(), b.max(), b.min())))) < 1 << 62:
            return (a - b).astype(np.float64)
        if a.dtype.kind == "f":
            return a * 0.5 - b * 0.5  # no overflow; halving both parts keeps the direction
        return np.array([float(p - q) for p, q in zip(a.tolist(), b.tolist())], np.float64)
    return np.arctan2(minus(y1, y0) + 0.0, minus(x1, x0) + 0.0)


def cones(xs: np.ndarray, ys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vertex the angles of the edges into and out of it; NaN for a hull of one vertex.

    Rows are hulls in counter-clockwise order, one after the other; ``group``
    numbers them.  A vertex is extreme in the directions of its cone (turned by a
    quarter), so a hull's cones go round the circle once.
    """
    n = len(group)
    if not n:
        return np.zeros(0), np.zeros(0)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    following = np.arange(1, n + 1)
    following[starts + sizes - 1] = starts
    out = _directions(xs, ys, xs[following], ys[following])
    out[np.repeat(sizes, sizes) == 1] = np.nan
    into = np.empty(n)
    into[following] = out
    return into, out


def buckets_of(into: np.ndarray, out: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, bucket`` of every angle bucket that a cone touches (all of them for a NaN cone)."""
    n = len(cuts) + 1
    first = np.searchsorted(cuts, into - ANGLE_MARGIN, "right")
    last = np.searchsorted(cuts, out + ANGLE_MARGIN, "right")
    first = np.where(into - ANGLE_MARGIN < -np.pi, n - 1, first)
    last = np.where(out + ANGLE_MARGIN > np.pi, 0, last)
    wraps = (out < into) | (into - ANGLE_MARGIN < -np.pi) | (out + ANGLE_MARGIN > np.pi)
    count = np.where(wraps, last + n - first + 1, last - first + 1)
    lone = np.isnan(into)
    first, count = np.where(lone, 0, first), np.where(lone, n, np.clip(count, 1, n))
    row = np.repeat(np.arange(len(into)), count)
    return row, (np.repeat(first, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) % n


def opposite(angle: np.ndarray) -> np.ndarray:
    """The angle of the opposite direction, in (-pi, pi]."""
    return np.where(angle > 0, angle - np.pi, angle + np.pi)


def hull_in_bucket(xs: np.ndarray, ys: np.ndarray, alone: bool, cuts: np.ndarray, bucket: int) -> list[tuple]:
    """The vertices whose incoming edge has its angle in ``bucket``; ``alone``: all partial hulls had one vertex."""
    hull = hull_ccw(xs, ys)
    if len(hull) == 1:
        return hull if alone and bucket == 0 else []
    into, _ = cones(*_columns(hull, xs, ys), np.zeros(len(hull)))
    return [v for v, k in zip(hull, np.searchsorted(cuts, into, "right")) if k == bucket]


def _columns(points: list[tuple], xs: np.ndarray, ys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.array([p[0] for p in points], xs.dtype), np.array([p[1] for p in points], ys.dtype)


def _arcs(into: np.ndarray, out: np.ndarray, lo: float, hi: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, start, end`` of the cones' parts between two angles, in order of angle."""
    rows, start, end = [], [], []
    lone = np.isnan(into)
    for wrapped, a, b in ((False, into, out), (True, into, np.full(len(into), np.pi)), (True, np.full(len(into), -np.pi), out)):
        use = ~lone & ((out < into) == wrapped) & (b + ANGLE_MARGIN >= lo) & (a - ANGLE_MARGIN <= hi)
        rows.append(np.flatnonzero(use))
        start.append(np.maximum(a[use], lo) - ANGLE_MARGIN)
        end.append(np.minimum(b[use], hi) + ANGLE_MARGIN)
    rows.append(np.flatnonzero(lone))
    start.append(np.full(int(lone.sum()), lo))
    end.append(np.full(int(lone.sum()), hi))
    rows, start, end = map(np.concatenate, (rows, start, end))
    order = np.argsort(start, kind="stable")
    return rows[order], start[order], end[order]


def farthest_in_bucket(near: tuple, far: tuple, cuts: np.ndarray, bucket: int) -> tuple[object, list[tuple]]:
    """The farthest of the vertex pairs that are extreme in opposite directions, one of them in the bucket.

    A diameter's ends are such a pair.  ``near`` and ``far`` are the ``(xs, ys)`` of
    the points extreme in the bucket's directions and in the opposite ones.
    """
    lo = cuts[bucket - 1] if bucket else -np.pi
    hi = cuts[bucket] if bucket < len(cuts) else np.pi
    sides = []
    for k, (xs, ys) in enumerate((near, far)):
        hull = hull_ccw(xs, ys)
        hx, hy = _columns(hull, xs, ys)
        into, out = cones(hx, hy, np.zeros(len(hull)))
        sides.append((hull, hx, hy, *_arcs(*((opposite(into), opposite(out)) if k else (into, out)), lo, hi)))
    (a, ax, ay, i, a0, a1), (b, bx, by, j, b0, b1) = sides
    begin = np.searchsorted(np.maximum.accumulate(b1) if len(b1) else b1, a0, "left")
    size = np.maximum(np.searchsorted(b0, a1, "right") - begin, 0)
    row = np.repeat(np.arange(len(a0)), size)
    other = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    p, q = i[row], j[other]
    if not len(p):
        return None, []
    rough = [np.array([float(v) for v in c.tolist()]) if c.dtype.kind == "O" else c.astype(np.float64)
             for c in (ax, ay, bx, by)]
    length = np.hypot(rough[0][p] - rough[2][q], rough[1][p] - rough[3][q])
    # rounding of the doubles: of the coordinates, as they may be far from the origin, and of the sum
    slack = 1e-9 * length.max() + 4e-16 * max(float(np.abs(c).max()) for c in rough) * 4
    best, pairs = None, set()
    for k in np.flatnonzero(length >= length.max() - slack).tolist():
        u, v = sorted((a[p[k]], b[q[k]]))
        if u == v:
            continue
        d = sq_dist_exact(*u, *v)
        if best is None or d > best:
            best, pairs = d, {(u, v)}
        elif d == best:
            pairs.add((u, v))
    return best, sorted(pairs)
