"""In-task helpers of the rectangle union (numpy / pandas): cutting rectangles into tiles, and a tile's vertices.

A tile owns the points ``[lo, hi) x [lo, hi)``; it holds the rectangles that touch a
quadrant of some owned point.  A rectangle that reaches beyond a tile's border is
clipped there and flagged (``w``, ``s``, ``e``, ``n``), so rectangles that look the same
from within the tile become equal rows, and only one of them is kept.  A tile with
a rectangle that is flagged on all sides is covered, and holds no vertex.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd

COLS = ["x1", "y1", "x2", "y2", "w", "s", "e", "n"]
#: a tile of so many crossings of its edge lines is swept at once
CELLS = 1 << 20

#: rectangles as arrays in the order of COLS; on axis 0 or 1: low coordinate ``[axis]``, high coordinate
#: ``[2 + axis]``, flags "begins before" ``[4 + axis]`` and "ends beyond" ``[6 + axis]``
Rects = list[np.ndarray]


def once(r: Rects) -> Rects:
    """Each rectangle once."""
    if len(r[0]) < 2:
        return r
    if any(c.dtype.kind == "O" for c in r[:4]):
        rows = pd.DataFrame(dict(enumerate(r))).duplicated().to_numpy()
        return [c[~rows] for c in r]
    flags = r[4] | r[5].astype(np.uint8) << 1 | r[6].astype(np.uint8) << 2 | r[7].astype(np.uint8) << 3
    order = np.lexsort((flags, *r[:4]))
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for c in (flags, *r[:4]):
        c = c[order]
        fresh[1:] |= c[1:] != c[:-1]
    keep = order[fresh]
    return [c[keep] for c in r]


def clip(r: Rects, axis: int, cut, side: int) -> Rects:
    """The rectangles of the tile on one side of ``cut`` (0: below it, 1: from it on), clipped."""
    low, high, before, beyond = axis, 2 + axis, 4 + axis, 6 + axis
    keep = np.flatnonzero(r[before] | (r[low] < cut) if side == 0 else r[beyond] | (r[high] >= cut))
    part = [c[keep] for c in r]
    if side == 0:
        part[beyond] |= part[high] >= cut
        part[high][part[beyond]] = cut
    else:
        part[before] |= part[low] < cut
        part[low][part[before]] = cut
    return part


def covering(r: Rects) -> np.ndarray:
    """Which rectangles cover the tile."""
    return r[4] & r[5] & r[6] & r[7]


def covered(r: Rects) -> bool:
    return bool(covering(r).any())


def edges(r: Rects, axis: int) -> np.ndarray:
    """The coordinates of the edges inside the tile, with repetition."""
    return np.concatenate([r[axis][~r[4 + axis]], r[2 + axis][~r[6 + axis]]])


def _weight(r: Rects) -> int:
    return 0 if covered(r) else int(4 * len(r[0]) - sum(map(np.count_nonzero, r[4:])))


def best_cut(r: Rects):
    """``axis, cut, children``: of both axes' median edges the one that leaves fewer edges in uncovered tiles; None if there is none."""
    best = None
    for axis in (0, 1):
        at = np.sort(edges(r, axis))
        if not len(at) or at[0] == at[-1]:
            continue
        cut = at[len(at) // 2]
        if cut == at[0]:
            cut = at[np.searchsorted(at, cut, "right")]
        children = [once(clip(r, axis, cut, side)) for side in (0, 1)]
        weight = sum(map(_weight, children))
        if best is None or weight < best[0]:
            best = weight, axis, cut, children
    return best and best[1:]


class TileTree:
    """Tiles with about ``rows`` rectangles each, cut by a sample; ``nodes``: ``axis, cut, low child, high child`` or ``-1, leaf``."""

    def __init__(self, sample: Rects, rows: int):
        self.nodes, self.leaves = [], 0
        most = 64 + 8 * len(sample[0]) // max(1, rows)
        waiting = deque([(once(sample), None, 0)])
        while waiting:
            r, parent, side = waiting.popleft()  # breadth first, so that ``most`` cuts evenly
            if parent is not None:
                self.nodes[parent][2 + side] = len(self.nodes)
            dead = covered(r)
            found = best_cut(r) if len(r[0]) > rows and len(self.nodes) < 2 * most and not dead else None
            if found is None:
                self.nodes.append([-1, -1 if dead else self.leaves, 0, 0])
                self.leaves += not dead
                continue
            axis, cut, children = found
            waiting += [(child, len(self.nodes), side) for side, child in enumerate(children)]
            self.nodes.append([axis, cut, 0, 0])

    def cut(self, r: Rects):
        """``leaf, rectangles`` of every uncovered tile that ``r`` touches; of a tile that one of them covers, only that one."""
        waiting = [(0, once(r))]
        while waiting:
            node, part = waiting.pop()
            axis, cut, *children = self.nodes[node]
            if not len(part[0]) or (axis < 0 and cut < 0):
                continue
            if len(part[0]) > 1 and (all_over := covering(part)).any():
                k = int(all_over.argmax())
                part = [c[k:k + 1] for c in part]
            if axis < 0:
                yield cut, once(part)
            else:
                waiting += [(child, clip(part, axis, cut, side)) for side, child in enumerate(children)]


def whole(pdf: pd.DataFrame) -> Rects:
    """Rectangles ``x1, y1, x2, y2`` in the tile that is the plane."""
    return [pdf[c].to_numpy() for c in COLS[:4]] + [np.zeros(len(pdf), bool) for _ in COLS[4:]]


def tile_vertices(r: Rects, collinear: bool, cells: int = CELLS):
    """``x, y`` arrays of the vertices that a tile owns; large tiles are cut further."""
    waiting = [once(r)]
    while waiting:
        part = waiting.pop()
        if covered(part):
            continue
        xs, ys = (np.unique(edges(part, axis)) for axis in (0, 1))
        if not len(xs) or not len(ys):
            continue
        if len(xs) * len(ys) > cells:
            waiting += best_cut(part)[2]
        else:
            yield _swept(part, xs, ys, collinear)


def _swept(r: Rects, xs: np.ndarray, ys: np.ndarray, collinear: bool) -> tuple[np.ndarray, np.ndarray]:
    """The coverage of the cells between edge lines, and the corners it turns at."""
    spans = []
    for axis, at in enumerate((xs, ys)):
        first = np.where(r[4 + axis], 0, np.searchsorted(at, r[axis]) + 1)
        last = np.where(r[6 + axis], len(at) + 1, np.searchsorted(at, r[2 + axis]) + 1)
        spans.append((first, last))
    (x0, x1), (y0, y1) = spans
    shape = len(xs) + 2, len(ys) + 2
    change = np.zeros(shape, np.int64)
    for i, j, step in ((x0, y0, 1), (x1, y0, -1), (x0, y1, -1), (x1, y1, 1)):
        np.add.at(change, (i, j), step)
    full = (change.cumsum(axis=0).cumsum(axis=1) > 0)[:-1, :-1]
    sw, se, nw, ne = full[:-1, :-1], full[1:, :-1], full[:-1, 1:], full[1:, 1:]
    quadrants = sw.astype(np.int8) + se + nw + ne
    keep = (quadrants == 1) | (quadrants == 3) | ((quadrants == 2) & (ne == sw))
    if collinear:
        corner = np.zeros(keep.shape, bool)
        for i, hidden_x in ((x0, r[4]), (x1, r[6])):
            for j, hidden_y in ((y0, r[5]), (y1, r[7])):
                seen = ~(hidden_x | hidden_y)
                corner[i[seen] - 1, j[seen] - 1] = True
        keep |= (quadrants == 2) & (ne != sw) & corner
    i, j = np.nonzero(keep)
    return xs[i], ys[j]
