"""Counting the windows that each probe meets, without listing the pairs.

With closed borders a window meets a probe on an axis iff it begins at or before the
probe's end and does not end before the probe's begin; as a window that ended also
began, that is a difference of two comparisons.  The product over both axes has
four terms: each counts, with a sign, the corners of windows that lie before a corner
of the probe on both axes (dominance counting).  Open borders, for points, swap which
comparison includes equality, and leave out windows without area.

Up to ``LOCAL`` windows (a checked count) are sent to the tasks, where every batch of
probes is counted at once.  Beyond it the plane is cut into strips by x and strips by y
(borders from a bounded sample, at most ``STRIPS``): what lies before a probe's
corner is the table of whole strips, plus the rest of its own x-strip, plus the
rest of its own y-strip.  Strips are groups of a shuffle; points with equal
coordinates may be dealt to different strips, and a strip with many probes is cut into
slices that each hold its corners.  The sample decides where strips lie, never the
counts.  Shuffled rows are proportional to probes and windows, not to matches.

Ids must be unique here; ``spatial_count`` takes care of the others.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.operators import _rank_local
from planekit.operators._rank_local import Dominance, borders, strip_of

cloudpickle.register_pickle_by_value(_rank_local)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: windows that every task may hold (four coordinates each: 2 MB)
LOCAL = 1 << 16
#: strips per axis, at most; the table of whole strips has STRIPS**2 numbers per corner
STRIPS = 512
#: corners, or probes, that a group of the shuffle holds at most about
GROUP = 1 << 18
SAMPLE = 100_000

WINDOW, PROBE = ["_wx1", "_wy1", "_wx2", "_wy2"], ["_px1", "_py1", "_px2", "_py2"]
#: which corner of the window (0: begin, 1: end, per axis)
CORNERS = ((0, 0), (0, 1), (1, 0), (1, 1))
COLUMN, ROW = 0, 1


def countable(df: DataFrame, cols) -> bool:
    """Integer and floating coordinates: those that numpy compares exactly."""
    types = dict(df.dtypes)
    kinds = {types[c] for c in cols}
    return len(kinds) == 1 and kinds <= {"bigint", "double"}


def _corners(w: pd.DataFrame, corner) -> tuple[np.ndarray, np.ndarray]:
    return w[WINDOW[2 * corner[0]]].to_numpy(), w[WINDOW[1 + 2 * corner[1]]].to_numpy()


@dataclass
class Asks:
    """Which corner of the probe is compared with a corner of the window, and whether equality counts."""
    closed: bool

    def of(self, p: pd.DataFrame, corner) -> tuple[np.ndarray, np.ndarray, bool, bool]:
        x, y = p[PROBE[2 - 2 * corner[0]]].to_numpy(), p[PROBE[3 - 2 * corner[1]]].to_numpy()
        return x, y, self.closed == (corner[0] == 0), self.closed == (corner[1] == 0)


def sign(corner) -> int:
    return 1 if corner[0] == corner[1] else -1


def _count_in_tasks(probes: DataFrame, windows: DataFrame, asks: Asks) -> DataFrame:
    """``_pid, n``: the windows, few enough, go to every task."""
    few = windows.toPandas()

    def count(batches):
        known = [Dominance(*_corners(few, c)) for c in CORNERS]
        for p in batches:
            n = np.zeros(len(p), np.int64)
            for c, points in zip(CORNERS, known):
                n += sign(c) * points.count(*asks.of(p, c))
            yield pd.DataFrame({"_pid": p["_pid"], "n": n})

    return probes.mapInPandas(count, "_pid string, n long")


class Strips:
    """Where the corners of one kind are cut, per axis: borders and strips of points and of probes."""

    def __init__(self, sample: pd.DataFrame, corner, strips: int):
        x, y = _corners(sample, corner)
        self.by_x, self.by_y = borders(x, y, strips), borders(y, x, strips)

    def of_points(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return strip_of(*self.by_x, x, y), strip_of(*self.by_y, y, x)

    def of_probes(self, x, y, x_closed: bool, y_closed: bool) -> tuple[np.ndarray, np.ndarray]:
        return (np.searchsorted(self.by_x[0], x, "right" if x_closed else "left"),
                np.searchsorted(self.by_y[0], y, "right" if y_closed else "left"))


def _keys(k: int, axis: int, strip: np.ndarray) -> np.ndarray:
    return (np.asarray(strip, np.int64) * 2 + axis) * len(CORNERS) + k


def _count_in_strips(probes: DataFrame, windows: DataFrame, asks: Asks, n_windows: int, strips: int, group: int,
                     sample: int) -> DataFrame:
    """``_pid, n``: corners and probes meet in x-strips and in y-strips."""
    strips = max(2, min(strips, -(-n_windows // group)))
    some = windows.sample(False, min(1.0, sample / n_windows), seed=11).toPandas()
    cuts = [Strips(some, c, strips) for c in CORNERS]

    def tally(batches):
        for w in batches:
            for k, c in enumerate(CORNERS):
                a, b = cuts[k].of_points(*_corners(w, c))
                at, n = np.unique(a * strips + b, return_counts=True)
                yield pd.DataFrame({"k": np.full(len(at), k), "cell": at, "n": n})

    def load(batches):
        for p in batches:
            for k, c in enumerate(CORNERS):
                a, b = cuts[k].of_probes(*asks.of(p, c))
                for axis, strip in ((COLUMN, a), (ROW, b[a > 0])):
                    at, n = np.unique(_keys(k, axis, strip), return_counts=True)
                    yield pd.DataFrame({"key": at, "n": n})

    # both at most len(CORNERS) times strips or strips**2 rows
    cells = windows.mapInPandas(tally, "k long, cell long, n long").groupBy("k", "cell").agg(F.sum("n").alias("n")).toPandas()
    loads = probes.mapInPandas(load, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((len(CORNERS), strips + 1, strips + 1), np.int64)
    table[cells["k"], cells["cell"] // strips + 1, cells["cell"] % strips + 1] = cells["n"]
    before = probes.sparkSession.sparkContext.broadcast(table.cumsum(axis=1).cumsum(axis=2))
    slices = np.ones(2 * len(CORNERS) * strips, np.int64)
    slices[loads["key"]] = -(-loads["n"].to_numpy() // group)
    ctype = dict(windows.dtypes)[WINDOW[0]]
    schema = f"key long, slice long, asks boolean, a {ctype}, b {ctype}, _pid string"
    dtype = np.int64 if ctype == "bigint" else np.float64

    def rows(key, piece, asking, a, b, pid):
        return pd.DataFrame({"key": key, "slice": piece, "asks": asking, "a": np.asarray(a, dtype),
                             "b": np.asarray(b, dtype), "_pid": pid})

    def deal_corners(batches):
        for w in batches:
            for k, c in enumerate(CORNERS):
                x, y = _corners(w, c)
                sx, sy = cuts[k].of_points(x, y)
                for key, a in ((_keys(k, COLUMN, sx), x), (_keys(k, ROW, sy), sx)):
                    times = slices[key]
                    piece = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    yield rows(np.repeat(key, times), piece, False, np.repeat(a, times), np.repeat(y, times), None)

    def deal_probes(batches):
        for p in batches:
            for k, c in enumerate(CORNERS):
                x, y, x_closed, y_closed = asks.of(p, c)
                sx, sy = cuts[k].of_probes(x, y, x_closed, y_closed)
                own = pd.util.hash_array(p["_pid"].to_numpy(), categorize=False).astype(np.int64) & ((1 << 62) - 1)
                later = sx > 0
                for axis, strip, a, keep in ((COLUMN, sx, x, slice(None)), (ROW, sy, sx, later)):
                    key = _keys(k, axis, strip[keep])
                    yield rows(key, own[keep] % slices[key], True, a[keep], y[keep], p["_pid"].to_numpy()[keep])

    def whole_strips(batches):
        for p in batches:
            n = np.zeros(len(p), np.int64)
            for k, c in enumerate(CORNERS):
                n += sign(c) * before.value[k][cuts[k].of_probes(*asks.of(p, c))]
            yield pd.DataFrame({"_pid": p["_pid"], "n": n})

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        key = int(pdf["key"].iloc[0])
        c, axis = CORNERS[key % len(CORNERS)], key // len(CORNERS) % 2
        has, q = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        _, _, x_closed, y_closed = asks.of(pd.DataFrame(columns=PROBE), c)
        found = Dominance(has["a"].to_numpy(), has["b"].to_numpy()).count(
            q["a"].to_numpy(), q["b"].to_numpy(), x_closed and axis == COLUMN, y_closed)
        return pd.DataFrame({"_pid": q["_pid"], "n": sign(c) * found})

    dealt = windows.mapInPandas(deal_corners, schema).unionByName(probes.mapInPandas(deal_probes, schema))
    groups = int(slices.sum())
    parts = dealt.repartition(max(1, min(groups, 10_000)), "key", "slice").groupBy("key", "slice").applyInPandas(meet, "_pid string, n long")
    return parts.unionByName(probes.mapInPandas(whole_strips, "_pid string, n long")).groupBy("_pid").agg(F.sum("n").alias("n"))


def count_meeting(probes: DataFrame, windows: DataFrame, closed: bool = True, local: int = LOCAL, strips: int = STRIPS,
                  group: int = GROUP, sample: int = SAMPLE) -> DataFrame:
    """``_pid, n`` (zeros kept) of every row of ``probes`` (``_pid`` text, ``PROBE``); ``windows``: ``WINDOW``.

    Coordinates are normalised, present and of one countable type on both sides.
    """
    asks = Asks(closed)
    if not closed:
        windows = windows.where((F.col("_wx1") < F.col("_wx2")) & (F.col("_wy1") < F.col("_wy2")))
    probes, windows = probes.select("_pid", *PROBE), windows.select(*WINDOW)
    n = windows.count()
    if n <= local:
        return _count_in_tasks(probes, windows, asks)
    return _count_in_strips(probes, windows, asks, n, strips, group, sample)
