"""Points stored in the order of a Hilbert curve, so that range queries skip data on both axes.

Row order by x alone lets a scan skip on x only: a row group then spans all of y.
Along a Hilbert curve neighbouring rows are neighbours in the plane, so every row
group covers a small, roughly square patch, and the minimum and maximum that Parquet
keeps of both coordinates let a window leave out all but the patches it touches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planekit.functions.geom import finite_coords

#: bits per axis of the curve's grid
BITS = 16
ROWS_PER_FILE = 1_000_000


def hilbert_key(cx: Column, cy: Column, bits: int = BITS) -> Column:
    """The place along the Hilbert curve of grid cell ``(cx, cy)``, both in ``[0, 2**bits)``.

    From the coarsest bit down: the quadrant (in the curve's order) adds two bits to
    the key, and the rest of the way is seen in that quadrant's own orientation
    (swapped in the first and last, and turned round in the last).
    """
    def step(state: Column, bit: Column) -> Column:
        x, y = state["x"], state["y"]
        qx, qy = (F.call_function("shiftright", v, bit).bitwiseAND(F.lit(1)) for v in (x, y))
        quadrant = (3 * qx).bitwiseXOR(qy)
        turned, swapped = (qx == 1) & (qy == 0), qy == 0
        full = F.lit((1 << bits) - 1)
        tx, ty = F.when(turned, full - x).otherwise(x), F.when(turned, full - y).otherwise(y)
        return F.struct(F.when(swapped, ty).otherwise(tx).alias("x"), F.when(swapped, tx).otherwise(ty).alias("y"),
                        (state["key"] * 4 + quadrant).alias("key"))

    start = F.struct(cx.cast("long").alias("x"), cy.cast("long").alias("y"), F.lit(0).cast("long").alias("key"))
    down = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(down, start, step, lambda state: state["key"])


def _cell(v: str, lo, hi, bits: int) -> Column:
    """The grid cell of a coordinate; a grid of one column where all are equal."""
    lo, hi = float(lo), float(hi)
    if not hi > lo:
        return F.lit(0).cast("long")
    # halves: the width of a range of doubles may itself overflow
    share = (F.col(v).cast("double") / 2 - lo / 2) / (hi / 2 - lo / 2)
    return F.least(F.greatest(F.floor(share * float(1 << bits)), F.lit(0)), F.lit((1 << bits) - 1)).cast("long")


def hilbert_order(points: DataFrame, x: str = "x", y: str = "y", files: int | None = None,
                  rows_per_file: int = ROWS_PER_FILE, bits: int = BITS) -> DataFrame:
    """``points`` range partitioned and sorted along the curve, ``files`` partitions.

    Rows without coordinates (null, NaN, infinite) come last.  One aggregate finds the
    bounds and the row count.
    """
    good = finite_coords(points, x, y)
    b = points.agg(F.count(F.lit(1)).alias("n"), *[f(F.when(good, F.col(c))).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in (x, y)]).first()
    files = files or max(1, math.ceil(b["n"] / rows_per_file))
    if b[f"min_{x}"] is None:
        return points.repartition(files)
    key = F.when(good, hilbert_key(_cell(x, b[f"min_{x}"], b[f"max_{x}"], bits), _cell(y, b[f"min_{y}"], b[f"max_{y}"], bits), bits))
    keyed = points.withColumn("_hilbert", F.coalesce(key, F.lit(1 << (2 * bits))))
    return keyed.repartitionByRange(files, "_hilbert").sortWithinPartitions("_hilbert").drop("_hilbert")


def write_points(points: DataFrame, path: str, x: str = "x", y: str = "y", mode: str = "errorifexists",
                 files: int | None = None, rows_per_file: int = ROWS_PER_FILE, bits: int = BITS) -> None:
    """Write ``points`` as Parquet in Hilbert order; read with ``spark.read.parquet``, query with ``range_query``."""
    hilbert_order(points, x, y, files, rows_per_file, bits).write.mode(mode).parquet(path)
