"""Broadcast only behind a proven size bound; sort-merge beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


FIXED_WIDTH = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp",
               "timestamp_ntz", "decimal"}


def threshold_bytes(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: broadcasting off)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")).strip().lower()
    num = raw.rstrip("abcdefghijklmnopqrstuvwxyz")
    unit = raw[len(num):] or "b"
    try:
        return int(float(num) * _UNITS.get(unit, 1))
    except ValueError:
        return -1


def size_guard(df: DataFrame, max_rows: int, force_hint: bool = True) -> DataFrame:
    """Broadcast ``df`` only if ``max_rows`` (a proven upper bound) fits the threshold.

    The bound comes from an exact row count (a statistics job) times a fixed
    replication per row, and holds for fixed-width columns only (UnsafeRow:
    8-byte header + 8 bytes per field, doubled for the hash relation): a side
    with strings or other columns of unknown width is never broadcast here.
    Beyond the bound the join is forced to a sort-merge join, which spills
    instead of failing, and AQE can split its skewed partitions.
    """
    limit = threshold_bytes(df.sparkSession)
    row_bytes = 2 * (8 + 8 * len(df.columns))
    fixed = all(t.split("(")[0] in FIXED_WIDTH for _, t in df.dtypes)
    if fixed and 0 < max_rows * row_bytes <= limit:
        return F.broadcast(df)
    return df.hint("merge") if force_hint else df


#: rows of a side, with its copies, that a task of a spatial join takes at most about
ROWS_PER_TASK = 50_000


def dealt_by(left: DataFrame, right: DataFrame, max_rows: int, left_keys: list[str], right_keys: list[str],
             guarded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt by their keys to a number of tasks that follows ``max_rows``, where none is broadcast.

    A pair of cells costs as many comparisons as its rows' product, far more than
    its bytes say, so adaptive execution, which goes by bytes, must not join
    partitions together.  ``guarded`` is the side that ``size_guard`` returned.
    """
    spark = left.sparkSession
    row_bytes = 2 * (8 + 8 * len(guarded.columns))
    small = all(t.split("(")[0] in FIXED_WIDTH for _, t in guarded.dtypes) and max_rows * row_bytes <= threshold_bytes(spark)
    if small or left.isStreaming or right.isStreaming:
        return left, right
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4096, -(-max_rows // ROWS_PER_TASK)))
    return left.repartition(n, *left_keys), right.repartition(n, *right_keys)
