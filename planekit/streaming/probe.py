"""Streaming probes against static windows.

Range queries and spatial joins are stateless per probe row, so the batch
operators apply unchanged to a streaming probe DataFrame (a stream-static
join): the grid's cell size and levels come from the static window side.
These helpers only add the sink wiring with a checkpoint location, so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from planekit.operators.join import spatial_join
from planekit.operators.range import range_query


def range_stream(points: DataFrame, window, x: str = "x", y: str = "y") -> DataFrame:
    """Streaming range query (closed window)."""
    return range_query(points, window, x, y)


def join_stream(probes: DataFrame, windows: DataFrame, predicate: str = "within", **kw) -> DataFrame:
    """Streaming pairs ``(probe_id, window_id)`` against a static window table."""
    if windows.isStreaming:
        raise ValueError("windows must be a static DataFrame")
    return spatial_join(probes, windows, predicate, **kw)


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True) -> StreamingQuery:
    """Append the stream to ``path`` (exactly-once file sink, checkpointed)."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(path)
