"""Headerless comma-separated text: points, rectangles, mixed shapes, match rows.

Fields are taken by position and any further fields are ignored, so the
files are read as text and split (a CSV reader with a fixed schema would
reject or drop a row with an extra field).  ``strict=True`` casts with
Spark's ANSI ``cast`` (a bad number or a missing field raises when the
column is read); ``strict=False`` uses ``try_cast`` and drops the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planekit.functions.geom import normalize_rect


def _field(parts: Column, i: int, dtype: str, strict: bool) -> Column:
    raw = F.trim(parts[i]) if strict else F.trim(F.get(parts, i))
    return raw.cast(dtype) if strict else raw.try_cast(dtype)


def _lines(spark_or_df, path: str | None) -> DataFrame:
    if isinstance(spark_or_df, DataFrame):
        return spark_or_df.select(F.col(spark_or_df.columns[0]).alias("value"))
    return spark_or_df.read.text(path)


def _not_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.contains("value", F.lit(",")) | (F.trim("value") != ""))


def _once(df: DataFrame, *cols: Column) -> DataFrame:
    """``select`` that is computed once a row.

    Every expression above a plain projection that uses its columns may get a
    copy of the whole text parsing when the optimizer merges the two; a
    generator of one row is a border it does not cross.
    """
    return df.select(F.explode(F.array(F.struct(*cols))).alias("_row")).select("_row.*")


def _parse(lines: DataFrame, names: list[str], types: list[str], strict: bool) -> DataFrame:
    parts = F.col("_parts")
    df = _once(lines.select(F.split("value", ",").alias("_parts")),
               *[_field(parts, i, t, strict).alias(n) for i, (n, t) in enumerate(zip(names, types))])
    return df if strict else df.dropna(subset=names)


def read_points(spark: SparkSession | DataFrame, path: str | None = None,
                with_id: bool = False, id_type: str = "string",
                strict: bool = True) -> DataFrame:
    """``x,y`` or ``id,x,y`` rows -> columns ``[id,] x, y`` (doubles)."""
    names = (["id"] if with_id else []) + ["x", "y"]
    types = ([id_type] if with_id else []) + ["double", "double"]
    return _parse(_not_blank(_lines(spark, path)), names, types, strict)


def read_rects(spark: SparkSession | DataFrame, path: str | None = None,
               with_id: bool = False, id_type: str = "bigint",
               strict: bool = True, normalize: bool = True) -> DataFrame:
    """``x1,y1,x2,y2`` or ``id,x1,y1,x2,y2`` rows; corners in any order."""
    names = (["id"] if with_id else []) + ["x1", "y1", "x2", "y2"]
    types = ([id_type] if with_id else []) + ["double"] * 4
    df = _parse(_not_blank(_lines(spark, path)), names, types, strict)
    return normalize_rect(df) if normalize else df


def _by_arity(lines: DataFrame) -> DataFrame:
    """Non-blank lines without trailing empty fields, which do not count towards the arity ``_n``."""
    lines = _not_blank(_lines(lines, None)).select(F.rtrim("value", F.lit(",")).alias("value"))
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    return lines.withColumn("_n", commas + 1)


def parse_shapes(lines: DataFrame, strict: bool = True,
                 coord_type: str = "double") -> tuple[DataFrame, DataFrame]:
    """Mixed probe rows: 5 fields = ``id,x1,y1,x2,y2``, 3 = ``id,x,y``, others match nothing.

    Returns ``(points, rects)``, each a filter of ``lines``: reading both
    scans it twice.  ``parse_probes`` gives both kinds in one frame.
    """
    parts = _by_arity(lines)
    pts = _parse(parts.where("_n = 3"), ["id", "x", "y"], ["bigint", coord_type, coord_type], strict)
    rct = _parse(parts.where("_n = 5"), ["id", "x1", "y1", "x2", "y2"],
                 ["bigint"] + [coord_type] * 4, strict)
    return pts, normalize_rect(rct)


def parse_probes(lines: DataFrame, strict: bool = True, coord_type: str = "double") -> DataFrame:
    """The same rows as one frame ``id, x1, y1, x2, y2, is_point``, from one scan.

    A point's corners are the point; see ``spatial_join_shapes``.
    """
    rows = _by_arity(lines).where("_n in (3, 5)")
    # the second corner of a point is its first: "id,x,y" reads as "id,x,y,x,y"
    twice = F.concat_ws(",", "value", F.substring_index("value", ",", -2))
    is_point = F.col("_n") == 3
    parts = F.split(F.when(is_point, twice).otherwise(F.col("value")), ",")
    names = ["id", "x1", "y1", "x2", "y2"]
    fields = [_field(F.col("_parts"), i, t, strict).alias(n)
              for i, (n, t) in enumerate(zip(names, ["bigint"] + [coord_type] * 4))]
    out = _once(rows.select(parts.alias("_parts"), is_point.alias("is_point")), *fields, F.col("is_point"))
    return normalize_rect(out if strict else out.dropna(subset=names))


def read_shapes(spark: SparkSession, path: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    return parse_shapes(spark.read.text(path), strict=strict)


def read_probes(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_probes(spark.read.text(path), strict=strict)


def read_matches(spark: SparkSession | DataFrame, path: str | None = None) -> DataFrame:
    """``id,m1,m2,...`` rows -> ``probe_id bigint, matches array<bigint>``."""
    parts = F.col("_parts")
    lines = _not_blank(_lines(spark, path)).select(F.split("value", ",").alias("_parts"))
    return _once(
        lines, F.trim(parts[0]).cast("bigint").alias("probe_id"),
        # the cast leaves out spaces around a number, as trim would, in one compiled loop
        F.slice(parts, 2, F.size(parts) - 1).cast("array<bigint>").alias("matches"),
    )


def take_window(spark: SparkSession | DataFrame, path: str | None = None) -> tuple:
    """The query window: the first row of a rectangle file (file order)."""
    r = read_rects(spark, path).first()
    if r is None:
        raise ValueError("empty window file")
    return (r["x1"], r["y1"], r["x2"], r["y2"])
