"""Geometry derived from the driver's tables.

The tables hold no geometry, so integer coordinates are derived from
columns (cents and scaled keys): exact in Spark and DuckDB alike, no float
ties.  Each view is one SELECT list over one base table; the same text
builds the Spark DataFrame and the DuckDB CTE of the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# view name -> (base table, select expressions)
VIEWS: dict[str, tuple[str, list[str]]] = {
    # order points: x by customer, y by total price in cents
    "pts": ("orders", [
        "o_orderkey AS id",
        "cast(o_custkey AS bigint) * 30000 AS x",
        "cast(round(o_totalprice * 100) AS bigint) AS y",
    ]),
    # the same points with a group key (order priority)
    "ptsg": ("orders", [
        "o_orderkey AS id",
        "o_orderpriority AS grp",
        "cast(o_custkey AS bigint) * 30000 AS x",
        "cast(round(o_totalprice * 100) AS bigint) AS y",
    ]),
    # order points scattered evenly over a square (pair queries)
    "iso": ("orders", [
        "o_orderkey AS id",
        "(o_orderkey * 7919 + o_custkey * 104729) % 1000003 AS x",
        "(cast(round(o_totalprice * 100) AS bigint) * 31) % 1000003 AS y",
    ]),
    # supplier windows in the space of pts
    "win": ("supplier", [
        "s_suppkey AS id",
        "cast(s_nationkey AS bigint) * 1800000 AS x1",
        "cast(round(s_acctbal * 100) AS bigint) * 40 AS y1",
        "cast(s_nationkey AS bigint) * 1800000 + 1000000 + (s_suppkey % 50) * 40000 AS x2",
        "cast(round(s_acctbal * 100) AS bigint) * 40 + 2000000 AS y2",
    ]),
    # part rectangles, much overlap
    "rects": ("part", [
        "p_partkey AS id",
        "cast(p_size AS bigint) * 100 AS x1",
        "cast(round(p_retailprice * 100) AS bigint) AS y1",
        "cast(p_size AS bigint) * 100 + 40 + p_partkey % 90 AS x2",
        "cast(round(p_retailprice * 100) AS bigint) + 60 + p_partkey % 70 AS y2",
    ]),
    # pts moved far beyond what a double can hold exactly; a group key, with
    # null among them, of neighbouring bigints that a double cannot tell apart
    "far": ("orders", [
        "o_orderkey AS id",
        "CASE WHEN o_orderkey % 3 < 2 THEN cast(9007199254740992 AS bigint) + o_orderkey % 3 END AS grp",
        "(o_orderkey * 7919 + o_custkey * 104729) % 1000003 + cast(1700000000000000000 AS bigint) AS x",
        "(cast(round(o_totalprice * 100) AS bigint) * 31) % 1000003 - cast(1700000000000000000 AS bigint) AS y",
    ]),
    # a lattice with many ties, and several rows at most places
    "lattice": ("lineitem", [
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey % 23 * 3 AS x",
        "cast(l_partkey % 29 AS bigint) * 3 AS y",
    ]),
    # windows of very different sizes: tiny, small, and a few that span all of iso
    "mixwin": ("part", [
        "p_partkey AS id",
        "(p_partkey * 6151) % 1000003 AS x1",
        "(p_partkey * 12289) % 1000003 AS y1",
        "(p_partkey * 6151) % 1000003 + CASE WHEN p_partkey % 50 = 0 THEN 600000 WHEN p_partkey % 3 = 0 THEN 20000 ELSE 900 END AS x2",
        "(p_partkey * 12289) % 1000003 + CASE WHEN p_partkey % 50 = 0 THEN 600000 WHEN p_partkey % 3 = 0 THEN 20000 ELSE 900 END AS y2",
    ]),
    # customer boxes in the space of pts; corners stored in reversed order
    "cbox": ("customer", [
        "c_custkey AS id",
        "cast(c_nationkey AS bigint) * 1800000 + 1500000 + (c_custkey % 7) * 100000 AS x1",
        "cast(round(c_acctbal * 100) AS bigint) * 40 + 2500000 AS y1",
        "cast(c_nationkey AS bigint) * 1800000 + 500000 AS x2",
        "cast(round(c_acctbal * 100) AS bigint) * 40 AS y2",
    ]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named geometry view as a DataFrame (column-pruned parquet scan)."""
    base, exprs = VIEWS[name]
    return table(spark, sf_dir, base).selectExpr(*exprs)


def cte(*names: str) -> str:
    """``WITH`` clause defining the named views over the base tables (DuckDB)."""
    parts = []
    for n in names:
        base, exprs = VIEWS[n]
        parts.append(f"{n} AS (SELECT {', '.join(exprs)} FROM {base})")
    return "WITH " + ",\n".join(parts) + "\n"
