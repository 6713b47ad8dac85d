"""Physical plan checks: pushdown, no nested-loop / cartesian joins on grid paths."""

from conftest import SF01
from planekit.plans.catalog import QUERIES


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_range_pushdown_on_stored_columns(spark):
    p = _plan(QUERIES["range_query_raw"](spark, SF01))
    assert "PushedFilters" in p and "GreaterThanOrEqual(o_totalprice" in p
    assert "LessThanOrEqual(o_custkey,600)" in p


def test_range_reads_only_needed_columns(spark):
    p = _plan(QUERIES["range_query"](spark, SF01))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in p


def test_grid_joins_are_equi_joins(spark):
    for name in ("join_point_rect", "join_rect_rect", "join_mixed", "collect_matches",
                 "closest_pairs"):
        p = _plan(QUERIES[name](spark, SF01))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        assert "HashJoin" in p or "SortMergeJoin" in p, name


def test_no_single_partition_funnel_in_joins(spark):
    for name in ("spatial_count_point", "collect_matches", "rect_union_vertices"):
        p = _plan(QUERIES[name](spark, SF01))
        assert "SinglePartition" not in p, name


def test_broadcast_guard_falls_back_to_merge_join(spark):
    from planekit.plans.catalog import QUERIES as Q
    small = Q["join_rect_rect"](spark, SF01)
    assert "BroadcastHashJoin" in _plan(small)
    expect = sorted(small.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = Q["join_rect_rect"](spark, SF01)
        p = _plan(big)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        assert sorted(big.collect()) == expect
        pts = Q["join_point_rect"](spark, SF01)
        assert "SortMergeJoin" in _plan(pts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
