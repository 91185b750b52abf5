"""Properties of the physical plans that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from hazeline.operators import joins as J
from hazeline.operators import ranking as R
from hazeline.operators.quantiles import exact_quantiles
from hazeline.queries import REGISTRY

SF = "/root/testdata/sf0.001"
EAGER = {"sink_roundtrip", "model_glm_categorical", "proj_drop_null_columns"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert word not in text
    # All rows in one task only behind an aggregate that has combined them first.
    for line in re.split(r"\n", text):
        if "Exchange SinglePartition" in line:
            after = text[text.index(line) + len(line):]
            assert "partial_" in after.split("\n")[1]


def test_scans_read_only_what_is_used(spark):
    text = plan(REGISTRY["filter_allow_list"](spark, SF))
    assert "PushedFilters: [In(event_type" in text.replace("IsNotNull(event_type), ", "")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


def test_rank_filters_limit_groups_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), "id")
    for limited in (R.top_k(df, ["g"], "id", 3, []), R.keep_first(df, ["g"], ["id"])):
        text = plan(limited)
        assert re.search(r"Final.*Exchange hashpartitioning.*Partial", text, re.S)
        assert text.count("WindowGroupLimit") == 2


def test_source_merge_is_one_hash_aggregate(spark):
    a = spark.range(5).selectExpr("id k", "id * 1.5D x", "id t")
    b = spark.range(5).selectExpr("id k", "id * 2.5D y", "id t")
    text = plan(J.merge_sources([a, b], ["k"], ["x", "y"], ["t"]))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.count("Exchange") == 1 and "Join" not in text


def test_null_safe_full_join_is_an_equi_join(spark):
    a, b = spark.range(5).selectExpr("id k", "id a"), spark.range(5).selectExpr("id k", "id b")
    assert "SortMergeJoin" in plan(J.null_safe_join(a, b, ["k"], "full"))


def test_group_values_reach_rows_without_a_broadcast_by_guess(spark):
    """With the broadcast threshold at 1 KB both sides of the join are plain exchanges, which Spark can split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
    try:
        df = spark.range(1000).selectExpr("id % 3 as g", "cast(id as double) as v")
        for made in (R.sigma_outliers(df, ["g"], "v"), R.group_extreme(df, ["g"], "v")):
            text = plan(made)
            assert "Window" not in text and text.count("Aggregate") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranges_and_centres_of_any_number_meet_by_key(spark):
    """Without broadcasts there are equality joins only, on the key and year or on the cell."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("join_range_anti_many", "year"), ("join_radius_many", "__cell"), ("join_range_anti", "year")):
            text = plan(REGISTRY[name](spark, SF))
            assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text and key in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_of_long_rows_is_a_hash_aggregate(spark):
    text = plan(REGISTRY["pipe_harmonise"](spark, SF))
    assert "SortAggregate" not in text and text.count("Scan parquet") == 1


def test_wide_tables_have_no_branch_per_column(spark):
    names = [f"c{i}" for i in range(500)]
    long = spark.range(10).selectExpr("id as k", "concat('c', id) as n", "id * 1.0D as v")
    text = plan(J.fold_full_outer(long, ["k"], "n", "v", names))
    assert "CASE WHEN" not in text and "pivotfirst" in text.lower() and "SortAggregate" not in text


def test_quantiles_never_sort_a_groups_values(spark):
    """Each pass joins rows with the few picked leading bits and counts by the next ones; windows are over counts."""
    df = spark.range(5000).selectExpr("id % 3 as k", "cast(id as double) as v")
    text = plan(exact_quantiles(df, ["k"], "v", (0.5,), ("m",)))
    assert "percentile" not in text and text.count("Range (0, 5000") == 1
    assert re.search(r"Window.*HashAggregate.*HashAggregate.*Join", text, re.S)


def test_rounding_never_saturates(spark):
    from hazeline.queries.base import r

    row = spark.range(1).select(r(F.lit(1e17), 4).alias("a"), r(F.lit(5e13), 6).alias("b"), r(F.lit(-2.5), 0).alias("c")).first()
    assert (row.a, row.b, row.c) == (1e17, 5e13, -3.0)
