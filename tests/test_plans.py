"""Physical plans: pushdown, pruning, and no work in a single task."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import selection, spatial
from tallyloom.plans import ordering, timejoin
from tallyloom.plans.scratch import run_dir
from tallyloom.queries import QUERIES
from tallyloom.session import Tables
from tallyloom.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["s3_parquet_scan"](spark, small))
    assert "GreaterThan(l_quantity,40.0)" in text and "GreaterThanOrEqual(l_shipdate" in text
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_orderkey" in schema and "l_comment" not in schema and "l_tax" not in schema


def test_partition_filter(spark, small):
    text = plan(QUERIES["s4_partitioned_scan"](spark, small))
    assert "PartitionFilters: [" in text and "day" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_media_payload_is_not_read(spark, small):
    path = run_dir(spark, "media-test")
    files.write_parquet(Tables(spark, small).pages.select("page_id", F.struct(F.encode("html", "UTF-8").alias("bytes")).alias("image")), path)
    assert "bytes" not in plan(spark.read.parquet(path).select("page_id")).split("ReadSchema")[1]


def test_top_k_is_cut_before_the_shuffle(spark, small):
    t = Tables(spark, small)
    text = plan(selection.top_k_per_group(t.orders, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3))
    assert text.count("WindowGroupLimit") == 2


def test_positional_slice_is_a_top_k(spark, small):
    t = Tables(spark, small)
    text = plan(selection.positional_slice(t.orders, [F.col("o_orderkey")], 5, 9, 0, 2))
    assert "TakeOrderedAndProject" in text and "Window" not in text


def test_best_per_group_combines_first(spark, small):
    t = Tables(spark, small)
    text = plan(selection.best_per_group(t.events, ["user_id"], [F.col("ts")]))
    assert "partial_max_by" in text and "Window" not in text


def test_global_order_has_no_single_task_over_rows(spark, small):
    t = Tables(spark, small)
    text = plan(ordering.row_numbers(t.orders, "o_totalprice", "o_orderkey"))
    # The only single partition is the prefix over cells, fed by an aggregate.
    for part in text.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part.split("\n")[1]


def test_quantiles_shuffle_few_values(spark, small):
    t = Tables(spark, small)
    text = plan(ordering.exact_quantiles(t.lineitem, "l_extendedprice", {"m": 0.5}))
    assert "percentile(" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", [
    "j5_interval_asof", "j6_point_in_time", "j7_future_target", "j11_dense_grid", "g3_area_join_all", "g4_count_by_area_and_time",
    "w4_lag_demand", "w6_cumulative_curve", "w7_decile_table", "w8_ranks_with_ties", "m1_stratified_split", "m3_scaling", "e4_roc_auc",
    "e7_threshold_sweep", "m26_lloyd_assign", "m28_distances", "m38_silhouette_squared", "x7_numeric_drift", "t3_session_activity",
])
def test_no_pairing_of_all_rows(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_time_joins_partition_by_key_and_slice(spark, small):
    t = Tables(spark, small)
    text = plan(timejoin.trailing_window(t.events, ["user_id"], "ts", 60, lambda f: {"n": F.count("*").over(f(60))}))
    assert "hashpartitioning(user_id" in text and "slice" in text.split("hashpartitioning(user_id")[1].split("\n")[0]


def test_area_join_uses_the_grid(spark, small):
    from tallyloom.queries.spatial import polygons, vector_points

    t = Tables(spark, small)
    text = plan(spatial.area_join(vector_points(t), polygons(t), "lon", "lat", 0.25))
    assert "__cx" in text and "HashJoin" in text or "SortMergeJoin" in text
