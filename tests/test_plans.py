"""Shape of the physical plans."""

import pytest

from tidemark.catalog import QUERIES
from tidemark.operators.incremental import between_marks
from tidemark.operators.inventory import newest_per_path

DATA = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"refresh_twice"}))
def test_no_pairwise_joins_and_no_python_workers(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


@pytest.mark.parametrize("name", ["hier_facets", "path_filter", "field_mapping", "numbered_metas", "child_ids",
                                  "multi_value_join", "index_record", "export_mime", "stage_chain"])
def test_row_local_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "incremental_batch")
    assert "GreaterThan(o_orderkey,500)" in text and "Not(EqualTo(o_orderstatus,P))" in text
    assert "o_totalprice" not in text.split("ReadSchema")[1]
    assert "TakeOrderedAndProject" in text
    assert "LessThanOrEqual(l_shipdate" in plan(spark, "snapshot_diff")


def test_explode_does_not_compute_its_map_twice(spark):
    assert plan(spark, "flat_metas").count("from_json") <= 3


def test_page_is_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan(spark, "first_page")
    assert "Exchange rangepartitioning" not in plan(spark, "first_page")


def test_both_marks_of_a_batch_reach_the_scan(spark):
    batch = between_marks(spark.read.parquet(f"{DATA}/orders.parquet"), "o_orderkey", 500, 900, ["o_orderkey", "o_orderstatus"])
    text = batch._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,500)" in text and "LessThanOrEqual(o_orderkey,900)" in text
    assert text.count("FileScan") == 1


def test_newest_rows_are_hashed(spark):
    rows = spark.range(5).selectExpr("cast(id as string) path", "id last_modified_ms", "id size", "true readable")
    text = newest_per_path(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_long_rows_of_a_mapping_table_are_never_broadcast(spark):
    text = plan(spark, "mapping_table")
    assert "BroadcastHashJoin [_id" not in text and "SortMergeJoin [_id" in text


def test_metas_of_a_small_file_are_made_by_many_tasks(spark):
    assert "RoundRobinPartitioning" in plan(spark, "flat_metas")


def test_attachments_of_a_small_file_are_made_by_many_tasks(spark):
    assert "RoundRobinPartitioning" in plan(spark, "attachment_rows")
