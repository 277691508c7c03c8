"""Properties of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, uplift
from ledgerlens.plans.catalog import QUERIES, registry
from ledgerlens.plans.catalog.registry import SETTINGS
from ledgerlens.sources.retail import retail_lines
from ledgerlens.sources.store import TableStore

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["customers_features", "drift_quarterly_rfm", "budget_roi_curve", "value_predict_all", "report_kpis"])
def test_no_all_pairs_joins_and_no_row_udfs(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_month_partitions_are_pruned_and_columns_cut(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    tx = store.write("tx", cleaning.clean(retail_lines(spark, SF), SETTINGS), partition_by="year_month")
    observed, _ = cleaning.temporal_split(tx, SETTINGS)
    text = plan(observed.groupBy("CustomerID").agg(F.sum("TotalPrice").alias("s")))
    assert "PartitionFilters: [isnotnull(year_month" in text
    assert "ReadSchema: struct<InvoiceDate:timestamp_ntz,CustomerID:bigint,TotalPrice:bigint>" in text


def test_ranking_windows_are_cut_into_slots(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("uplift_score"))
    text = plan(uplift.rank_by_uplift(df))
    assert "Window [row_number() windowspecdefinition(_slot#" in text
    assert "Exchange SinglePartition" not in text.split("Subquery")[0]


@pytest.mark.parametrize("name", ["matrix_value", "value_calibration", "stack_final_predictions", "report_residuals"])
def test_queries_with_many_passes_read_the_landed_lines(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "l_orderkey" not in text and "ReadSchema: struct<InvoiceNo:string" in text  # paths are cut in plan texts


def test_inputs_are_shared_within_a_query_only(spark):
    made = []

    @registry.once
    def source(spark, sf):
        made.append(sf)
        return spark.range(len(made))

    assert source(spark, "a").count() == 1 and source(spark, "a").count() == 2  # outside a query: anew
    token = registry._INPUTS.set({})
    try:
        assert source(spark, "a") is source(spark, "a")
        registry.replace_input("source", "a", lambda: spark.range(9))
        registry.replace_input("source", "a", lambda: spark.range(1))  # at most once
        assert source(spark, "a").count() == 9
    finally:
        registry._INPUTS.reset(token)
