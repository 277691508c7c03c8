import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from check import TABLES, compare
from ledgerlens.operators import boosting
from ledgerlens.plans import jobs
from ledgerlens.plans.catalog.registry import SETTINGS
from ledgerlens.sources.retail import retail_lines
from ledgerlens.sources.store import TableStore

SF = "/root/testdata/sf0.001"
TINY = boosting.BoostParams(n_estimators=3, max_depth=3, learning_rate=0.3)


REPORT_TABLES = (
    "explore_nulls", "explore_lines", "explore_customers", "explore_overview", "explore_countries", "explore_months",
    "explore_amounts", "explore_frequency", "explore_monetary", "explore_concentration", "explore_correlations",
    "drift_heatmap", "drift_densities", "value_calibration", "value_frequency_recency", "evaluation_decile_lift",
    "evaluation_residuals", "report_rank_slice", "interval_widths", "report_below_p95", "attribution_importance",
    "attribution_waterfall", "boosting_importance", "evaluation_qini", "budget_cumulative_gain", "persuadable_threshold",
)


def test_every_sql_text_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 90


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["customer_id", "frequency", "recency", "T", "monetary_value", "holdout_revenue"]
    assert df.count() == 20


@pytest.mark.parametrize("name", [
    "clean_transactions", "customers_features", "cohort_retention", "metrics_qini_coefficient", "value_predict_all",
    "drift_feature_psi", "budget_roi_curve", "uplift_ranking", "interval_calibration", "segment_cluster_names",
    "attribution_waterfall", "report_kpis",
])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    note, good = compare(spark, con, SF, name, driver.queries()[name], driver.oracle_sql()[name])
    assert good, note


def test_the_whole_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    plan = jobs.ModelPlan(
        trials=0, attribution_permutations=1, two_arm=TINY, interval_base=TINY, segment_starts=1, uplift_folds=2)
    raw = retail_lines(spark, SF)
    original = boosting.BoostParams
    try:
        jobs.boosting.BoostParams = lambda seed=42: TINY  # the published size takes minutes here
        jobs.run_all(store, raw, SETTINGS, plan)
    finally:
        jobs.boosting.BoostParams = original
    customers = store.read("customer_features").count()
    for table in ("probabilistic_predictions", "value_matrix", "clv_predictions", "customer_segments", "uplift_scores",
                  "clv_predictions_with_intervals", "customer_master"):
        frame = store.read(table)
        assert frame.count() == customers == frame.select("customer_id").distinct().count(), table
    assert {r["model"] for r in store.read("model_comparison").collect()} == {"BG/NBD", "LightGBM", "Stacked"}
    intervals = store.read("clv_predictions_with_intervals")
    assert intervals.where(F.col("clv_lower") > F.col("clv_upper")).count() == 0
    assert store.read("budget_curves").count() == 150
    assert store.read("transactions_clean").where("year_month = '1996-05'").count() > 0
    assert store.read("quarterly_psi").columns == ["quarter", "baseline_quarter", "feature", "psi"]
    model = jobs.load_boosting(store)
    assert model.getNumTrees == 3
    assert {r["mode"] for r in store.read("model_comparison").collect()} == {"in-sample", "out-of-fold"}
    assert {r["mode"] for r in store.read("qini_curve").collect()} == {"in-sample", "out-of-fold"}
    for table in REPORT_TABLES:
        assert not store.read(table).isEmpty(), table

    # The stored models alone give every customer the scores of the run.
    again = jobs.score_customers(store, store.read("customer_features"), SETTINGS)
    assert again.count() == customers
    both = again.alias("n").join(store.read("customer_master").alias("o"), "customer_id")
    far = lambda c: F.abs(F.col(f"n.{c}") - F.col(f"o.{c}")) > F.abs(F.col(f"o.{c}")) * 1e-9 + 1e-6
    assert both.where(far("predicted_clv") | far("uplift_score")).count() == 0
    assert both.where(F.col("n.segment_name") != F.col("o.segment_name")).count() == 0
    assert again.where("clv_lower is null or clv_upper < clv_lower").count() == 0
    with pytest.raises(ValueError, match="repeats"):
        jobs.score_customers(store, store.read("customer_features").union(store.read("customer_features")), SETTINGS)
