"""Batch jobs: each reads named tables from the store, computes, and writes named tables.

Phases meet only in Parquet, so a lost driver restarts at the last finished phase and the phases
after ``run_value_models`` may run side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import Settings
from ledgerlens.functions.splits import conformal_part
from ledgerlens.operators import (
    bgnbd, boosting, budget, cleaning, conformal, drift, explore, features, forest, gamma_gamma, metrics, search, segments, stacking, uplift,
)
from ledgerlens.operators.stability import landed
from ledgerlens.plans import reports
from ledgerlens.schemas import require_unique
from ledgerlens.sources.store import TableStore


@dataclass(frozen=True)
class ModelPlan:
    """How much fitting to do; the defaults follow the published run."""

    trials: int | None = None  # None: as the settings say; 0: published defaults without a search
    search_space: dict | None = None
    fit_rows: int | None = None  # labelled rows that a fit of trees takes; None: all
    # "oof": stack, intervals and comparison use predictions by models that have not seen the customer;
    # "passthrough": they use those of the final model, as published.
    stack_mode: str = "oof"
    uplift_folds: int = 5  # for the curve of held-out scores; 0 leaves only the curve of the fitted ones
    attribution_permutations: int = 4  # of no effect: attributions are exact
    two_arm: boosting.BoostParams = boosting.TWO_ARM
    interval_base: boosting.BoostParams = boosting.INTERVAL_BASE
    segment_starts: int = 5


def _inputs(matrix: DataFrame, *others: str) -> list[str]:
    return [c for c in matrix.columns if c not in ("customer_id", *others)]


def _store_forest(store: TableStore, name: str, model: forest.Forest) -> None:
    """A model as two tables: its nodes, and its inputs in order."""
    store.write(name, model.table(store.spark).coalesce(1))
    store.write(f"{name}_inputs", store.spark.createDataFrame(list(enumerate(model.inputs)), "position int, feature string").coalesce(1))


def run_data(store: TableStore, raw: DataFrame, settings: Settings) -> None:
    """Land the lines, clean, split, and build every customer table."""
    # Landed once as Parquet: the later passes read two to four columns instead of parsing or joining again.
    raw = store.write("invoice_lines", raw)
    tx = store.write("transactions_clean", cleaning.clean(raw, settings), partition_by="year_month")
    store.write("cleaning_report", cleaning.retention_report(raw, settings))
    observed, held = cleaning.temporal_split(tx, settings)
    observed = store.write("transactions_observation", observed, partition_by="year_month")
    held = store.write("transactions_holdout", held, partition_by="year_month")
    raw_observed = cleaning.between_dates(raw, settings.observation_start, settings.observation_end)
    table = store.write("customer_features", features.customer_features(observed, raw_observed, settings.observation_end))
    store.write("rfm_summary", table.select("customer_id", "frequency", "recency", "T", "monetary_value"))
    store.write("holdout_actuals", features.holdout_actuals(held))
    retention = store.write("cohort_retention", features.cohort_retention(observed))
    store.write("cohort_heatmap", features.cohort_heatmap(retention))


def run_probabilistic(store: TableStore, settings: Settings) -> None:
    """Fit both models, score the base, validate on customers that came back."""
    rfm, actuals = store.read("rfm_summary"), store.read("holdout_actuals")
    purchases = bgnbd.fit(rfm, settings.penalizer)
    spend = gamma_gamma.fit(rfm, settings.penalizer, unit=settings.spend_unit)
    store.write_params("model_purchases", purchases)
    store.write_params("model_spend", spend)
    scored = store.write("probabilistic_predictions", gamma_gamma.predict_all(rfm, purchases, spend, settings, arrow=True))
    common = scored.join(actuals, "customer_id")
    store.write("probabilistic_validation", metrics.regression_report(common, "holdout_revenue", "predicted_clv"))


def run_value_models(store: TableStore, settings: Settings, plan: ModelPlan = ModelPlan()) -> None:
    """Tune, train, stack, compare, explain."""
    probabilities = store.read("probabilistic_predictions")
    matrix = store.write("value_matrix", features.value_matrix(
        store.read("customer_features"), probabilities, store.read("holdout_actuals")))
    inputs = _inputs(matrix, "target_revenue")
    count = settings.tuning_trials if plan.trials is None else plan.trials
    if count > 0:
        space = plan.search_space or search.SPACE
        best, trials = search.search(matrix, inputs, "target_revenue", count, settings.seed, settings.folds, space=space, fit_rows=plan.fit_rows)
        store.write("boost_trials", search.trial_table(store.spark, trials, settings.seed, space))
    else:
        best = boosting.BoostParams(seed=settings.seed)
    store.write_params("boost_params", best)
    model = forest.train(matrix, inputs, "target_revenue", best, plan.fit_rows)
    _store_forest(store, "model_boosting", model)
    boosted = store.write("boosted_predictions", forest.predict(model, matrix, inputs).select("customer_id", "prediction"))

    if plan.stack_mode == "oof":
        level_one = forest.out_of_fold(matrix, inputs, "target_revenue", best, settings.folds, fit_rows=plan.fit_rows).withColumnRenamed("oof", "gbt")
    elif plan.stack_mode == "passthrough":
        level_one = matrix.select("customer_id", "target_revenue").join(
            boosted.withColumnRenamed("prediction", "gbt"), "customer_id")
    else:
        raise ValueError(f"unknown stack mode: {plan.stack_mode}")
    pairs = store.write("stack_pairs", level_one.join(
        matrix.select("customer_id", F.col("prob_predicted_clv").alias("bgf")), "customer_id"))
    stack = stacking.fit(pairs, "target_revenue", "bgf", "gbt")
    store.write_params("model_stack", stack)
    final = store.write("clv_predictions", stacking.final_predictions(matrix, probabilities, boosted, stack))

    # The same table from what the stack was fitted on: equal to the final one in passthrough mode.
    known = store.write("clv_predictions_known", stacking.final_predictions(
        matrix, probabilities, pairs.select("customer_id", F.col("gbt").alias("prediction")), stack))

    def compared(table: DataFrame, mode: str) -> DataFrame:
        rows = table.join(matrix.select("customer_id", "target_revenue"), "customer_id")
        return metrics.model_scores(rows, "target_revenue", {
            "BG/NBD": "predicted_clv_bgnbd", "LightGBM": "predicted_clv_lgbm", "Stacked": "predicted_clv",
        }).withColumn("mode", F.lit(mode))

    comparison = compared(final, "in-sample")
    if plan.stack_mode == "oof":
        comparison = comparison.unionByName(compared(known, "out-of-fold"))
    store.write("model_comparison", comparison)
    store.write("attributions", forest.attributions(model, matrix, inputs))


def run_segmentation(store: TableStore, settings: Settings, plan: ModelPlan = ModelPlan()) -> None:
    final = store.read("clv_predictions")
    recency = store.read("rfm_summary").select("customer_id", F.col("recency").alias("recency_days"))
    base = final.join(recency, "customer_id", "left").na.fill(0, ["recency_days"])
    model = segments.fit(base, settings.segment_k, final_starts=plan.segment_starts, seed=settings.seed)
    segments.store_model(store, model)
    ids = segments.predict(model, base)
    labelled = segments.label_segments(base.join(ids, "customer_id"), model.names)
    table = store.write("customer_segments", labelled)
    store.write("segment_profiles", segments.profiles(table))


def run_uplift(store: TableStore, settings: Settings, plan: ModelPlan = ModelPlan(), exposure: DataFrame | None = None) -> None:
    """Two-arm uplift; ``exposure`` (customer_id, treatment) replaces the hash assignment where a campaign ran.

    Customers outside the campaign have no arm: they are scored and ranked but take no part in the fit and the curve.
    """
    table = store.read("customer_features")
    inputs = _inputs(table, "cohort_month", "cohort_index")
    matrix = table.select("customer_id", *features.without_gaps(table, inputs)).join(
        store.read("holdout_actuals"), "customer_id", "left").na.fill(0.0, ["holdout_revenue"])
    if exposure is not None:
        require_unique(exposure, "customer_id", "exposure")
    everyone = matrix.join(exposure, "customer_id", "left") if exposure is not None else uplift.assign_arms(matrix, settings.treatment_share)
    everyone = store.write("uplift_matrix", everyone)
    armed = everyone.where(F.col("treatment").isNotNull())
    store.write("uplift_arms", uplift.arm_summary(armed, "holdout_revenue"))
    models = uplift.fit_t_learner(armed, inputs, "holdout_revenue", params=plan.two_arm)
    _store_forest(store, "model_uplift_treated", models[0])
    _store_forest(store, "model_uplift_control", models[1])
    scored = store.write("uplift_raw", uplift.predict_uplift(models, everyone, inputs).select(
        "customer_id", "uplift_score", "treatment", "holdout_revenue"))
    store.write("uplift_scores", uplift.rank_by_uplift(scored))
    curve = uplift.qini_curve(scored.where(F.col("treatment").isNotNull()), "holdout_revenue", "uplift_score").withColumn("mode", F.lit("in-sample"))
    if plan.uplift_folds > 1:
        unseen = store.write("uplift_held_out", uplift.cross_fitted(
            armed, inputs, "holdout_revenue", params=plan.two_arm, folds=plan.uplift_folds).select(
            "customer_id", "uplift_score", "treatment", "holdout_revenue"))
        curve = curve.unionByName(uplift.qini_curve(unseen, "holdout_revenue", "uplift_score").withColumn("mode", F.lit("out-of-fold")))
    store.write("qini_curve", curve)


def run_budget(store: TableStore, settings: Settings) -> None:
    scores = store.read("uplift_scores").select("customer_id", "uplift_score").join(
        store.read("customer_segments").select("customer_id", "segment_name", "predicted_clv"), "customer_id", "left")
    cost = settings.cost_per_contact
    chosen = store.write("budget_selection", budget.optimize_greedy(scores, settings.budget, cost))
    store.write("budget_scenarios", budget.under_scenarios(budget.allocation_summary(chosen, cost)))
    store.write("budget_segments", budget.segment_breakdown(chosen, cost))
    curve = budget.roi_curve(scores, budget.budget_grid(scores, 0, settings.budget), cost)
    store.write("budget_curves", budget.under_scenarios(curve))


def run_intervals(store: TableStore, settings: Settings, plan: ModelPlan = ModelPlan()) -> None:
    # Inputs by models that have not seen a customer's target keep training, calibration and test rows exchangeable.
    table, final, unseen = store.read("customer_features"), store.read("clv_predictions"), store.read("clv_predictions_known")
    known = store.write("interval_matrix", features.interval_matrix(table, unseen, store.read("holdout_actuals"))
                        .withColumn("part", conformal_part("customer_id")))
    inputs = _inputs(known, "holdout_revenue", "part")
    params = replace(plan.interval_base, seed=settings.seed)
    model = forest.train(known.where(F.col("part") == "train"), inputs, "holdout_revenue", params, plan.fit_rows)
    _store_forest(store, "model_interval_base", model)
    scored = forest.predict(model, known.where(F.col("part") != "train"), inputs, "center")
    half = conformal.calibrate(scored.where(F.col("part") == "calibration"), "holdout_revenue", "center", settings.conformal_alpha)
    store.write_params("model_intervals", half)
    test = conformal.with_intervals(scored.where(F.col("part") == "test"), half, "center")
    store.write("interval_coverage", conformal.evaluate_coverage(test, "holdout_revenue"))
    everyone = forest.predict(model, features.interval_matrix(table, unseen), inputs, "center")
    ranges = conformal.with_intervals(everyone.select("customer_id", "center"), half, "center")
    store.write("clv_predictions_with_intervals", conformal.merge_intervals(final, ranges))


def run_drift(store: TableStore, settings: Settings) -> None:
    psi = store.write("quarterly_psi", drift.quarterly_rfm_psi(
        store.read("transactions_clean"), settings.min_quarter_rows, bins=settings.psi_bins))
    store.write("drift_status", drift.detect_drift(psi, settings.psi_low, settings.psi_high))
    store.write("drift_alerts", drift.alerts(drift.latest_quarter(psi), settings.psi_low, settings.psi_high))


def run_reports(store: TableStore) -> None:
    sides = [require_unique(store.read(name), "customer_id", name) for name in (
        "customer_features", "clv_predictions_with_intervals", "customer_segments", "uplift_scores")]
    master = store.write("customer_master", reports.customer_master(*sides))
    store.write("segment_summary", reports.segment_summary(master))
    store.write("retraining", drift.retraining_decision(store.read("quarterly_psi"), store.read("interval_coverage")))


def run_exploration(store: TableStore) -> None:
    """The tables behind the study of lines, customers and drift."""
    raw, tx, rfm = store.read("invoice_lines"), store.read("transactions_clean"), store.read("rfm_summary")
    store.write("explore_nulls", explore.null_profile(raw))
    store.write("explore_lines", explore.describe(raw, ["Quantity", "UnitPrice"], digits=4))
    store.write("explore_customers", explore.describe(rfm, ["frequency", "recency", "T", "monetary_value"]))
    store.write("explore_overview", explore.overview(tx))
    store.write("explore_countries", explore.top_countries(tx, 10))
    store.write("explore_months", explore.monthly_series(tx))
    store.write("explore_amounts", explore.histogram(tx, "TotalPrice", bins=200, upper_quantile=0.95))
    store.write("explore_frequency", explore.histogram(rfm, "frequency", bins=30))
    store.write("explore_monetary", explore.histogram(
        rfm.where(F.col("monetary_value") > 0), "monetary_value", bins=30, upper_quantile=0.99, clip=True))
    store.write("explore_concentration", explore.revenue_concentration(tx, [0.1, 0.2, 0.5, 1.0]))
    table = store.read("customer_features")
    store.write("explore_correlations", explore.correlations(table, _inputs(table, "cohort_month")))
    store.write("drift_heatmap", drift.heatmap(store.read("quarterly_psi")))
    store.write("drift_densities", drift.density_histograms(
        store.read("transactions_observation"), store.read("transactions_holdout"), "TotalPrice"))


def run_evaluation(store: TableStore, settings: Settings) -> None:
    """How good each model is, and what drives it; held-out scores where there are any."""
    rfm, actuals, known = store.read("rfm_summary"), store.read("holdout_actuals"), store.read("clv_predictions_known")
    purchases = store.read_params("model_purchases", bgnbd.PurchaseModel)
    days = (settings.holdout_end - settings.holdout_start).days + 1
    held = store.read("transactions_holdout").groupBy(F.col("CustomerID").alias("customer_id")).agg(
        F.count_distinct(F.to_date("InvoiceDate")).alias("n_purchases"))
    store.write("value_calibration", gamma_gamma.calibration(rfm, held, purchases, days))
    store.write("value_frequency_recency", gamma_gamma.frequency_recency_table(rfm, purchases, days))
    matrix = store.read("value_matrix")
    with_target = known.join(matrix.select("customer_id", "target_revenue"), "customer_id")
    store.write("evaluation_decile_lift", metrics.decile_lift(with_target, "target_revenue", "predicted_clv"))
    store.write("evaluation_residuals", metrics.residuals(known, actuals))
    top = store.read("clv_predictions").select("customer_id", "predicted_clv")
    store.write("report_rank_slice", explore.rank_slice(top, "predicted_clv", 10, 30))
    ranges = store.read("clv_predictions_with_intervals")
    store.write("interval_widths", conformal.width_statistics(ranges))
    store.write("report_below_p95", explore.quantile_below(ranges, "predicted_clv", 0.95))
    parts = store.read("attributions")
    store.write("attribution_importance", boosting.global_importance(parts))
    store.write("attribution_waterfall", boosting.waterfall(parts))
    store.write("boosting_importance", forest.split_importance(load_boosting(store), _inputs(matrix, "target_revenue")))
    armed = store.read("uplift_raw").where(F.col("treatment").isNotNull())
    store.write("evaluation_qini", metrics.qini_coefficient(armed, "holdout_revenue", "uplift_score", "treatment"))
    scores = store.read("uplift_scores").join(top, "customer_id", "left").na.fill(0.0, ["predicted_clv"])
    store.write("budget_cumulative_gain", budget.cumulative_gain(budget.with_clv_gain(scores), "gain"))
    store.write("persuadable_threshold", budget.persuadable_threshold(scores))


def score_customers(store: TableStore, table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Values, intervals, segment and uplift of the customers in ``table`` (features as in ``customer_features``).

    Only stored models are used: nothing is fitted and no target is read.
    """
    trained_on = store.read("customer_features").columns  # models know their inputs by position
    table = require_unique(table.select(trained_on), "customer_id", "features")
    rfm = table.select("customer_id", "frequency", "recency", "T", "monetary_value")
    probabilities = gamma_gamma.predict_all(
        rfm, store.read_params("model_purchases", bgnbd.PurchaseModel), store.read_params("model_spend", gamma_gamma.SpendModel), settings, arrow=True)
    matrix = features.value_matrix(table, probabilities)
    boosted = forest.predict(load_boosting(store), matrix, _inputs(matrix)).select("customer_id", "prediction")
    final = landed(stacking.final_predictions(matrix, probabilities, boosted, store.read_params("model_stack", stacking.StackModel)))

    base = final.join(rfm.select("customer_id", F.col("recency").alias("recency_days")), "customer_id", "left").na.fill(0, ["recency_days"])
    model = segments.load_model(store)
    named = segments.label_segments(segments.predict(model, base), model.names)

    inputs = _inputs(table, "cohort_month", "cohort_index")
    arms = (load_boosting(store, "model_uplift_treated"), load_boosting(store, "model_uplift_control"))
    lifted = uplift.predict_uplift(arms, table.select("customer_id", *features.without_gaps(table, inputs)), inputs).select(
        "customer_id", "uplift_score")

    wide = features.interval_matrix(table, final)
    centers = forest.predict(load_boosting(store, "model_interval_base"), wide, _inputs(wide), "center").select("customer_id", "center")
    ranges = conformal.with_intervals(centers, store.read_params("model_intervals", conformal.IntervalModel), "center")
    return conformal.merge_intervals(final, ranges).join(named, "customer_id", "left").join(lifted, "customer_id", "left")


def run_all(store: TableStore, raw: DataFrame, settings: Settings = Settings(), plan: ModelPlan = ModelPlan()) -> None:
    run_data(store, raw, settings)
    run_probabilistic(store, settings)
    run_value_models(store, settings, plan)
    run_segmentation(store, settings, plan)
    run_uplift(store, settings, plan)
    run_budget(store, settings)
    run_intervals(store, settings, plan)
    run_drift(store, settings)
    run_reports(store)
    run_exploration(store)
    run_evaluation(store, settings)


def load_boosting(store: TableStore, name: str = "model_boosting") -> forest.Forest:
    return forest.from_table(store.read(name), [r["feature"] for r in store.read(f"{name}_inputs").orderBy("position").collect()])
