"""Budget allocation queries on deterministic scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import budget
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import SETTINGS, fragment, query

COST = SETTINGS.cost_per_contact
SPEND = 30_000  # reaches 200 customers: fewer than have a positive score at every test scale
GRID = 100_000

fragment("greedy", f"""
 SELECT customer_id, uplift_score, predicted_clv, segment_name, rank, {COST} AS cost,
   uplift_score AS expected_incremental_revenue
 FROM (SELECT *, row_number() OVER (ORDER BY uplift_score DESC, customer_id) AS rank FROM scores WHERE uplift_score > 0)
 WHERE rank <= {SPEND // COST}""", ["scores"])
ROI = "CASE WHEN total_cost > 0 THEN round(incremental_revenue / total_cost, 9) ELSE 0.0 END AS roi"


def scores(spark, sf):
    return inputs.score_frame(spark, sf).select("customer_id", "uplift_score", "predicted_clv", "segment_name")


def greedy(spark, sf, spend=SPEND):
    return budget.optimize_greedy(scores(spark, sf), spend, COST)


def round_roi(df):
    return df.withColumn("roi", F.round("roi", 9))


@query("budget_greedy_selection", "SELECT * FROM greedy", ["greedy"])
def budget_greedy_selection(spark, sf):
    return greedy(spark, sf)


SUMMARY = f"""(SELECT count(*) AS n_targeted, coalesce(sum(expected_incremental_revenue), 0)::DOUBLE AS incremental_revenue,
   (count(*) * {COST})::DOUBLE AS total_cost FROM greedy)"""


@query("budget_greedy_summary", f"SELECT *, {ROI} FROM {SUMMARY}", ["greedy"])
def budget_greedy_summary(spark, sf):
    return round_roi(budget.allocation_summary(greedy(spark, sf), COST))


@query("budget_scenarios", f"""
 SELECT n_targeted, total_cost, scenario, multiplier, round(incremental_revenue, 6) AS incremental_revenue, {ROI}
 FROM (SELECT n_targeted, total_cost, scenario, multiplier, incremental_revenue * multiplier AS incremental_revenue
       FROM {SUMMARY}, (VALUES ('conservative', 0.7::DOUBLE), ('base', 1.0), ('optimistic', 1.3)) v(scenario, multiplier))""",
       ["greedy"])
def budget_scenarios(spark, sf):
    table = budget.under_scenarios(budget.allocation_summary(greedy(spark, sf), COST))
    return round_roi(table.withColumn("incremental_revenue", F.round("incremental_revenue", 6)))


fragment("curve", f"""
 WITH r AS (SELECT row_number() OVER o AS rank, sum(uplift_score) OVER o AS cum FROM scores WHERE uplift_score > 0
   WINDOW o AS (ORDER BY uplift_score DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 g AS (SELECT CAST(i AS INTEGER) AS point, i * ({GRID} / 49.0::DOUBLE) AS budget FROM range(50) t(i)),
 a AS (SELECT *, least(CAST(floor(budget / {COST}.0) AS BIGINT), (SELECT count(*) FROM r)) AS n_targeted FROM g)
 SELECT point, budget, n_targeted, (n_targeted * {COST})::DOUBLE AS total_cost, coalesce(cum, 0)::DOUBLE AS incremental_revenue
 FROM a LEFT JOIN r ON rank = n_targeted""", ["scores"])


def curve(spark, sf):
    frame = scores(spark, sf)
    return budget.roi_curve(frame, budget.budget_grid(frame, 0, GRID), COST)


@query("budget_roi_curve", f"""
 SELECT point, round(budget, 6) AS budget, n_targeted, total_cost, incremental_revenue, {ROI} FROM curve""", ["curve"])
def budget_roi_curve(spark, sf):
    return round_roi(curve(spark, sf).withColumn("budget", F.round("budget", 6)))


@query("budget_scenario_curves", f"""
 SELECT point, scenario, multiplier, n_targeted, total_cost, round(incremental_revenue, 6) AS incremental_revenue, {ROI}
 FROM (SELECT point, scenario, multiplier, n_targeted, total_cost, incremental_revenue * multiplier AS incremental_revenue
       FROM curve, (VALUES ('conservative', 0.7::DOUBLE), ('base', 1.0), ('optimistic', 1.3)) v(scenario, multiplier))""",
       ["curve"])
def budget_scenario_curves(spark, sf):
    table = budget.under_scenarios(curve(spark, sf).drop("budget"))
    return round_roi(table.withColumn("incremental_revenue", F.round("incremental_revenue", 6)))


@query("budget_segment_breakdown", f"""
 SELECT segment_name AS segment, count(*) AS n_targeted, sum(expected_incremental_revenue)::DOUBLE AS expected_revenue,
   (count(*) * {COST})::DOUBLE AS budget_allocated,
   round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS pct_of_budget FROM greedy GROUP BY 1""", ["greedy"])
def budget_segment_breakdown(spark, sf):
    return budget.segment_breakdown(greedy(spark, sf), COST)


@query("budget_report_selection", f"""
 SELECT count(*) AS n_targeted, sum(gain)::DOUBLE AS incremental_revenue, (count(*) * {COST})::DOUBLE AS total_cost,
   round(sum(gain)::DOUBLE / (count(*) * {COST}), 9) AS roi
 FROM (SELECT uplift_score * predicted_clv AS gain,
         row_number() OVER (ORDER BY uplift_score * predicted_clv DESC, customer_id) AS rank FROM scores)
 WHERE rank <= {SPEND // COST}""", ["scores"])
def budget_report_selection(spark, sf):
    frame = scores(spark, sf).withColumn("gain", F.col("uplift_score") * F.col("predicted_clv"))
    chosen = budget.optimize_greedy(frame, SPEND, COST, gain="gain", positive_only=False)
    return round_roi(budget.allocation_summary(chosen, COST))


@query("budget_report_curve", f"""
 WITH r AS (SELECT row_number() OVER o AS rank, sum(uplift_score * predicted_clv) OVER o AS cum FROM scores
   WINDOW o AS (ORDER BY uplift_score * predicted_clv DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 g AS (SELECT CAST(i AS INTEGER) AS point, 100000.0::DOUBLE + i * (({SETTINGS.budget} - 100000) / 49.0::DOUBLE) AS budget FROM range(50) t(i)),
 a AS (SELECT *, least(CAST(floor(budget / {COST}.0) AS BIGINT), (SELECT count(*) FROM r)) AS n_targeted FROM g)
 SELECT point, scenario, n_targeted, round(coalesce(cum, 0)::DOUBLE * multiplier, 4) AS incremental_revenue
 FROM a LEFT JOIN r ON rank = n_targeted,
   (VALUES ('conservative', 0.7::DOUBLE), ('base', 1.0), ('optimistic', 1.3)) v(scenario, multiplier)""", ["scores"])
def budget_report_curve(spark, sf):
    frame = scores(spark, sf).withColumn("gain", F.col("uplift_score") * F.col("predicted_clv"))
    table = budget.roi_curve(frame, budget.budget_grid(frame, 100_000, SETTINGS.budget), COST, "gain", False)
    return budget.under_scenarios(table).select(
        "point", "scenario", "n_targeted", F.round("incremental_revenue", 4).alias("incremental_revenue"))


@query("budget_cumulative_gain", """
 WITH s AS (SELECT customer_id, uplift_score, uplift_score * predicted_clv AS gain FROM scores)
 SELECT customer_id, row_number() OVER o AS rank,
   round((row_number() OVER o - 1) / ((SELECT count(*) FROM s) - 1)::DOUBLE * 100, 6) AS pct_contacted,
   (sum(gain) OVER o)::DOUBLE AS model_gain,
   round((SELECT sum(gain) FROM s)::DOUBLE * ((row_number() OVER o - 1) / ((SELECT count(*) FROM s) - 1)::DOUBLE), 3) AS random_gain
 FROM s WINDOW o AS (ORDER BY uplift_score DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ["scores"])
def budget_cumulative_gain(spark, sf):
    frame = scores(spark, sf).withColumn("gain", F.col("uplift_score") * F.col("predicted_clv"))
    table = budget.cumulative_gain(frame, "gain")
    return table.withColumns({"pct_contacted": F.round("pct_contacted", 6), "random_gain": F.round("random_gain", 3)})


@query("budget_persuadable_threshold", "SELECT round(quantile_cont(uplift_score, 0.9), 9) AS threshold FROM scores", ["scores"])
def budget_persuadable_threshold(spark, sf):
    return budget.persuadable_threshold(scores(spark, sf)).withColumn("threshold", F.round("threshold", 9))
