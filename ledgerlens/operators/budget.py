"""Campaign budget allocation.

With one cost per contact the greedy choice is a prefix of the ranking, so a single ranked pass
answers every budget and every scenario; nothing is re-run per budget.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import SCENARIOS
from ledgerlens.operators.quantiles import quantiles
from ledgerlens.operators.ranking import by_score, place, running_totals, unfold, whole


def with_clv_gain(df: DataFrame, multiplier: float = 1.0) -> DataFrame:
    """Gain as uplift × multiplier × predicted value (the report's variant)."""
    return df.withColumn("gain", F.col("uplift_score") * F.lit(multiplier) * F.col("predicted_clv"))


def optimize_greedy(df: DataFrame, budget: float, cost: float, gain: str = "uplift_score",
                    positive_only: bool = True) -> DataFrame:
    """Chosen customers: best gain first until the money or the positive gains run out."""
    candidates = df.where(F.col(gain) > 0) if positive_only else df
    affordable = max(math.floor(budget / cost), 0)
    return running_totals(candidates, by_score(gain)).where(F.col("rank") <= affordable).withColumns({
        "cost": F.lit(cost), "expected_incremental_revenue": F.col(gain),
    })


def allocation_summary(selected: DataFrame, cost: float) -> DataFrame:
    """One row: n_targeted, total_cost, incremental_revenue, roi."""
    totals = selected.agg(
        F.count(F.lit(1)).alias("n_targeted"),
        F.coalesce(F.sum("expected_incremental_revenue"), F.lit(0)).cast("double").alias("incremental_revenue"),
    )
    return _with_roi(totals.withColumn("total_cost", (F.col("n_targeted") * F.lit(cost)).cast("double")))


def _with_roi(df: DataFrame) -> DataFrame:
    ratio = F.when(F.col("total_cost") > 0, F.try_divide("incremental_revenue", "total_cost")).otherwise(F.lit(0.0))
    return df.withColumn("roi", ratio)


def budget_grid(df: DataFrame, start: float, stop: float, points: int = 50) -> DataFrame:
    """Evenly spaced budgets as a tiny table."""
    step = (stop - start) / (points - 1)
    return df.sparkSession.range(points).select(
        F.col("id").cast("int").alias("point"), (F.lit(float(start)) + F.col("id") * F.lit(step)).alias("budget"))


def roi_curve(df: DataFrame, budgets: DataFrame, cost: float, gain: str = "uplift_score",
              positive_only: bool = True) -> DataFrame:
    """(point, budget, n_targeted, total_cost, incremental_revenue, roi) for every budget of the grid."""
    placement = place(df.where(F.col(gain) > 0) if positive_only else df, by_score(gain), sums=[gain])
    available, ranked = whole(placement)["n"], unfold(placement)
    asked = budgets.withColumn(
        "n_targeted", F.least(F.floor(F.col("budget") / F.lit(float(cost))).cast("bigint"), available))
    # Only the ranks the grid asks for survive the join.
    reached = ranked.join(asked.select(F.col("n_targeted").alias("rank")).distinct(), "rank").select(
        F.col("rank").alias("n_targeted"), F.col(f"cum_{gain}").cast("double").alias("revenue"))
    return _with_roi(asked.join(reached, "n_targeted", "left").select(
        "point", "budget", "n_targeted", (F.col("n_targeted") * F.lit(cost)).cast("double").alias("total_cost"),
        F.coalesce("revenue", F.lit(0.0)).alias("incremental_revenue"),
    ))


def under_scenarios(result: DataFrame, scenarios: dict[str, float] = SCENARIOS) -> DataFrame:
    """Repeat allocation rows per scenario.  A positive multiplier changes no order, only revenue and ROI."""
    if min(scenarios.values()) <= 0:
        raise ValueError("scenario multipliers must be positive")
    options = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(m)).alias("multiplier")) for n, m in scenarios.items()])
    rows = result.select("*", F.inline(options))
    return _with_roi(rows.withColumn("incremental_revenue", F.col("incremental_revenue") * F.col("multiplier")))


def segment_breakdown(selected: DataFrame, cost: float, segment: str = "segment_name") -> DataFrame:
    """(segment, n_targeted, budget_allocated, expected_revenue, pct_of_budget), best revenue first."""
    groups = selected.groupBy(F.col(segment).alias("segment")).agg(
        F.count(F.lit(1)).alias("n_targeted"),
        F.sum("expected_incremental_revenue").cast("double").alias("expected_revenue"),
    ).withColumn("budget_allocated", (F.col("n_targeted") * F.lit(cost)).cast("double"))
    spent = groups.agg(F.sum("budget_allocated")).scalar()
    return groups.withColumn(
        "pct_of_budget", F.round(F.try_divide(F.col("budget_allocated") * 100, spent), 1)
    ).orderBy(F.desc("expected_revenue"), "segment")


def cumulative_gain(df: DataFrame, gain: str, score: str = "uplift_score") -> DataFrame:
    """(customer_id, rank, pct_contacted, model_gain, random_gain) in uplift order."""
    placement = place(df.select("customer_id", score, gain), by_score(score), sums=[gain])
    everyone, ranked = whole(placement), unfold(placement)
    size, total = everyone["n"], everyone[gain]
    passed: Column = F.coalesce(F.try_divide((F.col("rank") - 1).cast("double"), (size - 1).cast("double")), F.lit(0.0))
    return ranked.select(
        "customer_id", "rank", (passed * 100).alias("pct_contacted"),
        F.col(f"cum_{gain}").cast("double").alias("model_gain"), (total.cast("double") * passed).alias("random_gain"),
    )


def persuadable_threshold(df: DataFrame, probs: Sequence[float] = (0.9,)) -> DataFrame:
    return quantiles(df, "uplift_score", list(probs)).select(F.col("q")[0].alias("threshold"))
