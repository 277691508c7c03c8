"""Split-conformal prediction intervals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.metrics import coverage
from ledgerlens.operators.quantiles import order_statistic


@dataclass(frozen=True)
class IntervalModel:
    """Half-width of every interval and the level it was calibrated for."""

    half_width: float
    alpha: float
    n_calibration: int


def calibration_quantile(df: DataFrame, actual: str, predicted: str, alpha: float) -> DataFrame:
    """One row (half_width, n_calibration): the ⌈(n+1)(1−α)⌉-th smallest absolute residual, null if n is too small."""
    scores = df.select(F.abs(F.col(actual).cast("double") - F.col(predicted).cast("double")).alias("score"))
    # The small constant keeps an exact product such as 0.9 × 10 from being rounded up to the next rank.
    found = order_statistic(scores, "score", lambda n: F.ceil((n + 1) * F.lit(1.0 - alpha) - F.lit(1e-9)).cast("bigint"))
    return found.select(F.col("v0").alias("half_width"), F.col("total").alias("n_calibration"))


def calibrate(df: DataFrame, actual: str, predicted: str, alpha: float = 0.10) -> IntervalModel:
    row = calibration_quantile(df, actual, predicted, alpha).first()
    if row is None or row["half_width"] is None:
        raise ValueError("calibration set too small for the requested level")
    return IntervalModel(float(row["half_width"]), alpha, int(row["n_calibration"]))


def with_intervals(df: DataFrame, model: IntervalModel, predicted: str = "predicted_clv") -> DataFrame:
    """Add clv_lower, clv_upper, interval_width and a label such as ``CLV ₹4,200 (₹2,800–₹5,900)``."""
    p = F.col(predicted).cast("double")
    out = df.withColumns({
        "clv_lower": p - F.lit(model.half_width), "clv_upper": p + F.lit(model.half_width),
        "interval_width": F.lit(2.0 * model.half_width),
    })
    whole = [F.round(c).cast("bigint") for c in (p, F.col("clv_lower"), F.col("clv_upper"))]
    return out.withColumn("clv_label", F.format_string("CLV ₹%,d (₹%,d–₹%,d)", *whole))


def evaluate_coverage(df: DataFrame, actual: str) -> DataFrame:
    """One row (empirical_coverage, avg_interval_width)."""
    y, low, high = (F.col(c).cast("double") for c in (actual, "clv_lower", "clv_upper"))
    return df.agg(coverage(y, low, high).alias("empirical_coverage"), F.avg("interval_width").alias("avg_interval_width"))


def width_statistics(df: DataFrame) -> DataFrame:
    """One row (mean_width, median_width, p95_width)."""
    from ledgerlens.operators.quantiles import quantiles
    middle = quantiles(df, "interval_width", [0.5, 0.95]).select("q").scalar()
    return df.agg(F.avg("interval_width").alias("mean_width")).select(
        "mean_width", middle[0].alias("median_width"), middle[1].alias("p95_width"))


def merge_intervals(predictions: DataFrame, intervals: DataFrame) -> DataFrame:
    """Predictions with the interval columns attached; a new table, the input is left as it is."""
    columns = ("clv_lower", "clv_upper", "interval_width")
    return predictions.drop(*columns).join(intervals.select("customer_id", *columns), "customer_id", "left")
