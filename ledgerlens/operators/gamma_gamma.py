"""Gamma-Gamma spend model (Fader & Hardie 2013) and discounted customer value."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import Settings
from ledgerlens.functions.special import polygammas
from ledgerlens.operators import bgnbd
from ledgerlens.operators.likelihood import maximise
from ledgerlens.operators.stability import materialise, spread
from ledgerlens.schemas import require_columns

DAYS_PER_MONTH = 30


@dataclass(frozen=True)
class SpendModel:
    p: float
    q: float
    v: float
    converged: bool = True


def expected_spend(model: SpendModel) -> Column:
    """Expected average order value given a customer's history."""
    x, m = F.col("frequency").cast("double"), F.col("monetary_value").cast("double")
    weight = F.lit(model.p) * x / (F.lit(model.p) * x + F.lit(model.q - 1.0))
    return weight * m + (F.lit(1.0) - weight) * F.lit(model.p * model.v / (model.q - 1.0))


def row_model(data: dict[str, np.ndarray], theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of mean amounts m over x purchases and its first and second derivatives by p, q, v."""
    p, q, v = (float(value) for value in theta)
    x, m = data["x"], data["m"]
    px, total = p * x, x * m + v
    shape, log_total, log_m, log_x = px + q, np.log(total), np.log(m), np.log(x)
    (l_s, p_s, q_s), (l_px, p_px, q_px) = polygammas(shape), polygammas(px)
    l_q, p_q, q_q = (value[0] for value in polygammas(np.array([q])))
    ll = l_s - l_px - l_q + q * np.log(v) + (px - 1) * log_m + px * log_x - shape * log_total
    first = np.stack([x * (p_s - p_px + log_m + log_x - log_total), p_s - p_q + np.log(v) - log_total, q / v - shape / total])
    second = np.empty((3, 3, len(x)))
    second[0, 0], second[1, 1], second[2, 2] = x * x * (q_s - q_px), q_s - q_q, shape / total ** 2 - q / v ** 2
    second[0, 1] = second[1, 0] = x * q_s
    second[0, 2] = second[2, 0] = -x / total
    second[1, 2] = second[2, 1] = 1 / v - 1 / total
    return ll, first, second


def fit(rfm: DataFrame, penalizer: float = 0.01, max_rounds: int = 200, unit: float = 1.0) -> SpendModel:
    """Penalised maximum likelihood over repeat customers; ``converged`` tells whether the search ended at a maximum.

    The penalty acts on ``v`` in multiples of ``unit``; 1.0 is the published behaviour, a typical
    order value keeps the penalty from swamping the likelihood when amounts are large.
    """
    require_columns(rfm, ("frequency", "monetary_value"))
    rows = materialise(
        rfm.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
        .groupBy(F.col("frequency").cast("double").alias("x"),
                 (F.col("monetary_value").cast("double") / F.lit(float(unit))).alias("m"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    found, _, converged = maximise(rows, row_model, (1.0, 1.5, 1.0), penalizer, max_rounds)
    p, q, v = (float(value) for value in found)
    return SpendModel(p, q, v * unit, converged)


def _monthly_plan(months: int, discount: float) -> list[tuple[float, float]]:
    """Σ (E_i − E_{i−1}) / (1+d)^i summed by parts: (days, weight) of each month's expectation."""
    factors = [(1.0 + discount) ** -i for i in range(1, months + 1)]
    return [(float(DAYS_PER_MONTH * i), f - g) for i, (f, g) in enumerate(zip(factors, [*factors[1:], 0.0]), start=1)]


def _value(discounted: Column, purchases: bgnbd.PurchaseModel, spend: SpendModel, margin: float) -> Column:
    worth = F.lit(margin) * expected_spend(spend) * discounted * bgnbd.p_alive(purchases)
    return F.when(F.col("frequency") > 0, worth).otherwise(F.lit(0.0))


def customer_value(purchases: bgnbd.PurchaseModel, spend: SpendModel, months: int, discount: float,
                   margin: float) -> Column:
    """Discounted margin over the next months; 0 without a repeat purchase."""
    return _value(bgnbd.active_purchases(purchases, [_monthly_plan(months, discount)])["p0"], purchases, spend, margin)


def predict_all(rfm: DataFrame, purchases: bgnbd.PurchaseModel, spend: SpendModel, settings: Settings, arrow: bool = False) -> DataFrame:
    """(customer_id, predicted_purchases, p_alive, predicted_clv, clv_inr): one pass over rows spread over all tasks.

    The horizon's expectation and the discounted months come from the same evaluation of a row;
    ``arrow`` as in :func:`bgnbd.active_purchases`.
    """
    months = settings.horizon_months
    plans = [[(float(DAYS_PER_MONTH * months), 1.0)], _monthly_plan(months, settings.monthly_discount)]
    alive = bgnbd.p_alive(purchases)
    scored = spread(rfm.select("customer_id", "frequency", "recency", "T", "monetary_value")).withColumn("_active", bgnbd.active_purchases(purchases, plans, arrow))
    return scored.select(
        "customer_id", (F.col("_active.p0") * alive).alias("predicted_purchases"), alive.alias("p_alive"),
        _value(F.col("_active.p1"), purchases, spend, settings.gross_margin).alias("predicted_clv"),
    ).withColumn("clv_inr", F.col("predicted_clv"))


def frequency_recency_table(rfm: DataFrame, purchases: bgnbd.PurchaseModel, days: int, width: int = 30) -> DataFrame:
    """Average expectation and P(alive) of the customer base by frequency and recency bucket."""
    return spread(rfm.select("frequency", "recency", "T")).select(
        "frequency", F.floor(F.col("recency") / width).cast("int").alias("recency_bucket"),
        bgnbd.expected_purchases(purchases, days).alias("e"), bgnbd.p_alive(purchases).alias("alive"),
    ).groupBy("frequency", "recency_bucket").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("e").alias("expected_purchases"), F.avg("alive").alias("p_alive"))


def calibration(rfm: DataFrame, holdout_purchases: DataFrame, purchases: bgnbd.PurchaseModel, days: int) -> DataFrame:
    """Mean actual and expected holdout purchases by calibration frequency.

    ``holdout_purchases``: (customer_id, n_purchases); customers absent from it bought nothing.
    """
    return (
        spread(rfm.join(holdout_purchases, "customer_id", "left").select("frequency", "recency", "T", "n_purchases"))
        .select("frequency", F.coalesce("n_purchases", F.lit(0)).alias("n"),
                bgnbd.expected_purchases(purchases, days).alias("e"))
        .groupBy("frequency")
        .agg(F.count(F.lit(1)).alias("n_customers"), F.avg("n").alias("actual"), F.avg("e").alias("expected"))
    )
