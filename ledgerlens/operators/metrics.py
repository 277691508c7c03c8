"""Regression, ranking and interval metrics as aggregations."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import quantiles
from ledgerlens.operators.ranking import by_score, place, unfold, whole

NAN = float("nan")


def _known(*columns: Column) -> Column:
    """All values present: neither null nor NaN."""
    good = F.lit(True)
    for c in columns:
        good = good & c.isNotNull() & ~F.isnan(c)
    return good


def _mean(value: Column, *inputs: Column) -> Column:
    """Mean over known inputs; NaN when nothing is known."""
    return F.coalesce(F.avg(F.when(_known(*inputs), value)), F.lit(NAN))


def mae(actual: Column, predicted: Column) -> Column:
    return _mean(F.abs(actual - predicted), actual, predicted)


def rmse(actual: Column, predicted: Column) -> Column:
    error = actual - predicted
    return F.sqrt(_mean(error * error, actual, predicted))


def mape(actual: Column, predicted: Column) -> Column:
    """Percent over non-zero actuals; 0 when all actuals are zero, NaN for no rows at all."""
    # A NaN actual differs from zero, so it stays in the set and is skipped by the mean.
    relative = F.abs(F.try_divide(actual - predicted, actual)) * 100
    nonzero = F.count_if(actual != 0)
    return (
        F.when(F.count(F.lit(1)) == 0, F.lit(NAN))
        .when(nonzero == 0, F.lit(0.0))
        .otherwise(F.coalesce(F.avg(F.when(_known(actual, predicted) & (actual != 0), relative)), F.lit(NAN)))
    )


def safe_corr(x: Column, y: Column) -> Column:
    """Correlation that is null for a constant side (the built-in one raises there in ANSI mode).

    Both inputs must be null in the same rows.
    """
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pearson(actual: Column, predicted: Column) -> Column:
    known = _known(actual, predicted)
    r = safe_corr(F.when(known, actual), F.when(known, predicted))
    return F.when(F.count_if(known) < 2, F.lit(NAN)).otherwise(F.coalesce(r, F.lit(NAN)))


def coverage(actual: Column, lower: Column, upper: Column) -> Column:
    """Share of known rows inside [lower, upper]."""
    inside = ((actual >= lower) & (actual <= upper)).cast("double")
    return _mean(inside, actual, lower, upper)


def _doubles(*names: str) -> list[Column]:
    return [F.col(n).cast("double") for n in names]


def regression_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: n, mae, rmse, mape, pearson_r."""
    y, p = _doubles(actual, predicted)
    return df.agg(
        F.count(F.lit(1)).alias("n"), mae(y, p).alias("mae"), rmse(y, p).alias("rmse"),
        mape(y, p).alias("mape"), pearson(y, p).alias("pearson_r"),
    )


def model_scores(df: DataFrame, actual: str, models: dict[str, str], digits: int | None = None) -> DataFrame:
    """(model, MAE, RMSE, MAPE, Pearson_r) for several prediction columns in one pass."""
    pairs = ", ".join(f"'{label}', cast(`{column}` as double)" for label, column in models.items())
    long = df.select(F.col(actual).cast("double").alias("y"), F.expr(f"stack({len(models)}, {pairs}) as (model, p)"))
    y, p = F.col("y"), F.col("p")
    measures = {"MAE": mae(y, p), "RMSE": rmse(y, p), "MAPE": mape(y, p), "Pearson_r": pearson(y, p)}
    return long.groupBy("model").agg(*[
        (c if digits is None else F.round(c, digits)).alias(name) for name, c in measures.items()
    ])


def comparison_table(long: DataFrame, digits: int = 4) -> DataFrame:
    """(model, metric, value) → one row per model, one rounded column per metric.

    The metric names come from the rows, so the pivot lists them first: as many as there are metrics.
    """
    return long.groupBy("model").pivot("metric").agg(F.round(F.first("value"), digits))


def decile_lift(df: DataFrame, actual: str, predicted: str, groups: int = 10) -> DataFrame:
    """(decile, n_customers, mean_actual_clv, mean_predicted_clv, lift), decile 1 = highest predictions.

    Bins are right-closed between unique quantile edges, so equal predictions never split.
    """
    edges = quantiles(df, predicted, [i / groups for i in range(groups + 1)])
    edge_list = edges.select(F.array_distinct("q")).scalar()
    placed = df.select(
        F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p"), edge_list.alias("e")
    )
    inner = F.slice("e", 2, F.greatest(F.size("e") - 2, F.lit(0)))
    code = F.when(_known(F.col("p")), F.size(F.filter(inner, lambda e: e < F.col("p"))))
    bins = placed.select("y", "p", code.alias("code")).groupBy("code").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("y").alias("mean_actual_clv"),
        F.avg("p").alias("mean_predicted_clv"), F.sum("y").alias("sum_y"), F.count("y").alias("known"),
    )
    # At most ``groups`` rows from here on.
    whole = bins.agg(
        F.struct(F.max("code").alias("top"), F.try_divide(F.sum("sum_y"), F.sum("known")).alias("mean"))
    ).scalar()
    base = F.when(whole["mean"] == 0, F.lit(sys.float_info.epsilon)).otherwise(whole["mean"])
    return bins.where(F.col("code").isNotNull()).select(
        (whole["top"] - F.col("code") + 1).alias("decile"), "n_customers", "mean_actual_clv", "mean_predicted_clv",
        (F.col("mean_actual_clv") / base).alias("lift"),
    ).orderBy("decile")


def qini_coefficient(df: DataFrame, outcome: str, score: str, treatment: str, key: str = "customer_id") -> DataFrame:
    """One row (qini): area of the two-arm gain curve against random targeting.

    The curve is unbounded: the coefficient exceeds 1 for a steep ranking and is negative for a bad one.
    """
    rows = df.select(
        key, score,
        (F.col(outcome) * F.col(treatment)).alias("yt"), (F.col(outcome) * (1 - F.col(treatment))).alias("yc"),
        F.col(treatment).cast("bigint").alias("t"),
    )
    placement = place(rows, by_score(score, key), sums=["yt", "yc", "t"])
    size, ranked = whole(placement), unfold(placement)
    n, n_t = size["n"], size["t"]
    height = (
        F.try_divide(F.col("cum_yt").cast("double"), n_t.cast("double"))
        - F.try_divide(F.col("cum_yc").cast("double"), (n - n_t).cast("double"))
    )
    ends = F.when((F.col("rank") == 1) | (F.col("rank") == n), F.col("h"))
    curve = ranked.select("rank", height.alias("h"), n.alias("n"), n_t.alias("n_t"))
    parts = curve.agg(
        F.max("n").alias("n"), F.max("n_t").alias("n_t"), F.sum("h").alias("area"),
        F.sum(ends).alias("ends"), F.max(F.when(F.col("rank") == F.col("n"), F.col("h"))).alias("last"),
    )
    trapezoid = F.when(F.col("n") == 1, F.lit(0.0)).otherwise((F.col("area") - F.col("ends") / 2) / F.col("n"))
    return parts.select(
        F.when(F.col("n").isNull() | (F.col("n_t") == 0) | (F.col("n_t") == F.col("n")), F.lit(NAN))
        .when(F.col("last") == 0, F.lit(0.0))
        .otherwise(F.try_divide(trapezoid - F.col("last") / 2, F.abs(F.col("last") / 2)))
        .alias("qini")
    )


def residuals(predictions: DataFrame, actuals: DataFrame, predicted: str = "predicted_clv") -> DataFrame:
    """Predicted/actual pairs on common customers with the residual clipped to its 1 %–99 % range."""
    pairs = predictions.select("customer_id", F.col(predicted).cast("double").alias("predicted")).join(
        actuals.select("customer_id", F.coalesce("holdout_revenue", F.lit(0.0)).alias("actual")), "customer_id"
    ).withColumn("residual", F.col("actual") - F.col("predicted"))
    bounds = quantiles(pairs, "residual", [0.01, 0.99]).select("q").scalar()
    return pairs.withColumn("clipped", F.least(F.greatest("residual", bounds[0]), bounds[1]))
