"""Ridge stacking of two base predictions, fitted from one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.metrics import model_scores


@dataclass(frozen=True)
class StackModel:
    intercept: float
    bgf: float
    gbt: float


def ridge_parameters(df: DataFrame, target: str, bgf: str, gbt: str, alpha: float = 1.0) -> DataFrame:
    """One row (intercept, bgf, gbt): closed form on centred cross-moments, intercept unpenalised."""
    y, u, v = (F.col(c).cast("double") for c in (target, bgf, gbt))
    n = F.count(F.lit(1))
    moments = df.agg(
        F.avg(y).alias("my"), F.avg(u).alias("mu"), F.avg(v).alias("mv"),
        (F.var_pop(u) * n + F.lit(alpha)).alias("uu"), (F.var_pop(v) * n + F.lit(alpha)).alias("vv"),
        (F.covar_pop(u, v) * n).alias("uv"), (F.covar_pop(u, y) * n).alias("uy"), (F.covar_pop(v, y) * n).alias("vy"),
    )
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    b_u = F.try_divide(F.col("vv") * F.col("uy") - F.col("uv") * F.col("vy"), det)
    b_v = F.try_divide(F.col("uu") * F.col("vy") - F.col("uv") * F.col("uy"), det)
    return moments.select("my", "mu", "mv", b_u.alias("bgf"), b_v.alias("gbt")).select(
        (F.col("my") - F.col("bgf") * F.col("mu") - F.col("gbt") * F.col("mv")).alias("intercept"), "bgf", "gbt")


def fit(df: DataFrame, target: str, bgf: str, gbt: str, alpha: float = 1.0) -> StackModel:
    return StackModel(**ridge_parameters(df, target, bgf, gbt, alpha).first().asDict())


def stacked(model: StackModel, bgf: Column, gbt: Column) -> Column:
    return F.lit(model.intercept) + F.lit(model.bgf) * bgf + F.lit(model.gbt) * gbt


def evaluate(df: DataFrame, target: str, bgf: str, gbt: str, final: str) -> DataFrame:
    """(model, MAE, RMSE, MAPE) of the three variants, two digits."""
    models = {"BG/NBD + Gamma-Gamma": bgf, "LightGBM": gbt, "Stacked Ensemble": final}
    return model_scores(df, target, models, digits=2).drop("Pearson_r")


def final_predictions(matrix: DataFrame, probabilities: DataFrame, boosted: DataFrame, model: StackModel) -> DataFrame:
    """(customer_id, predicted_clv, predicted_clv_bgnbd, predicted_clv_lgbm, p_alive) for every matrix customer."""
    joined = (
        matrix.select("customer_id")
        .join(probabilities.select("customer_id", F.col("predicted_clv").alias("bgf"), "p_alive"), "customer_id", "left")
        .join(boosted.select("customer_id", F.col("prediction").alias("gbt")), "customer_id", "left")
        .na.fill(0.0, ["bgf", "gbt", "p_alive"])
    )
    return joined.select(
        "customer_id", stacked(model, F.col("bgf"), F.col("gbt")).alias("predicted_clv"),
        F.col("bgf").alias("predicted_clv_bgnbd"), F.col("gbt").alias("predicted_clv_lgbm"), "p_alive")
