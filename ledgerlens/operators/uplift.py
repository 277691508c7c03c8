"""Two-arm uplift: assignment, two-model learner, ranking and the Qini curve."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.splits import fold_id, treatment_flag
from ledgerlens.operators.ranking import by_score, place, unfold, whole

# Targeting classes by share of the ranking.
TARGET_CLASSES = (("Persuadable", 0.10), ("Favourable", 0.30))
OTHER_CLASS = "Neutral/Negative"


def assign_arms(df: DataFrame, share: float = 0.30, key: str = "customer_id") -> DataFrame:
    """Add ``treatment`` (0/1) from the key alone; replace it by an exposure column where one exists."""
    return df.withColumn("treatment", treatment_flag(key, share))


def arm_summary(df: DataFrame, outcome: str) -> DataFrame:
    return df.groupBy("treatment").agg(F.count(F.lit(1)).alias("n"), F.avg(outcome).alias("mean_outcome"))


def rank_by_uplift(df: DataFrame, score: str = "uplift_score") -> DataFrame:
    """(customer_id, uplift_score, uplift_rank, segment): rank 1..n, classes by share of n."""
    placement = place(df.select("customer_id", F.col(score).alias("uplift_score")), by_score("uplift_score"))
    n, ranked = whole(placement)["n"], unfold(placement)
    segment = F.lit(OTHER_CLASS)
    for name, share in reversed(TARGET_CLASSES):
        segment = F.when(F.col("rank") <= F.floor(n * F.lit(share)), name).otherwise(segment)
    return ranked.select("customer_id", "uplift_score", F.col("rank").alias("uplift_rank"), segment.alias("segment"))


def top_persuadable(ranked: DataFrame, k: int = 10) -> DataFrame:
    return ranked.where(F.col("segment") == "Persuadable").orderBy(*by_score("uplift_score")).limit(k)


def qini_curve(df: DataFrame, outcome: str, score: str, treatment: str = "treatment",
               key: str = "customer_id", points: int = 100) -> DataFrame:
    """(rank, fraction, qini_model, qini_random) at every n/points-th customer, the last, and the origin."""
    y, t = F.col(outcome), F.col(treatment)
    rows = df.select(key, score, (y * t).alias("yt"), (y * (1 - t)).alias("yc"), t.cast("bigint").alias("t"))
    placement = place(rows, by_score(score, key), sums=["yt", "yc", "t"])
    size, ranked = whole(placement), unfold(placement)

    def lift(yt, yc, nt, nc):
        one = F.lit(1)
        return (yt.cast("double") / F.greatest(nt, one) - yc.cast("double") / F.greatest(nc, one)) * nt

    n = size["n"]
    every = F.greatest(F.floor(n / points).cast("bigint"), F.lit(1).cast("bigint"))
    fraction = F.col("rank").cast("double") / n
    total_gain = lift(size["yt"], size["yc"], size["t"], n - size["t"])
    curve = ranked.where((F.col("rank") % every == 0) | (F.col("rank") == n)).select(
        "rank", fraction.alias("fraction"),
        (lift(F.col("cum_yt"), F.col("cum_yc"), F.col("cum_t"), F.col("rank") - F.col("cum_t")) * fraction).alias("qini_model"),
        (total_gain * fraction).alias("qini_random"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("rank"), *[F.lit(0.0).alias(c) for c in ("fraction", "qini_model", "qini_random")])
    return origin.unionByName(curve)


def fit_t_learner(df: DataFrame, inputs, outcome: str, treatment: str = "treatment", params=None):
    """One boosted regressor per arm: (treated model, control model)."""
    from ledgerlens.operators.boosting import TWO_ARM
    from ledgerlens.operators.forest import train
    settings = params or TWO_ARM
    return (
        train(df.where(F.col(treatment) == 1), inputs, outcome, settings),
        train(df.where(F.col(treatment) == 0), inputs, outcome, settings),
    )


def cross_fitted(df: DataFrame, inputs, outcome: str, treatment: str = "treatment", params=None, folds: int = 5,
                 key: str = "customer_id") -> DataFrame:
    """df plus ``uplift_score`` from models that have not seen the row's fold, for curves that do not flatter."""
    from ledgerlens.operators.stability import materialise
    rows = materialise(df.withColumn("_fold", fold_id(key, folds, "uplift")))
    parts = []
    for fold in range(folds):
        models = fit_t_learner(rows.where(F.col("_fold") != fold), inputs, outcome, treatment, params)
        parts.append(predict_uplift(models, rows.where(F.col("_fold") == fold), inputs))
    return reduce(DataFrame.unionByName, parts).drop("_fold")


def predict_uplift(models, df: DataFrame, inputs) -> DataFrame:
    """df plus ``uplift_score`` = treated prediction − control prediction; both models score the same row."""
    from ledgerlens.operators.forest import predict
    treated, control = models
    scored = predict(control, predict(treated, df, inputs, "_treated"), inputs, "_control")
    return scored.withColumn("uplift_score", F.col("_treated") - F.col("_control")).drop("_treated", "_control")
