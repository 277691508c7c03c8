"""Boosted-tree regression on Spark ML: training, seeded search, attributions."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.splits import fold_id
from ledgerlens.operators.quantiles import melt
from ledgerlens.operators.stability import checkpoint_folder, materialise

VECTOR = "_inputs"


@dataclass(frozen=True)
class BoostParams:
    """Published defaults.  ``max_depth`` −1: no limit but ``num_leaves``.

    Spark's own trees (this module) know neither leaf limits nor penalties: there the depth of as many leaves stands for the limit.
    """

    n_estimators: int = 500
    learning_rate: float = 0.05
    max_depth: int = -1
    min_child_samples: int = 20
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42
    num_leaves: int = 31
    reg_alpha: float = 0.1
    reg_lambda: float = 0.1

    def levels(self) -> int:
        return self.max_depth if self.max_depth >= 0 else max(1, math.ceil(math.log2(self.num_leaves)))


TWO_ARM = BoostParams(n_estimators=300, max_depth=6)
INTERVAL_BASE = BoostParams(n_estimators=200)

# The published search ranges.
SEARCH_SPACE = {
    "n_estimators": (100, 1500),
    "learning_rate": (0.005, 0.3),
    "max_depth": (3, 12),
    "min_child_samples": (5, 100),
    "subsample": (0.5, 1.0),
    "colsample": (0.3, 1.0),
}


def vectors(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(inputs), outputCol=VECTOR).transform(df)


def estimator(label: str, params: BoostParams) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=VECTOR, labelCol=label, maxIter=params.n_estimators, stepSize=params.learning_rate,
        maxDepth=params.levels(), minInstancesPerNode=params.min_child_samples, subsamplingRate=params.subsample,
        featureSubsetStrategy="all" if params.colsample >= 1.0 else str(params.colsample), seed=params.seed,
        checkpointInterval=10,
    )


def train(df: DataFrame, inputs: Sequence[str], label: str, params: BoostParams = BoostParams()) -> GBTRegressionModel:
    checkpoint_folder(df.sparkSession)  # long boosting runs cut their lineage there
    rows = df.select(*inputs, F.col(label).cast("double").alias(label))
    return estimator(label, params).fit(vectors(rows, inputs).select(VECTOR, label))


def predict(model: GBTRegressionModel, df: DataFrame, inputs: Sequence[str], alias: str = "prediction") -> DataFrame:
    return model.setPredictionCol(alias).transform(vectors(df, inputs)).drop(VECTOR)


def draw_trials(n: int, seed: int = 42, space: dict = SEARCH_SPACE) -> list[BoostParams]:
    """Seeded draws: whole numbers uniform, the learning rate log-uniform, shares uniform."""
    source, trials = random.Random(seed), []
    for _ in range(n):
        trials.append(BoostParams(
            n_estimators=source.randint(*space["n_estimators"]),
            learning_rate=math.exp(source.uniform(*[math.log(v) for v in space["learning_rate"]])),
            max_depth=source.randint(*space["max_depth"]),
            min_child_samples=source.randint(*space["min_child_samples"]),
            subsample=source.uniform(*space["subsample"]),
            colsample=round(source.uniform(*space["colsample"]), 4),
            seed=seed,
        ))
    return trials


def tune(df: DataFrame, inputs: Sequence[str], label: str, trials: Sequence[BoostParams], folds: int = 5,
         parallelism: int = 4, key: str = "customer_id") -> tuple[BoostParams, list[float]]:
    """Best trial by cross-validated MAE, and the MAE of every trial; folds depend on the key only."""
    rows = materialise(vectors(df.select(key, *inputs, F.col(label).cast("double").alias(label)), inputs)
                       .select(VECTOR, label, fold_id(key, folds).alias("fold")))
    base = estimator(label, trials[0])
    names = (("maxIter", "n_estimators"), ("stepSize", "learning_rate"), ("maxDepth", "max_depth"),
             ("minInstancesPerNode", "min_child_samples"), ("subsamplingRate", "subsample"))
    maps = []
    for trial in trials:
        options = {base.getParam(spark_name): trial.levels() if ours == "max_depth" else getattr(trial, ours) for spark_name, ours in names}
        options[base.featureSubsetStrategy] = "all" if trial.colsample >= 1.0 else str(trial.colsample)
        maps.append(options)
    search = CrossValidator(
        estimator=base, estimatorParamMaps=maps, numFolds=folds, foldCol="fold", parallelism=parallelism,
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mae"),
    ).fit(rows)
    errors = list(search.avgMetrics)
    return trials[min(range(len(errors)), key=errors.__getitem__)], errors


def out_of_fold(df: DataFrame, inputs: Sequence[str], label: str, params: BoostParams, folds: int = 5,
                key: str = "customer_id") -> DataFrame:
    """(key, label, oof): every customer predicted by a model that has not seen them."""
    rows = materialise(df.select(key, *inputs, F.col(label).cast("double").alias(label))
                       .withColumn("fold", fold_id(key, folds)))
    parts = None
    for fold in range(folds):
        model = train(rows.where(F.col("fold") != fold), inputs, label, params)
        part = predict(model, rows.where(F.col("fold") == fold), inputs, "oof").select(key, label, "oof")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def attributions(model: GBTRegressionModel, df: DataFrame, inputs: Sequence[str], permutations: int = 4,
                 seed: int = 42, key: str = "customer_id") -> DataFrame:
    """(key, feature, contribution, base_value): sampled Shapley values against the mean customer.

    Along each random feature order a customer's values replace the background one by one; the gain
    of each step goes to its feature.  A step's prediction is added to the feature just set and
    taken from the one set next, so one map-side-combined sum replaces a window, and
    base + Σ contributions equals the prediction for every order, hence for the average.
    """
    names, d = list(inputs), len(inputs)
    source = random.Random(seed)
    orders = [source.sample(range(d), d) for _ in range(permutations)]
    center = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()  # one value per feature
    background = F.array(*[F.lit(float(center[c])) for c in names])
    order_list = F.array(*[F.array(*[F.lit(j) for j in order]) for order in orders])
    steps = (
        df.select(key, F.array(*[F.col(c).cast("double") for c in names]).alias("x"), background.alias("m"))
        .select("*", F.explode(order_list).alias("order"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("done"))
    )
    mixed = F.transform(F.col("x"), lambda value, j: F.when(
        F.array_position("order", j) <= F.col("done"), value).otherwise(F.element_at("m", j + 1)))
    scored = model.setPredictionCol("_p").transform(
        steps.select(key, "order", "done", array_to_vector(mixed).alias(VECTOR)))
    label = F.array(*[F.lit(c) for c in names])

    def feature_at(place):
        return F.element_at(label, F.element_at("order", place) + 1)

    moves = F.array_compact(F.array(
        F.when(F.col("done") >= 1, F.struct(feature_at(F.greatest(F.col("done"), F.lit(1))).alias("feature"), F.col("_p").alias("gain"))),
        F.when(F.col("done") < d, F.struct(feature_at(F.least(F.col("done") + 1, F.lit(d))).alias("feature"), (-F.col("_p")).alias("gain"))),
    ))
    # Every order starts from the same background row, so its prediction is the common base.
    base = model.predict(_dense([float(center[c]) for c in names]))
    return scored.select(key, F.inline(moves)).groupBy(key, "feature").agg(
        (F.sum("gain") / permutations).alias("contribution")).withColumn("base_value", F.lit(float(base)))


def _dense(values):
    from pyspark.ml.linalg import Vectors
    return Vectors.dense(values)


def linear_parts(df: DataFrame, coefficients: dict[str, float], intercept: float = 0.0, key: str = "customer_id") -> DataFrame:
    """(key, base_value, one column per input): exact attributions of a linear model, coefficient × (value − mean)."""
    names = list(coefficients)
    center = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in names])).scalar()
    base = F.lit(float(intercept))
    for c in names:
        base = base + F.lit(float(coefficients[c])) * center[c]
    return df.select(key, base.alias("base_value"), *[
        (F.lit(float(coefficients[c])) * (F.col(c).cast("double") - center[c])).alias(c) for c in names])


def linear_attributions(df: DataFrame, coefficients: dict[str, float], intercept: float = 0.0,
                        key: str = "customer_id") -> DataFrame:
    """(key, base_value, feature, contribution) of :func:`linear_parts`."""
    names = list(coefficients)
    parts = linear_parts(df, coefficients, intercept, key)
    return melt(parts, names, keep=[key, "base_value"], name="feature").withColumnRenamed("value", "contribution")


def _waterfall_rows(top: int) -> Column:
    """Rows of a customer from columns ``base`` and ``parts`` (feature, contribution), strongest first."""
    row = lambda position, label, amount: F.struct(
        position.cast("int").alias("position"), label.alias("label"), amount.alias("amount"))
    ordered = F.array_sort(F.transform("parts", lambda p: F.struct(
        (-F.abs(p["contribution"])).alias("r"), p["feature"].alias("feature"), p["contribution"].alias("contribution"))))
    total = lambda some: F.aggregate(some, F.lit(0.0), lambda s, p: s + p["contribution"])
    best, rest = F.slice(ordered, 1, top), F.slice(ordered, top + 1, F.greatest(F.size("parts"), F.lit(1)))
    return F.concat(
        F.array(row(F.lit(0), F.lit("Base"), F.col("base"))),
        F.transform(best, lambda p, i: row(i + 1, p["feature"], p["contribution"])),
        F.array(row(F.lit(top + 1), F.lit("Others"), total(rest)),
                row(F.lit(top + 2), F.lit("Predicted CLV"), F.col("base") + total(F.col("parts")))))


def waterfall_of_parts(parts: DataFrame, names: Sequence[str], top: int = 4, key: str = "customer_id") -> DataFrame:
    """:func:`waterfall` of (key, base_value, one column per feature): contributions are sorted inside the row, nothing is exchanged."""
    listed = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("contribution")) for n in names])
    return parts.select(key, F.col("base_value").alias("base"), listed.alias("parts")).select(key, F.inline(_waterfall_rows(top)))


def waterfall(contributions: DataFrame, top: int = 4, key: str = "customer_id") -> DataFrame:
    """(key, position, label, amount): base, the strongest features, Others, and the prediction.

    A customer's contributions, as many as there are features, are gathered once and sorted in the row.
    """
    grouped = contributions.groupBy(key).agg(
        F.first("base_value").alias("base"), F.collect_list(F.struct("feature", "contribution")).alias("parts"))
    return grouped.select(key, F.inline(_waterfall_rows(top)))


def global_importance(contributions: DataFrame) -> DataFrame:
    """(feature, importance) = mean absolute contribution, strongest first."""
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance")).orderBy(
        F.desc("importance"), "feature")


def split_importance(model: GBTRegressionModel, inputs: Sequence[str]) -> DataFrame:
    """(feature, importance) as the trees report it; one row per input."""
    from pyspark.sql import SparkSession
    values = model.featureImportances.toArray()
    return SparkSession.active().createDataFrame(
        [(name, float(v)) for name, v in zip(inputs, values)], "feature string, importance double")
