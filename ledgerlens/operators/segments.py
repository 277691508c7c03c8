"""Mixture-model segments: inputs, choice of k, naming and profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixtureModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.config import DEFAULT_ACTION, SEGMENT_ACTIONS, SEGMENT_NAMES
from ledgerlens.operators import mixture
from ledgerlens.operators.stability import materialise

INPUTS = ("log1p_clv", "p_alive", "recency_days")
TOLERANCE = 1e-3  # change of the log-likelihood at which a start stands still


def _filled(name: str) -> Column:
    c = F.col(name).cast("double")
    return F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(0.0))


def segment_inputs(df: DataFrame) -> DataFrame:
    """(customer_id, log1p_clv, p_alive, recency_days) without gaps; negative values count as 0."""
    return df.select(
        "customer_id", F.log1p(F.greatest(_filled("predicted_clv"), F.lit(0.0))).alias("log1p_clv"),
        _filled("p_alive").alias("p_alive"), _filled("recency_days").alias("recency_days"))


def standardise(df: DataFrame, columns: Sequence[str] = INPUTS) -> DataFrame:
    """(x − mean) / population deviation as columns; a constant column becomes 0."""
    parts = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])).scalar()
    return df.withColumns({
        c: F.coalesce(F.try_divide(F.col(c) - parts[c]["m"], parts[c]["s"]), F.lit(0.0)) for c in columns})


@dataclass(frozen=True)
class SegmentModel:
    scaler: StandardScalerModel
    mixture: GaussianMixtureModel
    names: dict[int, str]
    bic: dict[int, float]


def _vector(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(INPUTS), outputCol="_raw").transform(df)


def bic(log_likelihood: float, k: int, n: int, d: int = len(INPUTS)) -> float:
    free = (k - 1) + k * d + k * d * (d + 1) // 2
    return -2.0 * log_likelihood + free * math.log(n)


def fit(df: DataFrame, k_range: Sequence[int] = (5,), select_starts: int = 3, final_starts: int = 5,
        select_rounds: int = 300, final_rounds: int = 500, seed: int = 42) -> SegmentModel:
    """Smallest-BIC number of components, then the best of several starts, then names from centroids.

    The starts of a step go through the rows together.  Those of the chosen k that the choice has seen are the same
    in the last step, so they go on from where they stood.
    """
    raw = _vector(segment_inputs(df))
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(raw)
    rows = materialise(scaler.transform(raw)).persist(StorageLevel.MEMORY_AND_DISK)
    n = rows.count()
    blocks = mixture.packed(rows, "_scaled", n)
    drawn, scores = {}, {}
    try:
        if len(k_range) > 1:
            starts = [(k, seed + i) for k in k_range for i in range(select_starts)]
            drawn = {(f.k, f.seed): f for f in mixture.draw(rows, starts, "_scaled")}
            drawn |= {(f.k, f.seed): f for f in mixture.advance(blocks, list(drawn.values()), select_rounds, TOLERANCE)}
            scores = {k: bic(max(f.log_likelihood for f in drawn.values() if f.k == k), k, n) for k in k_range}
        k = min(scores, key=scores.get) if scores else k_range[0]
        known = [f for i in range(final_starts) if (f := drawn.get((k, seed + i))) and f.rounds <= final_rounds]
        more = [(k, seed + i) for i in range(final_starts) if (k, seed + i) not in {(f.k, f.seed) for f in known}]
        fits = mixture.advance(blocks, [*known, *mixture.draw(rows, more, "_scaled")], final_rounds, TOLERANCE)
    finally:
        blocks.unpersist()
    best = max(sorted(fits, key=lambda f: f.seed), key=lambda f: f.log_likelihood)
    if not scores:
        scores = {k: bic(best.log_likelihood, k, n)}
    model = mixture.spark_model(best, "_scaled", final_rounds, TOLERANCE)
    clustered = model.setPredictionCol("segment_id").transform(rows)
    names = {row["segment_id"]: row["segment_name"] for row in cluster_names(clustered).collect()}  # at most k rows
    rows.unpersist()
    return SegmentModel(scaler, model, names, scores)


def store_model(store, model: SegmentModel) -> None:
    """Scaler, mixture, names and BIC under the names ``model_segment_*``."""
    store.write_model("model_segment_scaler", model.scaler)
    store.write_model("model_segment_mixture", model.mixture)
    spark = store.spark
    store.write("model_segment_names", spark.createDataFrame(list(model.names.items()), "segment_id int, segment_name string"))
    store.write("model_segment_bic", spark.createDataFrame([(k, float(v)) for k, v in model.bic.items()], "k int, bic double"))


def load_model(store) -> SegmentModel:
    names = {r["segment_id"]: r["segment_name"] for r in store.read("model_segment_names").collect()}  # k rows
    scores = {r["k"]: r["bic"] for r in store.read("model_segment_bic").collect()}  # one row per tried k
    return SegmentModel(
        store.read_model("model_segment_scaler", StandardScalerModel),
        store.read_model("model_segment_mixture", GaussianMixtureModel), names, scores)


def predict(model: SegmentModel, df: DataFrame) -> DataFrame:
    """(customer_id, segment_id)."""
    rows = model.scaler.transform(_vector(segment_inputs(df)))
    return model.mixture.setPredictionCol("segment_id").transform(rows).select("customer_id", "segment_id")


def cluster_names(clustered: DataFrame) -> DataFrame:
    """(segment_id, segment_name) from centroids in raw units; k rows after the aggregation.

    The runner-up is At-Risk only when its P(alive) lies in the lower half; otherwise it shares the
    name Promising with the cluster ranked third.
    """
    centers = clustered.groupBy("segment_id").agg(F.avg("log1p_clv").alias("clv"), F.avg("p_alive").alias("alive"))
    by_worth = Window.orderBy((F.col("clv") * 0.6 + F.col("alive") * 0.4).desc(), "segment_id")
    by_alive = Window.orderBy("alive", "segment_id")
    placed = centers.select(
        "segment_id", F.row_number().over(by_worth).alias("place"),
        (F.row_number().over(by_alive) - 1).alias("alive_place"), F.count(F.lit(1)).over(Window.partitionBy()).alias("k"))
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    at_risk = F.col("alive_place") < F.floor(F.col("k") / 2)
    name = (
        F.when(F.col("place") == 2, F.when(at_risk, SEGMENT_NAMES[1]).otherwise(SEGMENT_NAMES[2]))
        .when(F.col("place") <= len(SEGMENT_NAMES), F.element_at(names, F.least(F.col("place"), F.lit(len(SEGMENT_NAMES)))))
        .otherwise(F.concat(F.lit("Segment-"), F.col("segment_id").cast("string")))
    )
    return placed.select("segment_id", name.alias("segment_name"))


def label_segments(df: DataFrame, names: dict[int, str]) -> DataFrame:
    """Add ``segment_name``; ids without a name become Unknown."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    known = F.element_at(F.create_map(*pairs), F.col("segment_id")) if pairs else F.lit(None).cast("string")
    return df.withColumn("segment_name", F.coalesce(known, F.lit("Unknown")))


def label_from_table(df: DataFrame, names: DataFrame) -> DataFrame:
    """The same with the mapping as a table of at most k rows."""
    return df.join(names, "segment_id", "left").withColumn(
        "segment_name", F.coalesce("segment_name", F.lit("Unknown")))


def profiles(df: DataFrame) -> DataFrame:
    """(segment_name, count, avg_clv, avg_p_alive, avg_recency, recommended_action), richest first."""
    pairs = [F.lit(part) for item in SEGMENT_ACTIONS.items() for part in item]
    action = F.coalesce(F.element_at(F.create_map(*pairs), F.col("segment_name")), F.lit(DEFAULT_ACTION))
    return df.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("count"), F.avg("predicted_clv").alias("clv"), F.avg("p_alive").alias("alive"),
        F.avg("recency_days").alias("recency"),
    ).orderBy(F.desc("clv"), "segment_name").select(
        "segment_name", "count", F.round("clv", 2).alias("avg_clv"), F.round("alive", 4).alias("avg_p_alive"),
        F.round("recency", 1).alias("avg_recency"), action.alias("recommended_action"))


def shares(df: DataFrame) -> DataFrame:
    """(segment_name, count, share); the window runs over one row per segment."""
    counted = df.groupBy("segment_name").agg(F.count(F.lit(1)).alias("count"))
    whole = F.sum("count").over(Window.partitionBy())
    return counted.withColumn("share", F.col("count").cast("double") / whole.cast("double")).orderBy(F.desc("count"), "segment_name")


def short_profiles(df: DataFrame) -> DataFrame:
    """Notebook variant: (segment_name, count, avg_clv_text, avg_p_alive)."""
    return df.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg("predicted_clv"), 2).alias("clv"),
        F.round(F.avg("p_alive"), 2).alias("avg_p_alive"),
    ).orderBy(F.desc("clv")).select(
        "segment_name", "count", F.concat(F.lit("INR "), F.format_number("clv", 0)).alias("avg_clv_text"), "avg_p_alive")
