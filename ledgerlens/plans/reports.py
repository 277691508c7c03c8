"""Report views: the customer master and what the report pages read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import by_score

# Action and colour of a segment without its own.
DEFAULT_SEGMENT_ACTION = "Target"
DEFAULT_SEGMENT_COLOR = "#4fd1c7"


def normal_id(df: DataFrame) -> DataFrame:
    """The key is called customer_id everywhere; tables may arrive with CustomerID."""
    return df.withColumnRenamed("CustomerID", "customer_id") if "CustomerID" in df.columns else df


def customer_master(customers: DataFrame, predictions: DataFrame, segments: DataFrame, uplift: DataFrame) -> DataFrame:
    """Features ⟕ predictions ⟕ segments ⟕ uplift; optional columns get their defaults."""
    customers, predictions, segments, uplift = map(normal_id, (customers, predictions, segments, uplift))
    named = [c for c in ("segment_name", "segment_action", "segment_color") if c in segments.columns]
    scored = [c for c in ("uplift_score", "incremental_rev") if c in uplift.columns]
    repeated = [c for c in predictions.columns if c != "customer_id" and c in customers.columns]
    master = (
        customers.drop(*repeated).join(predictions, "customer_id", "left")
        .join(segments.select("customer_id", *named), "customer_id", "left")
        .join(uplift.select("customer_id", *scored), "customer_id", "left")
    )
    if "incremental_rev" not in master.columns:
        master = master.withColumn("incremental_rev", F.col("uplift_score") * F.col("predicted_clv"))
    return master


def segment_summary(master: DataFrame) -> DataFrame:
    """(segment_name, count, avg_clv, avg_p_alive, segment_action, segment_color)."""
    def optional(name: str, default: str) -> Column:
        return F.min(name) if name in master.columns else F.min(F.lit(default))

    return master.where(F.col("segment_name").isNotNull()).groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("count"), F.avg("predicted_clv").alias("avg_clv"), F.avg("p_alive").alias("avg_p_alive"),
        optional("segment_action", DEFAULT_SEGMENT_ACTION).alias("segment_action"),
        optional("segment_color", DEFAULT_SEGMENT_COLOR).alias("segment_color"))


def filter_bounds(master: DataFrame) -> DataFrame:
    """One row: the ends of the two range filters."""
    return master.agg(F.min("predicted_clv").alias("min_clv"), F.max("predicted_clv").alias("max_clv"),
                      F.min("p_alive").alias("min_p_alive"), F.max("p_alive").alias("max_p_alive"))


def filtered(master: DataFrame, segment: str | None = None, clv: tuple[float, float] | None = None,
             alive: tuple[float, float] | None = None) -> DataFrame:
    """Segment equality and inclusive ranges."""
    if segment is not None:
        master = master.where(F.col("segment_name") == segment)
    if clv is not None:
        master = master.where(F.col("predicted_clv").between(*clv))
    if alive is not None:
        master = master.where(F.col("p_alive").between(*alive))
    return master


def kpis(master: DataFrame) -> DataFrame:
    """One row: customers, avg_clv, avg_p_alive_pct, total_clv, avg_uplift_pct."""
    return master.agg(
        F.count(F.lit(1)).alias("customers"), F.avg("predicted_clv").alias("avg_clv"),
        (F.avg("p_alive") * 100).alias("avg_p_alive_pct"), F.sum("predicted_clv").alias("total_clv"),
        (F.avg("uplift_score") * 100).alias("avg_uplift_pct"))


VIEW_COLUMNS = ("customer_id", "predicted_clv", "clv_lower", "clv_upper", "p_alive", "segment_name", "uplift_score")


def top_customers(master: DataFrame, n: int) -> DataFrame:
    shown = [c for c in VIEW_COLUMNS if c in master.columns]
    return master.orderBy(*by_score("predicted_clv")).limit(n).select(*shown)


def customer_lookup(master: DataFrame, customer_id: int) -> DataFrame:
    return master.where(F.col("customer_id") == customer_id).select(*[c for c in VIEW_COLUMNS if c in master.columns])
