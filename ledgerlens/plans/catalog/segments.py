"""Segment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.config import SEGMENT_ACTIONS
from ledgerlens.operators import segments
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import fragment, query

fragment("seg_inputs", """
 SELECT customer_id, ln(1 + greatest(predicted_clv - 10000, 0)::DOUBLE) AS log1p_clv, p_alive,
   recency_days::DOUBLE AS recency_days, customer_id % 6 AS segment_id FROM scores""", ["scores"])


def seg_inputs(spark, sf):
    """Values below 10,000 turn negative here, so the floor at 0 has work to do."""
    frame = inputs.score_frame(spark, sf).withColumn("predicted_clv", F.col("predicted_clv") - 10000)
    return segments.segment_inputs(frame)


def clustered(spark, sf):
    return seg_inputs(spark, sf).withColumn("segment_id", (F.col("customer_id") % 6).cast("int"))


@query("segment_inputs", "SELECT customer_id, round(log1p_clv, 9) AS log1p_clv, p_alive, recency_days FROM seg_inputs", ["seg_inputs"])
def segment_inputs(spark, sf):
    return seg_inputs(spark, sf).withColumn("log1p_clv", F.round("log1p_clv", 9))


@query("segment_standardised", "SELECT customer_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM seg_inputs)) / (SELECT stddev_pop({c}) FROM seg_inputs), 8) AS {c}"
    for c in segments.INPUTS) + " FROM seg_inputs", ["seg_inputs"])
def segment_standardised(spark, sf):
    table = segments.standardise(seg_inputs(spark, sf))
    return table.select("customer_id", *[F.round(c, 8).alias(c) for c in segments.INPUTS])


fragment("cluster_names", """
 WITH c AS (SELECT segment_id, avg(log1p_clv) AS clv, avg(p_alive) AS alive FROM seg_inputs GROUP BY 1),
 p AS (SELECT segment_id, row_number() OVER (ORDER BY clv * 0.6 + alive * 0.4 DESC, segment_id) AS place,
   row_number() OVER (ORDER BY alive, segment_id) - 1 AS alive_place, count(*) OVER () AS k FROM c)
 SELECT CAST(segment_id AS INTEGER) AS segment_id, CASE place WHEN 1 THEN 'Champions'
   WHEN 2 THEN CASE WHEN alive_place < k // 2 THEN 'At-Risk High-Value' ELSE 'Promising' END
   WHEN 3 THEN 'Promising' WHEN 4 THEN 'Hibernating' WHEN 5 THEN 'Lost' ELSE 'Segment-' || segment_id END AS segment_name
 FROM p""", ["seg_inputs"])


@query("segment_cluster_names", "SELECT * FROM cluster_names", ["cluster_names"])
def segment_cluster_names(spark, sf):
    return segments.cluster_names(clustered(spark, sf))


@query("segment_labels", """
 SELECT s.customer_id, CAST(s.id AS INTEGER) AS segment_id, coalesce(n.segment_name, 'Unknown') AS segment_name
 FROM (SELECT customer_id, customer_id % 8 AS id FROM scores) s LEFT JOIN cluster_names n ON n.segment_id = s.id""",
       ["scores", "cluster_names"])
def segment_labels(spark, sf):
    """Eight ids against six names: two ids stay Unknown."""
    frame = inputs.score_frame(spark, sf).select("customer_id", (F.col("customer_id") % 8).cast("int").alias("segment_id"))
    return segments.label_from_table(frame, segments.cluster_names(clustered(spark, sf))).select(
        "customer_id", "segment_id", "segment_name")


ACTION = "CASE segment_name " + " ".join(f"WHEN '{n}' THEN '{a}'" for n, a in SEGMENT_ACTIONS.items()) + " ELSE 'Review manually' END"
NAMED = "SELECT * REPLACE (CASE WHEN customer_id % 11 = 0 THEN 'Segment-9' ELSE segment_name END AS segment_name) FROM scores"


def named(spark, sf):
    return inputs.score_frame(spark, sf).withColumn(
        "segment_name", F.when(F.col("customer_id") % 11 == 0, "Segment-9").otherwise(F.col("segment_name")))


@query("segment_profiles", f"""
 SELECT segment_name, count(*) AS count, round(avg(predicted_clv), 2) AS avg_clv, round(avg(p_alive), 4) AS avg_p_alive,
   round(avg(recency_days), 1) AS avg_recency, {ACTION} AS recommended_action FROM ({NAMED}) GROUP BY segment_name""", ["scores"])
def segment_profiles(spark, sf):
    return segments.profiles(named(spark, sf))


@query("segment_shares", f"""
 SELECT segment_name, count(*) AS count, count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE AS share FROM ({NAMED}) GROUP BY 1""", ["scores"])
def segment_shares(spark, sf):
    return segments.shares(named(spark, sf))


@query("segment_short_profiles", f"""
 SELECT segment_name, count(*) AS count, 'INR ' || format('{{:,}}', CAST(round(avg(predicted_clv)) AS BIGINT)) AS avg_clv_text,
   round(avg(p_alive), 2) AS avg_p_alive FROM ({NAMED}) GROUP BY 1""", ["scores"])
def segment_short_profiles(spark, sf):
    return segments.short_profiles(named(spark, sf))


@query("segment_mixture")
def segment_mixture(spark, sf):
    """Customers with cluster and name from a fitted mixture."""
    frame = inputs.rfm(spark, sf).select(
        "customer_id", F.col("monetary_value").alias("predicted_clv"),
        (1.0 / (1.0 + F.exp((F.col("T") - F.col("recency")) / 200.0 - 2.0))).alias("p_alive"), F.col("recency").alias("recency_days"))
    from ledgerlens.operators.stability import materialise
    frame = materialise(frame)
    model = segments.fit(frame, k_range=(3, 4, 5))
    return segments.label_segments(segments.predict(model, frame), model.names)
