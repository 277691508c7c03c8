"""Report views over the customer master."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.plans import reports
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import fragment, query

fragment("master", """
 SELECT r.customer_id, r.frequency, r.recency, r.monetary_value, p.predicted_clv, p.p_alive, p.clv_lower, p.clv_upper,
   g.segment_name, u.uplift_score, u.uplift_score * p.predicted_clv AS incremental_rev
 FROM rfm r
 LEFT JOIN (SELECT customer_id, predicted_clv, p_alive, predicted_clv - 500 AS clv_lower, predicted_clv + 500 AS clv_upper
            FROM scores) p USING (customer_id)
 LEFT JOIN (SELECT customer_id, segment_name FROM scores) g USING (customer_id)
 LEFT JOIN (SELECT customer_id, uplift_score FROM scores) u USING (customer_id)""", ["rfm", "scores"])


def master(spark, sf):
    frame, key = inputs.score_frame(spark, sf), F.col("customer_id")
    predictions = frame.select(
        key.alias("CustomerID"), "predicted_clv", "p_alive", (F.col("predicted_clv") - 500).alias("clv_lower"),
        (F.col("predicted_clv") + 500).alias("clv_upper"))
    return reports.customer_master(
        inputs.rfm(spark, sf).drop("T"), predictions,
        frame.select("customer_id", "segment_name"),
        frame.select(key.alias("CustomerID"), "uplift_score"))


@query("report_customer_master", "SELECT * FROM master", ["master"])
def report_customer_master(spark, sf):
    return master(spark, sf)


@query("report_segment_summary", """
 SELECT segment_name, count(*) AS count, round(avg(predicted_clv), 6) AS avg_clv, round(avg(p_alive), 6) AS avg_p_alive,
   'Target' AS segment_action, '#4fd1c7' AS segment_color FROM master WHERE segment_name IS NOT NULL GROUP BY 1""", ["master"])
def report_segment_summary(spark, sf):
    table = reports.segment_summary(master(spark, sf))
    return table.withColumns({"avg_clv": F.round("avg_clv", 6), "avg_p_alive": F.round("avg_p_alive", 6)})


@query("report_filter_bounds", """
 SELECT min(predicted_clv) AS min_clv, max(predicted_clv) AS max_clv, min(p_alive) AS min_p_alive, max(p_alive) AS max_p_alive
 FROM master""", ["master"])
def report_filter_bounds(spark, sf):
    return reports.filter_bounds(master(spark, sf))


FILTER = "segment_name = 'Promising' AND predicted_clv BETWEEN 5000 AND 45000 AND p_alive BETWEEN 0.2::DOUBLE AND 0.9::DOUBLE"


def narrowed(spark, sf):
    return reports.filtered(master(spark, sf), "Promising", (5000, 45000), (0.2, 0.9))


@query("report_filtered", f"SELECT customer_id, predicted_clv, p_alive FROM master WHERE {FILTER}", ["master"])
def report_filtered(spark, sf):
    return narrowed(spark, sf).select("customer_id", "predicted_clv", "p_alive")


@query("report_kpis", f"""
 SELECT count(*) AS customers, round(avg(predicted_clv), 6) AS avg_clv, round(avg(p_alive) * 100, 6) AS avg_p_alive_pct,
   CAST(sum(predicted_clv) AS BIGINT) AS total_clv, round(avg(uplift_score) * 100, 6) AS avg_uplift_pct FROM master WHERE {FILTER}""", ["master"])
def report_kpis(spark, sf):
    table = reports.kpis(narrowed(spark, sf))
    return table.withColumns({c: F.round(c, 6) for c in ("avg_clv", "avg_p_alive_pct", "avg_uplift_pct")})


VIEW = "customer_id, predicted_clv, clv_lower, clv_upper, p_alive, segment_name, uplift_score"


@query("report_top_customers", f"SELECT {VIEW} FROM master ORDER BY predicted_clv DESC NULLS LAST, customer_id LIMIT 100", ["master"])
def report_top_customers(spark, sf):
    return reports.top_customers(master(spark, sf), 100)


@query("report_customer_lookup", f"SELECT {VIEW} FROM master WHERE customer_id = 77", ["master"])
def report_customer_lookup(spark, sf):
    return reports.customer_lookup(master(spark, sf), 77)
