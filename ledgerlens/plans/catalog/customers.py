"""Customer features, cohorts, matrices and their exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import explore, features
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import SETTINGS, fragment, query

NUMERIC = ("frequency", "recency", "T", "monetary_value", "tenure_days", "active_months", "n_orders", "n_items",
           "n_products", "avg_order_value", "max_order_value", "std_interpurchase_days", "return_rate",
           "cohort_index", "total_revenue")


@query("customers_rfm", "SELECT * FROM rfm", ["rfm"])
def customers_rfm(spark, sf):
    return inputs.rfm(spark, sf)


@query("customers_holdout", "SELECT * FROM actuals", ["actuals"])
def customers_holdout(spark, sf):
    return inputs.actuals(spark, sf)


@query("customers_top_holdout", """
 SELECT r.*, a.holdout_revenue FROM rfm r JOIN actuals a USING (customer_id)
 ORDER BY a.holdout_revenue DESC, r.customer_id LIMIT 20""", ["rfm", "actuals"])
def customers_top_holdout(spark, sf):
    """The flagship: who bought most after the cut-off, and what did we know about them before it."""
    tx = inputs.tx(spark, sf)
    from ledgerlens.operators.cleaning import temporal_split
    observed, held = temporal_split(tx, SETTINGS)
    return (
        features.rfm_summary(observed, SETTINGS.observation_end)
        .join(features.holdout_actuals(held), "customer_id")
        .orderBy(F.desc("holdout_revenue"), "customer_id").limit(20)
    )


@query("customers_features", "SELECT * FROM features", ["features"])
def customers_features(spark, sf):
    return inputs.customer_features(spark, sf)


@query("customers_cohorts", """
 SELECT customer_id, cohort_month, cohort_index, total_revenue FROM features""", ["features"])
def customers_cohorts(spark, sf):
    return inputs.customer_features(spark, sf).select("customer_id", "cohort_month", "cohort_index", "total_revenue")


fragment("retention", """
 WITH m AS (SELECT DISTINCT CustomerID AS customer_id, year(InvoiceDate) * 12 + month(InvoiceDate) - 1 AS month FROM obs),
 f AS (SELECT *, min(month) OVER (PARTITION BY customer_id) AS first FROM m),
 c AS (SELECT first, month - first AS month_num, count(*) AS n_active FROM f GROUP BY 1, 2)
 SELECT printf('%04d-%02d', first // 12, first % 12 + 1) AS cohort, CAST(month_num AS INTEGER) AS month_num, n_active,
   CAST(n_active AS DOUBLE) / CAST(max(n_active) FILTER (month_num = 0) OVER (PARTITION BY first) AS DOUBLE) AS retention
 FROM c""", ["obs"])


@query("cohort_retention", "SELECT * FROM retention", ["retention"])
def cohort_retention(spark, sf):
    return features.cohort_retention(inputs.observed(spark, sf))


@query("cohort_heatmap", "SELECT cohort, " + ", ".join(
    f"coalesce(max(retention) FILTER (month_num = {k}), 0.0) AS month_{k}" for k in range(13))
    + " FROM retention GROUP BY cohort", ["retention"])
def cohort_heatmap(spark, sf):
    return features.cohort_heatmap(features.cohort_retention(inputs.observed(spark, sf)))


fragment("q_rfm", f"""
 WITH d AS (SELECT CAST(date_trunc('quarter', InvoiceDate) AS DATE) AS qs, CustomerID AS customer_id,
   CAST(InvoiceDate AS DATE) AS day, CAST(sum(TotalPrice) AS BIGINT) AS revenue, count(*) AS n_lines
   FROM tx GROUP BY 1, 2, 3),
 busy AS (SELECT qs FROM d GROUP BY qs HAVING sum(n_lines) > {SETTINGS.min_quarter_rows})
 SELECT year(qs) || 'Q' || quarter(qs) AS quarter, customer_id, count(*) - 1 AS frequency,
   CAST(date_diff('day', min(day), max(day)) AS INTEGER) AS recency,
   CAST(date_diff('day', min(day), CAST(qs + INTERVAL 3 MONTH AS DATE) - 1) AS INTEGER) AS T,
   CASE WHEN count(*) > 1
     THEN CAST(CAST(sum(revenue) - arg_min(revenue, day) AS BIGINT) AS DOUBLE) / (count(*) - 1) / 10000.0
     ELSE 0.0 END AS monetary_value
 FROM d WHERE qs IN (SELECT qs FROM busy) GROUP BY qs, customer_id""", ["tx"])


@query("customers_quarterly_rfm", "SELECT * FROM q_rfm", ["q_rfm"])
def customers_quarterly_rfm(spark, sf):
    return features.quarterly_rfm(inputs.tx(spark, sf), SETTINGS.min_quarter_rows)


@query("customers_event_rfm", """
 WITH d AS (SELECT user_id AS customer_id, CAST(ts AS DATE) AS day,
   CAST(sum(CAST(round(value * 100) AS BIGINT) * 100) AS BIGINT) AS revenue
   FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
 SELECT customer_id, count(*) - 1 AS frequency, CAST(date_diff('day', min(day), max(day)) AS INTEGER) AS recency,
   CAST(date_diff('day', min(day), DATE '2024-01-31') AS INTEGER) AS T,
   CASE WHEN count(*) > 1
     THEN CAST(CAST(sum(revenue) - arg_min(revenue, day) AS BIGINT) AS DOUBLE) / (count(*) - 1) / 10000.0
     ELSE 0.0 END AS monetary_value
 FROM d GROUP BY customer_id""")
def customers_event_rfm(spark, sf):
    from datetime import date

    from ledgerlens.sources.retail import event_purchases
    return features.rfm_summary(event_purchases(spark, sf), date(2024, 1, 31))


fragment("stand_in", """
 SELECT customer_id, CAST(customer_id % 7 AS DOUBLE) AS predicted_purchases,
   CAST(customer_id % 10 AS DOUBLE) / 10.0 AS p_alive, CAST(customer_id % 1000 AS DOUBLE) AS predicted_clv,
   CAST(customer_id % 900 AS DOUBLE) AS predicted_clv_bgnbd, CAST(customer_id % 800 AS DOUBLE) AS predicted_clv_lgbm
 FROM rfm""", ["rfm"])


def stand_in(spark, sf):
    """Deterministic model outputs of all observed customers."""
    key = F.col("customer_id")
    return inputs.rfm(spark, sf).select(
        "customer_id", (key % 7).cast("double").alias("predicted_purchases"), ((key % 10).cast("double") / 10.0).alias("p_alive"),
        (key % 1000).cast("double").alias("predicted_clv"), (key % 900).cast("double").alias("predicted_clv_bgnbd"),
        (key % 800).cast("double").alias("predicted_clv_lgbm"))


INPUTS = ", ".join(f"f.{c}" for c in NUMERIC if c not in ("cohort_index", "total_revenue"))


@query("matrix_value", f"""
 SELECT f.customer_id, {INPUTS}, coalesce(s.predicted_purchases, 0) AS prob_predicted_purchases,
   coalesce(s.p_alive, 0) AS prob_p_alive, coalesce(s.predicted_clv, 0) AS prob_predicted_clv,
   coalesce(a.holdout_revenue, 0) AS target_revenue
 FROM features f LEFT JOIN stand_in s USING (customer_id) LEFT JOIN actuals a USING (customer_id)""",
       ["features", "stand_in", "actuals"])
def matrix_value(spark, sf):
    return features.value_matrix(inputs.customer_features(spark, sf), stand_in(spark, sf), inputs.actuals(spark, sf))


@query("matrix_numeric", f"""
 SELECT f.customer_id, {INPUTS}, f.cohort_index, f.total_revenue, s.predicted_purchases, s.p_alive, s.predicted_clv
 FROM features f JOIN stand_in s USING (customer_id)""", ["features", "stand_in"])
def matrix_numeric(spark, sf):
    return features.numeric_matrix(inputs.customer_features(spark, sf), stand_in(spark, sf))


@query("matrix_interval", f"""
 SELECT f.customer_id, {INPUTS}, f.total_revenue, coalesce(s.p_alive, 0) AS p_alive,
   coalesce(s.predicted_clv_bgnbd, 0) AS predicted_clv_bgnbd, coalesce(s.predicted_clv_lgbm, 0) AS predicted_clv_lgbm,
   a.holdout_revenue
 FROM features f LEFT JOIN stand_in s USING (customer_id) JOIN actuals a USING (customer_id)""",
       ["features", "stand_in", "actuals"])
def matrix_interval(spark, sf):
    return features.interval_matrix(
        inputs.customer_features(spark, sf), stand_in(spark, sf), inputs.actuals(spark, sf))


@query("explore_describe_rfm", """
 SELECT "column", count(value) AS n, round(avg(value), 2) AS mean, round(stddev_samp(value), 2) AS std,
   min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
   round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
 FROM (SELECT 'frequency' AS "column", frequency::DOUBLE AS value FROM rfm UNION ALL SELECT 'recency', recency FROM rfm
       UNION ALL SELECT 'T', T FROM rfm UNION ALL SELECT 'monetary_value', monetary_value FROM rfm) GROUP BY 1""", ["rfm"])
def explore_describe_rfm(spark, sf):
    table = explore.describe(inputs.rfm(spark, sf), ["frequency", "recency", "T", "monetary_value"])
    return table.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75")})


@query("explore_frequency_histogram", """
 WITH r AS (SELECT min(frequency)::DOUBLE AS lo, max(frequency)::DOUBLE AS hi FROM rfm)
 SELECT CAST(least(floor((frequency - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n FROM rfm, r GROUP BY 1""",
       ["rfm"])
def explore_frequency_histogram(spark, sf):
    return explore.histogram(inputs.rfm(spark, sf), "frequency", bins=30).select("bin", "n")


@query("explore_monetary_histogram", """
 WITH v AS (SELECT monetary_value AS x FROM rfm WHERE monetary_value > 0),
 c AS (SELECT quantile_cont(x, 0.99) AS hi, min(x) AS lo FROM v)
 SELECT CAST(least(floor((least(x, hi) - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n FROM v, c GROUP BY 1""",
       ["rfm"])
def explore_monetary_histogram(spark, sf):
    positive = inputs.rfm(spark, sf).where("monetary_value > 0")
    return explore.histogram(positive, "monetary_value", bins=30, upper_quantile=0.99, clip=True).select("bin", "n")


PAIRS = [(NUMERIC[i], NUMERIC[j]) for i in range(len(NUMERIC)) for j in range(i)]


@query("explore_correlations", "WITH m AS (SELECT " + ", ".join(
    f"round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS r{k}" for k, (a, b) in enumerate(PAIRS)) + " FROM features) "
    + " UNION ALL ".join(f"SELECT '{a}' AS row_feature, '{b}' AS col_feature, r{k} AS r FROM m"
                         for k, (a, b) in enumerate(PAIRS)), ["features"])
def explore_correlations(spark, sf):
    return explore.correlations(inputs.customer_features(spark, sf), NUMERIC, digits=6)
