"""Shared inputs of the catalog queries, as DataFrames and as SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, features
from ledgerlens.operators.stability import landed
from ledgerlens.plans.catalog.registry import SETTINGS, fragment, once, replace_input
from ledgerlens.sources.retail import retail_lines

OBS = (f"InvoiceDate >= DATE '{SETTINGS.observation_start}' AND "
       f"InvoiceDate < DATE '{SETTINGS.observation_end}' + INTERVAL 1 DAY")
HOLD = (f"InvoiceDate >= DATE '{SETTINGS.holdout_start}' AND "
        f"InvoiceDate < DATE '{SETTINGS.holdout_end}' + INTERVAL 1 DAY")
END = f"DATE '{SETTINGS.observation_end}'"
CODES = ", ".join(f"'{c}'" for c in SETTINGS.non_product_codes)


@once
def raw(spark: SparkSession, sf: str) -> DataFrame:
    return retail_lines(spark, sf)


def land_lines(spark: SparkSession, sf: str) -> None:
    """For queries with more than two passes: the fact join runs once, every pass reads its columns of the result.

    One or two passes (caps and cleaned lines) cost less without the write.
    """
    replace_input("raw", sf, lambda: landed(raw(spark, sf)))


@once
def tx(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean(raw(spark, sf), SETTINGS)


def observed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.temporal_split(tx(spark, sf), SETTINGS)[0]


def held_out(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.temporal_split(tx(spark, sf), SETTINGS)[1]


@once
def rfm(spark: SparkSession, sf: str) -> DataFrame:
    return features.rfm_summary(observed(spark, sf), SETTINGS.observation_end)


@once
def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    land_lines(spark, sf)
    raw_observed = cleaning.temporal_split(raw(spark, sf), SETTINGS)[0]
    return features.customer_features(observed(spark, sf), raw_observed, SETTINGS.observation_end)


def actuals(spark: SparkSession, sf: str) -> DataFrame:
    return features.holdout_actuals(held_out(spark, sf))


fragment("raw", """
 SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || o_orderkey AS InvoiceNo,
        CASE WHEN l_partkey % 50 = 0 THEN 'POST' ELSE 'P' || l_partkey END AS StockCode,
        CASE WHEN l_partkey % 97 <> 0 THEN 'Item ' || l_partkey END AS Description,
        CAST(l_quantity AS BIGINT) * CASE WHEN o_orderkey % 41 = 0 THEN -1 ELSE 1 END AS Quantity,
        o_orderdate AS InvoiceDate,
        (CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))
          // CAST(l_quantity AS BIGINT) AS UnitPrice,
        CASE WHEN o_orderkey % 37 <> 0 THEN o_custkey END AS CustomerID,
        n_name AS Country
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
fragment("valid", f"""
 SELECT * FROM raw
 WHERE CustomerID IS NOT NULL AND NOT starts_with(InvoiceNo, 'C') AND StockCode NOT IN ({CODES})
   AND Quantity > 0 AND UnitPrice > 0""", ["raw"])
fragment("caps", f"""
 SELECT CAST(round(quantile_cont(Quantity, {SETTINGS.outlier_percentile / 100})) AS BIGINT) AS cap_quantity,
        CAST(round(quantile_cont(UnitPrice, {SETTINGS.outlier_percentile / 100})) AS BIGINT) AS cap_price
 FROM valid""", ["valid"])
fragment("tx", f"""
 SELECT InvoiceNo, StockCode, Description, q AS Quantity, InvoiceDate, p AS UnitPrice, CustomerID, Country,
        q * p AS TotalPrice, strftime(InvoiceDate, '%Y-%m') AS year_month
 FROM (SELECT InvoiceNo, StockCode, Description, InvoiceDate, CustomerID, Country,
              least(Quantity, (SELECT cap_quantity FROM caps)) AS q,
              least(UnitPrice, (SELECT cap_price FROM caps)) * {SETTINGS.inr_rate} AS p
       FROM valid)""", ["valid", "caps"])
fragment("obs", f"SELECT * FROM tx WHERE {OBS}", ["tx"])
fragment("hold", f"SELECT * FROM tx WHERE {HOLD}", ["tx"])
fragment("days", """
 SELECT CustomerID AS customer_id, CAST(InvoiceDate AS DATE) AS day,
        CAST(sum(TotalPrice) AS BIGINT) AS revenue, count(*) AS n_lines
 FROM obs GROUP BY 1, 2""", ["obs"])
fragment("rfm", f"""
 SELECT customer_id, count(*) - 1 AS frequency,
        CAST(date_diff('day', min(day), max(day)) AS INTEGER) AS recency,
        CAST(date_diff('day', min(day), {END}) AS INTEGER) AS T,
        CASE WHEN count(*) > 1
             THEN CAST(CAST(sum(revenue) - arg_min(revenue, day) AS BIGINT) AS DOUBLE) / (count(*) - 1) / 10000.0
             ELSE 0.0 END AS monetary_value
 FROM days GROUP BY customer_id""", ["days"])
fragment("actuals", """
 SELECT CustomerID AS customer_id, CAST(CAST(sum(TotalPrice) AS BIGINT) AS DOUBLE) / 10000.0 AS holdout_revenue
 FROM hold GROUP BY 1""", ["hold"])
fragment("order_days", """
 SELECT CustomerID AS customer_id, InvoiceNo, CAST(InvoiceDate AS DATE) AS day,
        CAST(sum(TotalPrice) AS BIGINT) AS revenue, CAST(sum(Quantity) AS BIGINT) AS items
 FROM obs GROUP BY 1, 2, 3""", ["obs"])
fragment("gap_rows", """
 SELECT customer_id, day, date_diff('day', lag(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS gap
 FROM days""", ["days"])
fragment("gaps", """
 SELECT customer_id, CASE WHEN count(gap) > 1 THEN
   sqrt(CAST(count(gap) * sum(gap * gap) - sum(gap) * sum(gap) AS DOUBLE)
        / CAST(count(gap) * (count(gap) - 1) AS DOUBLE)) ELSE 0.0 END AS std_interpurchase_days
 FROM gap_rows GROUP BY 1""", ["gap_rows"])
fragment("behaviour", """
 SELECT customer_id, count(DISTINCT strftime(day, '%Y-%m')) AS active_months, count(*) AS n_orders,
        CAST(sum(items) AS BIGINT) AS n_items,
        CAST(CAST(sum(revenue) AS BIGINT) AS DOUBLE) / count(*) / 10000.0 AS avg_order_value,
        CAST(max(revenue) AS DOUBLE) / 10000.0 AS max_order_value,
        strftime(min(day), '%Y-%m') AS cohort_month,
        CAST(CAST(sum(revenue) AS BIGINT) AS DOUBLE) / 10000.0 AS total_revenue
 FROM order_days GROUP BY 1""", ["order_days"])
fragment("products", """
 SELECT CustomerID AS customer_id, count(DISTINCT StockCode) AS n_products FROM obs GROUP BY 1""", ["obs"])
fragment("return_rates", f"""
 SELECT CustomerID AS customer_id,
        CAST(count(*) FILTER (starts_with(InvoiceNo, 'C')) AS DOUBLE) / count(*) AS return_rate
 FROM raw WHERE CustomerID IS NOT NULL AND {OBS} GROUP BY 1""", ["raw"])
fragment("features", """
 SELECT r.customer_id, r.frequency, r.recency, r.T, r.monetary_value, r.T AS tenure_days,
        b.active_months, b.n_orders, b.n_items, p.n_products, b.avg_order_value, b.max_order_value,
        g.std_interpurchase_days, coalesce(x.return_rate, 0.0) AS return_rate, b.cohort_month,
        CAST(dense_rank() OVER (ORDER BY b.cohort_month) AS INTEGER) AS cohort_index, b.total_revenue
 FROM rfm r JOIN behaviour b USING (customer_id) JOIN products p USING (customer_id)
 JOIN gaps g USING (customer_id) LEFT JOIN return_rates x USING (customer_id)""",
         ["rfm", "behaviour", "products", "gaps", "return_rates"])


def score_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in model outputs per customer, integers of the key, so results do not hang on a fit.

    ``score`` takes 41 values over all customers, so ties are common and the tie-break matters.
    """
    key = F.col("c_custkey")
    return spark.read.parquet(f"{sf}/customer.parquet").select(
        key.alias("customer_id"),
        (key * 7919 % 2001 - 1000).alias("uplift_score"),
        (key * 31 % 41 - 20).alias("tied_score"),
        (key * 104729 % 50000).alias("predicted_clv"),
        ((key * 13 % 100) / 100.0).alias("p_alive"),
        (key * 37 % 400).alias("recency_days"),
        F.element_at(F.array(*[F.lit(n) for n in ("Champions", "At-Risk High-Value", "Promising", "Hibernating", "Lost")]),
                     (key % 5 + 1).cast("int")).alias("segment_name"),
        (key * 17 % 3000).alias("actual"),
    )


fragment("scores", """
 SELECT c_custkey AS customer_id, c_custkey * 7919 % 2001 - 1000 AS uplift_score,
        c_custkey * 31 % 41 - 20 AS tied_score, c_custkey * 104729 % 50000 AS predicted_clv,
        CAST(c_custkey * 13 % 100 AS DOUBLE) / 100.0 AS p_alive, c_custkey * 37 % 400 AS recency_days,
        (['Champions', 'At-Risk High-Value', 'Promising', 'Hibernating', 'Lost'])[c_custkey % 5 + 1] AS segment_name,
        c_custkey * 17 % 3000 AS actual
 FROM customer""")
