"""Metrics, lift, coverage and rank-based report slices on deterministic scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.splits import treatment_flag
from ledgerlens.operators import explore, metrics
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import fragment, query

HASH = "CAST('0x' || substr(md5('{salt}:' || {key}), 1, 8) AS BIGINT) % 1000"
TREATED = f"CAST({HASH.format(salt='treatment', key='customer_id')} < 300 AS INTEGER)"

fragment("pairs", """
 SELECT customer_id, holdout_revenue AS y, holdout_revenue * (0.7 + (customer_id * 37 % 61) / 100.0::DOUBLE) AS p,
   holdout_revenue * 0.5::DOUBLE + 1000.0 AS p2 FROM actuals""", ["actuals"])


def pairs(spark, sf):
    key, y = F.col("customer_id"), F.col("holdout_revenue")
    return inputs.actuals(spark, sf).select(
        "customer_id", y.alias("y"), (y * (F.lit(0.7) + (key * 37 % 61) / F.lit(100.0))).alias("p"),
        (y * F.lit(0.5) + F.lit(1000.0)).alias("p2"))


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


MEASURES = """round(avg(abs(y - {p})), 2) AS {mae}, round(sqrt(avg((y - {p}) * (y - {p}))), 2) AS {rmse},
   round(avg(abs((y - {p}) / y)) FILTER (y <> 0) * 100, 6) AS {mape}, round(corr(y, {p}), 6) AS {r}"""


@query("metrics_regression", "SELECT count(*) AS n, " + MEASURES.format(
    p="p", mae="mae", rmse="rmse", mape="mape", r="pearson_r") + " FROM pairs", ["pairs"])
def metrics_regression(spark, sf):
    report = metrics.regression_report(pairs(spark, sf), "y", "p")
    return rounded(rounded(report, 2, "mae", "rmse"), 6, "mape", "pearson_r")


@query("metrics_mape_all_zero", "SELECT 0.0::DOUBLE AS mape, avg(abs(uplift_score))::DOUBLE AS mae FROM scores", ["scores"])
def metrics_mape_all_zero(spark, sf):
    zero, p = F.lit(0.0), F.col("uplift_score").cast("double")
    return inputs.score_frame(spark, sf).agg(metrics.mape(zero, p).alias("mape"), metrics.mae(zero, p).alias("mae"))


@query("metrics_model_comparison", " UNION ALL ".join(
    f"SELECT '{label}' AS model, " + MEASURES.format(p=p, mae='"MAE"', rmse='"RMSE"', mape='"MAPE"', r='"Pearson_r"')
    + " FROM pairs" for label, p in (("BG/NBD", "p2"), ("LightGBM", "p"))), ["pairs"])
def metrics_model_comparison(spark, sf):
    table = metrics.model_scores(pairs(spark, sf), "y", {"BG/NBD": "p2", "LightGBM": "p"})
    return rounded(rounded(table, 2, "MAE", "RMSE"), 6, "MAPE", "Pearson_r")


@query("metrics_comparison_table", """
 SELECT segment_name AS model, round(avg(predicted_clv), 4) AS avg_clv, round(avg(uplift_score), 4) AS avg_uplift
 FROM scores GROUP BY 1""", ["scores"])
def metrics_comparison_table(spark, sf):
    means = inputs.score_frame(spark, sf).groupBy(F.col("segment_name").alias("model")).agg(
        F.avg("predicted_clv").alias("a"), F.avg("uplift_score").alias("b"))
    long = means.select("model", F.expr("stack(2, 'avg_clv', a, 'avg_uplift', b) as (metric, value)"))
    return metrics.comparison_table(long)


def lift_sql(p: str) -> str:
    # A right-closed bin number is the count of inner edges below the value.
    return f"""
 WITH e AS (SELECT list_sort(list_distinct(quantile_cont({p}::DOUBLE, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e
            FROM scores),
 b AS (SELECT actual, {p} AS p, len(list_filter(e[2:-2], lambda x: x < {p})) AS code FROM scores, e),
 g AS (SELECT code, count(*) AS n_customers, avg(actual) AS ma, avg(p) AS mp FROM b GROUP BY code)
 SELECT CAST((SELECT max(code) FROM g) - code + 1 AS INTEGER) AS decile, n_customers, round(ma, 6) AS mean_actual_clv,
   round(mp, 6) AS mean_predicted_clv, round(ma / (SELECT avg(actual) FROM scores), 6) AS lift FROM g"""


@query("metrics_decile_lift", lift_sql("predicted_clv"), ["scores"])
def metrics_decile_lift(spark, sf):
    table = metrics.decile_lift(inputs.score_frame(spark, sf), "actual", "predicted_clv")
    return rounded(table, 6, "mean_actual_clv", "mean_predicted_clv", "lift")


@query("metrics_decile_lift_tied", lift_sql("(customer_id % 4)"), ["scores"])
def metrics_decile_lift_tied(spark, sf):
    """Four distinct predictions: duplicate edges collapse and ties stay together."""
    tied = inputs.score_frame(spark, sf).withColumn("four", F.col("customer_id") % 4)
    return rounded(metrics.decile_lift(tied, "actual", "four"), 6, "mean_actual_clv", "mean_predicted_clv", "lift")


@query("metrics_qini_coefficient", f"""
 WITH s AS (SELECT customer_id, CAST(actual > 1500 AS BIGINT) AS y, tied_score, {TREATED} AS t FROM scores),
 w AS (SELECT *, row_number() OVER o AS rank, sum(y * t) OVER o AS ct, sum(y * (1 - t)) OVER o AS cc
       FROM s WINDOW o AS (ORDER BY tied_score DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 k AS (SELECT count(*) AS n, sum(t) AS nt FROM s),
 h AS (SELECT rank, n, ct / nt::DOUBLE - cc / (n - nt)::DOUBLE AS h FROM w, k),
 a AS (SELECT (sum(h) - sum(h) FILTER (rank IN (1, n)) / 2) / max(n) AS area, max(h) FILTER (rank = n) / 2 AS random FROM h)
 SELECT round((area - random) / abs(random), 6) AS qini FROM a""", ["scores"])
def metrics_qini_coefficient(spark, sf):
    rows = inputs.score_frame(spark, sf).select(
        "customer_id", "tied_score", (F.col("actual") > 1500).cast("bigint").alias("y"),
        treatment_flag("customer_id", 0.3).alias("t"))
    return rounded(metrics.qini_coefficient(rows, "y", "tied_score", "t"), 6, "qini")


@query("metrics_coverage", """
 SELECT round(avg(CAST(y BETWEEN p * 0.8::DOUBLE AND p * 1.2::DOUBLE AS INTEGER)), 9) AS coverage FROM pairs""", ["pairs"])
def metrics_coverage(spark, sf):
    p = F.col("p")
    return pairs(spark, sf).agg(
        F.round(metrics.coverage(F.col("y"), p * F.lit(0.8), p * F.lit(1.2)), 9).alias("coverage"))


@query("report_residuals", """
 WITH r AS (SELECT customer_id, p AS predicted, y AS actual, y - p AS residual FROM pairs),
 q AS (SELECT quantile_cont(residual, 0.01) AS lo, quantile_cont(residual, 0.99) AS hi FROM r)
 SELECT customer_id, round(predicted, 3) AS predicted, actual, round(residual, 3) AS residual,
   round(least(greatest(residual, lo), hi), 3) AS clipped FROM r, q""", ["pairs"])
def report_residuals(spark, sf):
    inputs.land_lines(spark, sf)
    frame = pairs(spark, sf)
    table = metrics.residuals(frame.select("customer_id", F.col("p").alias("predicted_clv")),
                              frame.select("customer_id", F.col("y").alias("holdout_revenue")))
    return rounded(table, 3, "predicted", "residual", "clipped")


def slice_sql(start: int, stop: int) -> str:
    return f"""SELECT customer_id, predicted_clv, rank FROM (
 SELECT customer_id, predicted_clv, row_number() OVER (ORDER BY predicted_clv DESC, customer_id) AS rank FROM scores)
 WHERE rank > {start} AND rank <= {stop}"""


@query("report_rank_slice_5_25", slice_sql(5, 25), ["scores"])
def report_rank_slice_5_25(spark, sf):
    return explore.rank_slice(inputs.score_frame(spark, sf).select("customer_id", "predicted_clv"), "predicted_clv", 5, 25)


@query("report_rank_slice_10_30", slice_sql(10, 30), ["scores"])
def report_rank_slice_10_30(spark, sf):
    return explore.rank_slice(inputs.score_frame(spark, sf).select("customer_id", "predicted_clv"), "predicted_clv", 10, 30)


def below_sql(q: float) -> str:
    return f"""SELECT customer_id, p_alive, predicted_clv, segment_name FROM scores
 WHERE predicted_clv < (SELECT quantile_cont(predicted_clv, {q}) FROM scores)"""


@query("report_scatter_below_p95", below_sql(0.95), ["scores"])
def report_scatter_below_p95(spark, sf):
    frame = inputs.score_frame(spark, sf).select("customer_id", "p_alive", "predicted_clv", "segment_name")
    return explore.quantile_below(frame, "predicted_clv", 0.95)


@query("report_scatter_below_p98", below_sql(0.98), ["scores"])
def report_scatter_below_p98(spark, sf):
    frame = inputs.score_frame(spark, sf).select("customer_id", "p_alive", "predicted_clv", "segment_name")
    return explore.quantile_below(frame, "predicted_clv", 0.98)
