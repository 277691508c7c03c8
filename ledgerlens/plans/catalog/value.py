"""Probabilistic value model: scoring with fixed parameters, validation, and the fits."""

from __future__ import annotations

import itertools
from dataclasses import asdict

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.operators import bgnbd, gamma_gamma, likelihood, metrics
from ledgerlens.operators.stability import spread
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import SETTINGS, fragment, query

BUY = bgnbd.PurchaseModel(r=0.6, alpha=60.0, a=1.5, b=2.5)
SPEND = gamma_gamma.SpendModel(p=6.0, q=4.0, v=15_000_000.0)
HOLDOUT_DAYS = (SETTINGS.holdout_end - SETTINGS.holdout_start).days + 1

ODDS = (f"(CASE WHEN frequency > 0 THEN {BUY.a} / ({BUY.b} + frequency - 1)"
        f" * pow(({BUY.alpha} + T) / ({BUY.alpha} + recency), {BUY.r} + frequency) ELSE 0.0 END)")
ALIVE = f"(1.0 / (1.0 + {ODDS}))"


def expectation_sql(days: int) -> str:
    """Series terms via log-gamma: a different evaluation from the Horner recurrence under test."""
    A, B = BUY.a + BUY.b - 1 - BUY.r, BUY.a - 1
    C = f"({BUY.a + BUY.b - 1}::DOUBLE + frequency)"
    z = f"({days}::DOUBLE / ({BUY.alpha + days}::DOUBLE + T))"
    series = (f"list_sum(list_transform(range(0, 160), lambda k: exp(lgamma({A}::DOUBLE + k) - lgamma({A}::DOUBLE)"
              f" + lgamma({B}::DOUBLE + k) - lgamma({B}::DOUBLE) - lgamma({C} + k) + lgamma({C}) - lgamma(1.0::DOUBLE + k)"
              f" + k * ln({z}))))")
    return f"({C} / {BUY.a - 1} * (1 - pow(1 - {z}, {BUY.a - 1}) * {series}) / (1 + {ODDS}))"


W = f"({SPEND.p} * frequency / ({SPEND.p} * frequency + {SPEND.q - 1}))"
MONEY = f"({W} * monetary_value + (1 - {W}) * {SPEND.p * SPEND.v / (SPEND.q - 1)}::DOUBLE)"

fragment("month_ends", "SELECT customer_id, frequency, monetary_value, " + ", ".join(
    f"{expectation_sql(30 * i)} AS e{i}" for i in range(1, 13)) + f", {ALIVE} AS p_alive FROM rfm", ["rfm"])
CLV = f"{SETTINGS.gross_margin} * {MONEY} * (" + " + ".join(
    f"(e{i} - {'e' + str(i - 1) if i > 1 else '0'}) / pow({1 + SETTINGS.monthly_discount}, {i})" for i in range(1, 13)) + ")"
fragment("predictions", f"""
 SELECT customer_id, frequency, e12 AS predicted_purchases, p_alive,
   CASE WHEN frequency > 0 THEN {CLV} ELSE 0.0 END AS predicted_clv FROM month_ends""", ["month_ends"])


def predictions(spark, sf):
    return gamma_gamma.predict_all(inputs.rfm(spark, sf), BUY, SPEND, SETTINGS)


@query("value_p_alive", f"SELECT customer_id, round({ALIVE}, 9) AS p_alive FROM rfm", ["rfm"])
def value_p_alive(spark, sf):
    return inputs.rfm(spark, sf).select("customer_id", F.round(bgnbd.p_alive(BUY), 9).alias("p_alive"))


@query("value_expected_purchases", f"SELECT customer_id, round({expectation_sql(365)}, 7) AS purchases FROM rfm", ["rfm"])
def value_expected_purchases(spark, sf):
    return spread(inputs.rfm(spark, sf)).select(
        "customer_id", F.round(bgnbd.expected_purchases(BUY, 365), 7).alias("purchases"))


# Where the argument of the hypergeometric function nears 1: young customers under a prior of very fast buyers.
EAGER = bgnbd.PurchaseModel(r=0.6, alpha=7.2e-7, a=1.5, b=2.5)
FAST_DAYS = 720
_X, _T = "(c_custkey % 13)", "(CASE c_custkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 0.001 WHEN 2 THEN 1.0 WHEN 3 THEN 60.0 ELSE 2000.0 END)"


def _series_sql(a: str, b: str, c: str, z: str, terms: int) -> str:
    """₂F₁ by its series, each term from the one before: Horner's rule over descending indices."""
    return (f"list_reduce(list_concat([1.0::DOUBLE], list_transform(range({terms}, 0, -1), lambda k: k::DOUBLE)), "
            f"lambda acc, k: 1.0 + acc * (({a}) + k - 1) * (({b}) + k - 1) / ((({c}) + k - 1) * k) * ({z}))")


_EAGER = f"""
 SELECT customer_id, x, {_series_sql('aa', 'bb', '1 - s', 'w', 80)} AS near, {_series_sql('c - aa', 'c - bb', '1 + s', 'w', 80)} AS rest,
   {_series_sql('aa', 'bb', 'c', '1 - w', 200)} AS far, c, s, w, aa, bb
 FROM (SELECT *, c - aa - bb AS s FROM (
  SELECT c_custkey AS customer_id, {_X}::DOUBLE AS x, {EAGER.a + EAGER.b - 1 - EAGER.r}::DOUBLE AS aa, {EAGER.a - 1}::DOUBLE AS bb,
   {EAGER.a + EAGER.b - 1}::DOUBLE + {_X} AS c, ({EAGER.alpha}::DOUBLE + {_T}) / ({EAGER.alpha}::DOUBLE + {FAST_DAYS} + {_T}) AS w FROM customer))"""


@query("value_fast_buyers", f"""
 SELECT customer_id, round(c / bb * (1 - CASE WHEN w > 0.5 THEN pow(w, bb) * far ELSE
   pow(w, bb) * gamma(c) * gamma(s) / (gamma(c - aa) * gamma(c - bb)) * near
   + pow(w, bb + s) * gamma(c) * gamma(-s) / (gamma(aa) * gamma(bb)) * rest END), 7) AS purchases FROM ({_EAGER})""")
def value_fast_buyers(spark, sf):
    """Purchases of active customers for arguments up to 1 − 10⁻⁹; the SQL joins two series in 1 − z, exact for half-integer gaps."""
    x = F.col("c_custkey") % 13
    kind = F.col("c_custkey") % 5
    age = F.when(kind == 0, 0.0).when(kind == 1, 0.001).when(kind == 2, 1.0).when(kind == 3, 60.0).otherwise(2000.0)
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("customer_id"), x.alias("frequency"), age.alias("T"))
    active = bgnbd.active_purchases(EAGER, [[(float(FAST_DAYS), 1.0)]])["p0"]
    return spread(rows).select("customer_id", F.round(active, 7).alias("purchases"))


@query("value_expected_spend", f"SELECT customer_id, round({MONEY}, 3) AS spend FROM rfm", ["rfm"])
def value_expected_spend(spark, sf):
    return inputs.rfm(spark, sf).select("customer_id", F.round(gamma_gamma.expected_spend(SPEND), 3).alias("spend"))


@query("value_predict_all", """
 SELECT customer_id, round(predicted_purchases, 7) AS predicted_purchases, round(p_alive, 9) AS p_alive,
   round(predicted_clv, 0) AS predicted_clv, round(predicted_clv, 0) AS clv_inr FROM predictions""", ["predictions"])
def value_predict_all(spark, sf):
    table = predictions(spark, sf)
    return table.select("customer_id", F.round("predicted_purchases", 7).alias("predicted_purchases"),
                        F.round("p_alive", 9).alias("p_alive"), F.round("predicted_clv", 0).alias("predicted_clv"),
                        F.round("clv_inr", 0).alias("clv_inr"))


@query("value_frequency_recency", f"""
 SELECT frequency, CAST(floor(recency / 30.0) AS INTEGER) AS recency_bucket, count(*) AS n_customers,
   round(avg({expectation_sql(365)}), 7) AS expected_purchases, round(avg({ALIVE}), 9) AS p_alive FROM rfm GROUP BY 1, 2""", ["rfm"])
def value_frequency_recency(spark, sf):
    table = gamma_gamma.frequency_recency_table(inputs.rfm(spark, sf), BUY, 365)
    return table.withColumns({"expected_purchases": F.round("expected_purchases", 7), "p_alive": F.round("p_alive", 9)})


@query("value_calibration", f"""
 WITH h AS (SELECT CustomerID AS customer_id, count(DISTINCT CAST(InvoiceDate AS DATE)) AS n FROM hold GROUP BY 1)
 SELECT frequency, count(*) AS n_customers, round(avg(coalesce(n, 0)), 9) AS actual,
   round(avg({expectation_sql(HOLDOUT_DAYS)}), 7) AS expected
 FROM rfm LEFT JOIN h USING (customer_id) GROUP BY 1""", ["rfm", "hold"])
def value_calibration(spark, sf):
    inputs.land_lines(spark, sf)
    held = inputs.held_out(spark, sf).groupBy(F.col("CustomerID").alias("customer_id")).agg(
        F.count_distinct(F.to_date("InvoiceDate")).alias("n_purchases"))
    table = gamma_gamma.calibration(inputs.rfm(spark, sf), held, BUY, HOLDOUT_DAYS)
    return table.withColumns({"actual": F.round("actual", 9), "expected": F.round("expected", 7)})


@query("value_holdout_validation", """
 SELECT count(*) AS n, round(avg(abs(y - p)), 0) AS mae, round(sqrt(avg((y - p) * (y - p))), 0) AS rmse,
   round(avg(abs((y - p) / y)) FILTER (y <> 0) * 100, 6) AS mape, round(corr(y, p), 7) AS pearson_r
 FROM (SELECT a.holdout_revenue AS y, x.predicted_clv AS p FROM predictions x JOIN actuals a USING (customer_id))""",
       ["predictions", "actuals"])
def value_holdout_validation(spark, sf):
    inputs.land_lines(spark, sf)
    joined = predictions(spark, sf).join(inputs.actuals(spark, sf), "customer_id")
    table = metrics.regression_report(joined, "holdout_revenue", "predicted_clv")
    return table.withColumns({"mae": F.round("mae", 0), "rmse": F.round("rmse", 0), "mape": F.round("mape", 6),
                              "pearson_r": F.round("pearson_r", 7)})


@query("value_top_customers", """
 SELECT customer_id, round(predicted_purchases, 7) AS predicted_purchases, round(p_alive, 9) AS p_alive
 FROM predictions ORDER BY round(predicted_clv, 0) DESC, customer_id LIMIT 20""", ["predictions"])
def value_top_customers(spark, sf):
    table = predictions(spark, sf).orderBy(F.desc(F.round("predicted_clv", 0)), "customer_id").limit(20)
    return table.select("customer_id", F.round("predicted_purchases", 7).alias("predicted_purchases"),
                        F.round("p_alive", 9).alias("p_alive"))


def _as_row(spark, model):
    return spark.createDataFrame([tuple(asdict(model).values())], list(asdict(model)))


@query("value_fit_purchases")
def value_fit_purchases(spark, sf):
    return _as_row(spark, bgnbd.fit(inputs.rfm(spark, sf), SETTINGS.penalizer))


@query("value_fit_spend")
def value_fit_spend(spark, sf):
    """Amounts of the test tables are in the ten-millions, hence the unit of the penalty."""
    return _as_row(spark, gamma_gamma.fit(inputs.rfm(spark, sf), SETTINGS.penalizer, unit=10_000_000.0))


# --- likelihoods at a fixed point: the sums that the fits run on ---------------------------------

STEP = 1e-3  # of the logarithms, for the differences in SQL


def _difference_points(theta):
    """(what, weight, parameters): points whose weighted sum is the value, a slope or a curvature by the logarithms."""
    k = len(theta)
    at = lambda *moves: [v * float(np.exp(STEP * sum(m for j, m in moves if j == i))) for i, v in enumerate(theta)]
    yield from [("value", 1.0, at())]
    for i in range(k):
        yield from ((f"slope{i}", s / (2 * STEP), at((i, s))) for s in (1, -1))
        yield from ((f"bend{i}{i}", w / STEP ** 2, at((i, s))) for s, w in ((1, 1), (0, -2), (-1, 1)))
    for i, j in itertools.combinations(range(k), 2):
        yield from ((f"bend{i}{j}", s * u / (4 * STEP ** 2), at((i, s), (j, u))) for s in (1, -1) for u in (1, -1))


def _likelihood_sql(label, names, theta, ll, source):
    points = ", ".join(f"('{what}', {weight!r}::DOUBLE, {', '.join(f'{v!r}::DOUBLE' for v in at)})" for what, weight, at in _difference_points(theta))
    return (f"SELECT '{label}' AS model, what, round(sum(weight * m), 4) AS amount FROM (SELECT what, weight, {', '.join(names)}, avg({ll}) AS m "
            f"FROM (VALUES {points}) AS p(what, weight, {', '.join(names)}), ({source}) GROUP BY ALL) GROUP BY 1, 2")


_BUY_LL = """lgamma(r + x) - lgamma(r) + r * ln(al) + lgamma(a + b) - lgamma(a + b + x) + lgamma(b + x) - lgamma(b) - (r + x) * ln(al + t)
 + CASE WHEN x > 0 THEN ln(1 + exp(ln(a) - ln(b + x - 1) + (r + x) * (ln(al + t) - ln(al + tx)))) ELSE 0 END"""
_SPEND_LL = """lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * ln(v) + (p * x - 1) * ln(m) + p * x * ln(x) - (p * x + q) * ln(x * m + v)"""


@query("value_likelihood_derivatives",
       _likelihood_sql("purchases", ("r", "al", "a", "b"), (BUY.r, BUY.alpha, BUY.a, BUY.b), _BUY_LL,
                       "SELECT frequency::DOUBLE AS x, recency::DOUBLE AS tx, T::DOUBLE AS t FROM rfm")
       + " UNION ALL " + _likelihood_sql("spend", ("p", "q", "v"), (SPEND.p, SPEND.q, 1.5), _SPEND_LL,
                                         "SELECT frequency::DOUBLE AS x, monetary_value / 1e7::DOUBLE AS m FROM rfm WHERE frequency > 0 AND monetary_value > 0"),
       ["rfm"])
def value_likelihood_derivatives(spark, sf):
    """Mean log-likelihood, slopes and curvatures of both models at fixed parameters; the SQL takes differences."""
    rfm = inputs.rfm(spark, sf)
    double = lambda name, unit=1.0: (F.col(name).cast("double") / unit)
    bought = rfm.select(double("frequency").alias("x"), double("recency").alias("tx"), double("T").alias("t"), F.lit(1.0).alias("weight"))
    spent = rfm.where("frequency > 0 and monetary_value > 0").select(
        double("frequency").alias("x"), double("monetary_value", 1e7).alias("m"), F.lit(1.0).alias("weight"))
    out = []
    for label, rows, model, theta in (("purchases", bought, bgnbd.row_model, (BUY.r, BUY.alpha, BUY.a, BUY.b)),
                                      ("spend", spent, gamma_gamma.row_model, (SPEND.p, SPEND.q, 1.5))):
        value, slopes, bends = likelihood.by_logarithms(np.log(theta), likelihood.evaluate(rows, model, [theta])[0])
        out.append((label, "value", float(value)))
        out += [(label, f"slope{i}", float(v)) for i, v in enumerate(slopes)]
        out += [(label, f"bend{i}{j}", float(bends[i, j])) for i in range(len(theta)) for j in range(i, len(theta))]
    return spark.createDataFrame(out, "model string, what string, amount double").withColumn("amount", F.round("amount", 4))
