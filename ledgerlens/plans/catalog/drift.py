"""Drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import drift
from ledgerlens.plans.catalog import customers, inputs  # noqa: F401  (customers registers the q_rfm fragment)
from ledgerlens.plans.catalog.registry import SETTINGS, fragment, query

FEATURES = drift.DRIFT_FEATURES


def psi_sql(long: str, pairs: str) -> str:
    """Index per (period, feature) from long rows and period pairs, both given as sub-selects."""
    return f"""
 SELECT s.period, s.baseline, s.feature,
   CASE WHEN s.e IS NULL OR coalesce(t.na, 0) = 0 THEN 'NaN'::DOUBLE WHEN len(s.e) < 2 THEN 0.0 ELSE
    list_sum(list_transform(range(0, len(s.e) - 1), lambda i:
      (((coalesce(t.a[i], 0) + 1e-8) / (t.na + 1e-8 * (len(s.e) - 1))) - ((coalesce(t.x[i], 0) + 1e-8) / (t.nx + 1e-8 * (len(s.e) - 1))))
      * ln(((coalesce(t.a[i], 0) + 1e-8) / (t.na + 1e-8 * (len(s.e) - 1))) / ((coalesce(t.x[i], 0) + 1e-8) / (t.nx + 1e-8 * (len(s.e) - 1)))))) END AS psi
 FROM (SELECT p.period, p.baseline, f.feature, e.e FROM ({pairs}) p CROSS JOIN (SELECT DISTINCT feature FROM ({long})) f
       LEFT JOIN (SELECT period, feature, list_sort(list_distinct(
            quantile_cont(value, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e
            FROM ({long}) GROUP BY ALL) e ON e.period = p.baseline AND e.feature = f.feature) s
 LEFT JOIN (SELECT period, feature, map(list(bin), list(x)) AS x, map(list(bin), list(a)) AS a,
              sum(x) AS nx, sum(a) AS na FROM (
     SELECT p.period, l.feature, len(list_filter(e.e[2:-2], lambda c: c <= l.value)) AS bin,
       count(*) FILTER (l.period = p.baseline) AS x, count(*) FILTER (l.period = p.period) AS a
     FROM ({long}) l JOIN ({pairs}) p ON l.period = p.baseline OR l.period = p.period
     JOIN (SELECT period, feature, list_sort(list_distinct(
            quantile_cont(value, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e
            FROM ({long}) GROUP BY ALL) e ON e.period = p.baseline AND e.feature = l.feature
     GROUP BY ALL) GROUP BY ALL) t ON t.period = s.period AND t.feature = s.feature"""


LONG_RFM = " UNION ALL ".join(
    f"SELECT quarter AS period, '{f}' AS feature, {f}::DOUBLE AS value FROM q_rfm" for f in FEATURES)
PAIRS_RFM = """SELECT * FROM (SELECT period, lag(period) OVER (ORDER BY period) AS baseline
 FROM (SELECT DISTINCT quarter AS period FROM q_rfm)) WHERE baseline IS NOT NULL"""
fragment("q_psi", f"""SELECT period AS quarter, baseline AS baseline_quarter, feature, psi
 FROM ({psi_sql(LONG_RFM, PAIRS_RFM)})""", ["q_rfm"])


def q_psi(spark, sf):
    return drift.quarterly_rfm_psi(inputs.tx(spark, sf), SETTINGS.min_quarter_rows)


@query("drift_quarterly_rfm", "SELECT quarter, baseline_quarter, feature, round(psi, 7) AS psi FROM q_psi", ["q_psi"])
def drift_quarterly_rfm(spark, sf):
    return q_psi(spark, sf).withColumn("psi", F.round("psi", 7))


LONG_LINES = " UNION ALL ".join(
    f"SELECT year(InvoiceDate) || 'Q' || quarter(InvoiceDate) AS period, '{f}' AS feature, {f}::DOUBLE AS value FROM raw"
    for f in ("Quantity", "UnitPrice"))
PAIRS_LINES = """SELECT * FROM (SELECT period, lag(period) OVER (ORDER BY period) AS baseline
 FROM (SELECT DISTINCT year(InvoiceDate) || 'Q' || quarter(InvoiceDate) AS period FROM raw)) WHERE baseline IS NOT NULL"""


@query("drift_quarterly_lines", f"""SELECT period AS quarter, baseline AS baseline_quarter, feature, round(psi, 7) AS psi
 FROM ({psi_sql(LONG_LINES, PAIRS_LINES)})""", ["raw"])
def drift_quarterly_lines(spark, sf):
    table = drift.quarterly_psi(inputs.raw(spark, sf), "InvoiceDate", ["Quantity", "UnitPrice", "absent_column"])
    return table.withColumn("psi", F.round("psi", 7))


LONG_HALVES = " UNION ALL ".join(
    f"SELECT CASE WHEN event_id % 3 = 0 THEN 'baseline' ELSE 'current' END AS period, '{f}' AS feature, {x} AS value FROM events"
    for f, x in (("value", "value"), ("constant", "1.0::DOUBLE"), ("weekday", "(event_id % 7)::DOUBLE"),
                 ("one_sided", "CASE WHEN event_id % 3 = 0 THEN value END")))


@query("drift_feature_psi", f"""SELECT feature, round(psi, 7) AS psi FROM (
 {psi_sql("SELECT * FROM (" + LONG_HALVES + ") WHERE value IS NOT NULL", "SELECT 'current' AS period, 'baseline' AS baseline")})""")
def drift_feature_psi(spark, sf):
    """Two frames, with a constant feature (0) and one that is empty on one side (NaN)."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    first = F.col("event_id") % 3 == 0
    frame = events.select(
        first.alias("is_first"), "value", F.lit(1.0).alias("constant"), (F.col("event_id") % 7).alias("weekday"),
        F.when(first, F.col("value")).alias("one_sided"))
    features = ["value", "constant", "weekday", "one_sided", "absent_column"]
    return drift.feature_psi(frame.where("is_first"), frame.where("not is_first"), features).withColumn(
        "psi", F.round("psi", 7))


@query("drift_detect", """
 SELECT quarter, feature, round(psi, 4) AS psi,
   CASE WHEN isnan(psi) THEN 'unknown' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS status,
   NOT isnan(psi) AND psi >= 0.1 AS alert FROM q_psi""", ["q_psi"])
def drift_detect(spark, sf):
    return drift.detect_drift(q_psi(spark, sf).select("quarter", "feature", "psi"))


@query("drift_alerts_latest", """
 SELECT feature, CASE WHEN psi >= 0.2
   THEN printf('🔴 SIGNIFICANT DRIFT on ''%s'': PSI = %.4f (threshold 0.2). Retraining recommended.', feature, psi)
   ELSE printf('🟡 MODERATE DRIFT on ''%s'': PSI = %.4f (threshold 0.1). Investigate.', feature, psi) END AS message
 FROM q_psi WHERE quarter = (SELECT max(quarter) FROM q_psi) AND psi >= 0.1 AND NOT isnan(psi)""", ["q_psi"])
def drift_alerts_latest(spark, sf):
    return drift.alerts(drift.latest_quarter(q_psi(spark, sf)))


@query("drift_heatmap", "SELECT feature, quarter, round(avg(psi), 7) AS psi FROM q_psi GROUP BY ALL", ["q_psi"])
def drift_heatmap(spark, sf):
    """The heat map's cells as rows, for whatever quarters the data hold."""
    table = drift.heatmap(q_psi(spark, sf))
    cells = table.unpivot("feature", [c for c in table.columns if c != "feature"], "quarter", "psi")
    return cells.where("psi is not null").withColumn("psi", F.round("psi", 7))


@query("drift_report_classes", """
 SELECT quarter, feature,
   CASE WHEN psi > 0.2 THEN 'Drift' WHEN psi > 0.1 THEN 'Watch' ELSE 'Stable' END AS report_status,
   CASE WHEN psi < 0.1 THEN 'Stable' WHEN psi < 0.25 THEN 'Moderate' ELSE 'SIGNIFICANT' END AS study_status FROM q_psi""",
       ["q_psi"])
def drift_report_classes(spark, sf):
    psi = F.col("psi")
    return q_psi(spark, sf).select(
        "quarter", "feature",
        drift.status(psi, 0.10, 0.20, strict=True, labels=("Stable", "Watch", "Drift")).alias("report_status"),
        drift.status(psi, 0.10, 0.25, labels=("Stable", "Moderate", "SIGNIFICANT")).alias("study_status"))


@query("drift_density_histograms", """
 WITH b AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'baseline' ELSE 'current' END AS side, value AS x FROM events),
 r AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50 AS w FROM b),
 c AS (SELECT side, CAST(least(floor((x - lo) / w), 49) AS INTEGER) AS bin, any_value(w) AS w, count(*) AS n FROM b, r GROUP BY 1, 2)
 SELECT side, bin, n, round(n / (sum(n) OVER (PARTITION BY side) * w), 9) AS density FROM c""")
def drift_density_histograms(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "value")
    first = F.col("event_id") % 3 == 0
    table = drift.density_histograms(events.where(first), events.where(~first), "value", 50)
    return table.withColumn("density", F.round("density", 9))


@query("drift_retraining_due", """
 SELECT feature, quarter, round(psi, 7) AS psi FROM (
  SELECT *, lag(psi) OVER (PARTITION BY feature ORDER BY quarter) AS before FROM q_psi) WHERE psi > 0.05 AND before > 0.05""",
       ["q_psi"])
def drift_retraining_due(spark, sf):
    return drift.retraining_due(q_psi(spark, sf), threshold=0.05).withColumn("psi", F.round("psi", 7))


@query("drift_retraining_decision", """
 WITH s AS (SELECT DISTINCT feature FROM (
  SELECT *, lag(psi) OVER (PARTITION BY feature ORDER BY quarter) AS before FROM q_psi) WHERE psi > 0.25 AND before > 0.25),
 c AS (SELECT avg(CAST(actual BETWEEN 500 AND 2500 AS INTEGER)) AS coverage FROM scores)
 SELECT (SELECT count(*) FROM s) AS drifted_features, round(coverage, 9) AS coverage,
   (SELECT count(*) FROM s) > 0 OR coverage < 0.8 AS retrain FROM c""", ["q_psi", "scores"])
def drift_retraining_decision(spark, sf):
    covered = inputs.score_frame(spark, sf).agg(
        F.avg(F.col("actual").between(500, 2500).cast("int")).alias("empirical_coverage"))
    table = drift.retraining_decision(q_psi(spark, sf), covered)
    return table.withColumn("coverage", F.round("coverage", 9))
