import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import drift, metrics


def frame(spark, y, p):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")


def test_empty_inputs_give_nan(spark):
    row = metrics.regression_report(frame(spark, [], []), "y", "p").first()
    assert row["n"] == 0 and all(math.isnan(row[c]) for c in ("mae", "rmse", "mape", "pearson_r"))
    empty = spark.createDataFrame([], "y double, a double, b double")
    assert math.isnan(empty.agg(metrics.coverage(F.col("y"), F.col("a"), F.col("b"))).first()[0])


def test_all_zero_actuals_and_nans(spark):
    assert metrics.regression_report(frame(spark, [0, 0, 0], [1, 2, 3]), "y", "p").first()["mape"] == 0.0
    row = metrics.regression_report(frame(spark, [1, 2, float("nan"), 4], [2, 2, 5, 2]), "y", "p").first()
    assert row["mae"] == pytest.approx(1.0) and row["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert row["mape"] == pytest.approx((1.0 + 0 + 0.5) / 3 * 100)


def test_report_equals_numpy(spark):
    draw = np.random.default_rng(3)
    y, noise = draw.lognormal(7, 1.5, 500), draw.uniform(0.7, 1.3, 500)
    row = metrics.regression_report(frame(spark, y, y * noise), "y", "p").first()
    assert row["mae"] == pytest.approx(np.abs(y - y * noise).mean())
    assert row["pearson_r"] == pytest.approx(np.corrcoef(y, y * noise)[0, 1])


def test_decile_lift_bins_are_right_closed(spark):
    y = [float(i) for i in range(100)]
    rows = metrics.decile_lift(frame(spark, y, y), "y", "p").collect()
    assert [r["decile"] for r in rows] == list(range(1, 11)) and all(r["n_customers"] == 10 for r in rows)
    assert rows[0]["lift"] == pytest.approx(np.mean(range(90, 100)) / np.mean(y))
    tied = metrics.decile_lift(frame(spark, y, [1.0] * 60 + [2.0] * 40), "y", "p").collect()
    assert sum(r["n_customers"] for r in tied) == 100 and len(tied) <= 2


def qini_by_hand(y, score, t):
    order = sorted(range(len(y)), key=lambda i: (-score[i], i))
    n, nt = len(y), sum(t)
    ct = np.cumsum([y[i] * t[i] for i in order]) / nt
    cc = np.cumsum([y[i] * (1 - t[i]) for i in order]) / (n - nt)
    curve = ct - cc
    area = ((curve[1:] + curve[:-1]) / 2).sum() / n
    return (area - curve[-1] / 2) / abs(curve[-1] / 2)


def test_qini_coefficient(spark):
    draw = np.random.default_rng(5)
    y, t, s = draw.integers(0, 2, 400), draw.integers(0, 2, 400), draw.integers(0, 9, 400)
    df = spark.createDataFrame([(i, int(a), int(b), int(c)) for i, (a, b, c) in enumerate(zip(y, s, t))],
                               "customer_id long, y long, s long, t long")
    assert metrics.qini_coefficient(df, "y", "s", "t").first()["qini"] == pytest.approx(qini_by_hand(y, s, t))
    one_arm = df.withColumn("t", F.lit(1))
    assert math.isnan(metrics.qini_coefficient(one_arm, "y", "s", "t").first()["qini"])


def psi_by_hand(expected, actual, bins=10):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, bins + 1)))
    if len(edges) < 2:
        return 0.0
    inner = edges[1:-1]
    e, a = (np.bincount(np.searchsorted(inner, v, side="right"), minlength=len(edges) - 1).astype(float) for v in (expected, actual))
    e, a = ((c + 1e-8) / (c.sum() + 1e-8 * len(c)) for c in (e, a))
    return float(((a - e) * np.log(a / e)).sum())


def test_psi_equals_numpy_and_vanishes_on_itself(spark):
    draw = np.random.default_rng(7)
    base = {"money": draw.exponential(3000, 2000), "count": draw.poisson(5, 2000), "flat": np.full(2000, 4.0)}
    now = {"money": draw.exponential(3500, 1500), "count": draw.poisson(5, 1500), "flat": draw.normal(0, 1, 1500)}

    def table(data):
        return spark.createDataFrame([tuple(float(v) for v in row) for row in zip(*data.values())],
                                     ", ".join(f"{c} double" for c in data))

    names = list(base)
    got = {r["feature"]: r["psi"] for r in drift.feature_psi(table(base), table(now), names).collect()}
    for name in names:
        assert got[name] == pytest.approx(psi_by_hand(base[name], now[name]), abs=1e-9)
        assert got[name] >= 0
    same = drift.feature_psi(table(base), table(base), [*names, "absent"]).collect()
    assert len(same) == 3 and all(abs(r["psi"]) < 1e-12 for r in same)


def test_one_empty_side_is_nan_and_unknown(spark):
    a = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y double")
    rows = {r["feature"]: r for r in drift.detect_drift(drift.feature_psi(a, b, ["x", "y"])).collect()}
    assert math.isnan(rows["y"]["psi"]) and rows["y"]["status"] == "unknown" and rows["y"]["alert"] is False


def test_status_alerts_and_streaks(spark):
    rows = [("f", f"2010Q{q}", p) for q, p in ((1, 0.05), (2, 0.3), (3, 0.3), (4, 0.1))] + [("g", "2010Q4", float("nan"))]
    psi = spark.createDataFrame(rows, "feature string, quarter string, psi double")
    status = {(r["feature"], r["quarter"]): r["status"] for r in drift.detect_drift(psi).collect()}
    assert status == {("f", "2010Q1"): "stable", ("f", "2010Q2"): "significant", ("f", "2010Q3"): "significant",
                      ("f", "2010Q4"): "moderate", ("g", "2010Q4"): "unknown"}
    strict = psi.select(drift.status(F.col("psi"), 0.1, 0.3, strict=True).alias("s")).collect()
    assert [r["s"] for r in strict] == ["stable", "moderate", "moderate", "stable", "unknown"]
    assert drift.alerts(drift.latest_quarter(psi)).first()["message"] == (
        "🟡 MODERATE DRIFT on 'f': PSI = 0.1000 (threshold 0.1). Investigate.")
    assert [r["quarter"] for r in drift.retraining_due(psi).collect()] == ["2010Q3"]


def test_comparison_table(spark):
    long = spark.createDataFrame([("A", "MAE", 1.23456), ("A", "r", 0.5), ("B", "MAE", 2.0)], "model string, metric string, value double")
    got = {r["model"]: r for r in metrics.comparison_table(long).collect()}
    assert got["A"]["MAE"] == 1.2346 and got["B"]["r"] is None


def test_a_table_is_described_from_one_pass(spark):
    """The described table is worked out once; moments and quartiles come from its written values."""
    from ledgerlens.operators.explore import describe
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = spark.range(1, 102).selectExpr("cast(id as double) as a", "if(id > 51, null, id * 2D) as b").mapInArrow(count, "a double, b double")
    rows = {r["column"]: r for r in describe(table, ["a", "b"]).collect()}
    assert seen.value == 101
    assert (rows["a"]["n"], rows["a"]["mean"], rows["a"]["p25"], rows["a"]["max"]) == (101, 51.0, 26.0, 101.0)
    assert (rows["b"]["n"], rows["b"]["min"], rows["b"]["p50"]) == (51, 2.0, 52.0)
