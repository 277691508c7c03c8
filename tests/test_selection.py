"""Selection by refinement against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import order_statistic, quantiles, selected


def spots(total):
    return [F.lit(0), F.floor(total / 3), F.floor(total / 2), total - 1, total]


@pytest.mark.parametrize("kind", ["doubles", "longs", "hot", "tight", "extreme"])
def test_selected_values_equal_the_sorted_ones(spark, kind):
    rng = random.Random(kind)
    made = {
        "doubles": lambda: rng.gauss(0, 1) * 10 ** rng.randint(-9, 9),
        "longs": lambda: rng.randint(-2**62, 2**62),
        "hot": lambda: rng.choice([5, 5, 5, rng.randint(-20, 20)]),
        "tight": lambda: 1.0 + rng.randint(0, 500) * 2.0 ** -52,
        "extreme": lambda: rng.choice([math.inf, -math.inf, 1e308, -1e308, 5e-324, -5e-324, 0.0, 1e-300, rng.random()]),
    }[kind]
    whole = kind in ("longs", "hot")
    rows = [(rng.choice(["a", "b", None]), made()) for _ in range(700)] + [("a", None), ("c", None)]
    if not whole:
        rows += [("a", math.nan), ("c", math.nan)]
    df = spark.createDataFrame(rows, f"g string, v {'long' if whole else 'double'}")
    got = {r["g"]: r for r in selected(df, "v", spots, by=["g"]).collect()}
    assert set(got) == {"a", "b", None}
    for g, r in got.items():
        values = sorted(v for k, v in rows if k == g and v is not None and v == v)
        n = len(values)
        assert r["total"] == n
        assert [r[f"v{i}"] for i in range(5)] == [values[0], values[n // 3], values[n // 2], values[-1], None]


def test_selection_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "v double")
    assert quantiles(empty, "v", [0.5]).count() == 0 and order_statistic(empty, "v", lambda n: n).count() == 0
    same = spark.range(50).select(F.lit(2.5).alias("v"))
    assert quantiles(same, "v", [0.0, 0.5, 1.0]).first()["q"] == [2.5] * 3


def test_selection_sorts_and_ranges_nothing(spark, monkeypatch):
    """No range exchange: rows are counted in buckets, not dealt by value."""
    from pyspark.sql import DataFrame
    ranged = []
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda *a, **k: ranged.append(a))
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    assert quantiles(df, "v", [0.25]).first()["q"][0] == sorted(i * 7919 % 5003 for i in range(5000))[1249] * 0.25 + 0.75 * sorted(
        i * 7919 % 5003 for i in range(5000))[1250]
    assert not ranged


def test_correlations_equal_numpy_whatever_is_missing(spark):
    import numpy as np

    from ledgerlens.operators import explore
    draw = np.random.default_rng(5)
    x = draw.normal(size=(500, 4)) + np.array([0.0, 1e6, 1e3, 0.0])
    x[:, 2] += x[:, 1] - 1e6
    x[:, 3] = 7.1  # constant: no correlation
    x[draw.random(x.shape) < 0.1] = np.nan
    x[:, 3] = np.where(np.isnan(x[:, 3]), np.nan, 7.1)
    rows = [tuple(None if v != v and i % 2 else float(v) for v in r) for i, r in enumerate(x)]
    got = {(r["row_feature"], r["col_feature"]): r["r"] for r in explore.correlations(
        spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(7), ["a", "b", "c", "k"]).collect()}
    assert len(got) == 6
    for i, j in ((1, 0), (2, 0), (2, 1)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got["abck"[i], "abck"[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert got["k", "a"] is None and got["k", "c"] is None


def test_waterfall_of_wide_rows_exchanges_nothing(spark):
    from ledgerlens.operators import boosting
    wide = spark.createDataFrame([(1, 10.0, 3.0, -4.0, 0.5), (2, 10.0, 1.0, 1.0, -1.0)], "customer_id long, base_value double, a double, b double, c double")
    steps = boosting.waterfall_of_parts(wide, ["a", "b", "c"], top=2)
    got = [(r["position"], r["label"], r["amount"]) for r in steps.where("customer_id = 1").collect()]
    assert got == [(0, "Base", 10.0), (1, "b", -4.0), (2, "a", 3.0), (3, "Others", 0.5), (4, "Predicted CLV", 9.5)]
    assert [r["label"] for r in steps.where("customer_id = 2").collect()][1:3] == ["a", "b"]  # equal strengths by name
    assert "Exchange" not in steps._jdf.queryExecution().executedPlan().toString()
