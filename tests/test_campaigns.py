"""Budget and uplift against step-by-step loops on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import budget, uplift


@pytest.fixture(scope="module")
def people():
    draw = np.random.default_rng(11)
    return [(i, int(u), int(c), ("A", "B", "C")[i % 3]) for i, (u, c) in enumerate(zip(draw.integers(-40, 60, 300), draw.integers(0, 5000, 300)))]


@pytest.fixture(scope="module")
def df(spark, people):
    return spark.createDataFrame(people, "customer_id long, uplift_score long, predicted_clv long, segment_name string")


def greedy(people, money, cost):
    chosen = []
    for person in sorted(people, key=lambda p: (-p[1], p[0])):
        if money < cost or person[1] <= 0:
            break
        chosen.append(person)
        money -= cost
    return chosen


@pytest.mark.parametrize("money", [0, 149, 150, 4000, 10**6])
def test_greedy(df, people, money):
    chosen = greedy(people, money, 150)
    selected = budget.optimize_greedy(df, money, 150)
    assert {r["customer_id"] for r in selected.collect()} == {p[0] for p in chosen}
    summary = budget.allocation_summary(selected, 150).first()
    assert summary["n_targeted"] == len(chosen) and summary["incremental_revenue"] == sum(p[1] for p in chosen)
    assert summary["total_cost"] <= money
    assert summary["roi"] == (pytest.approx(sum(p[1] for p in chosen) / (150 * len(chosen))) if chosen else 0.0)


def test_curve_equals_one_greedy_run_per_budget_and_never_falls(df, people):
    rows = budget.roi_curve(df, budget.budget_grid(df, 0, 30_000, 20), 150).orderBy("point").collect()
    assert [r["n_targeted"] for r in rows] == [len(greedy(people, r["budget"], 150)) for r in rows]
    assert [r["incremental_revenue"] for r in rows] == [float(sum(p[1] for p in greedy(people, r["budget"], 150))) for r in rows]
    assert all(a["incremental_revenue"] <= b["incremental_revenue"] for a, b in zip(rows, rows[1:]))


def test_scenarios_scale_revenue_only(df):
    base = budget.allocation_summary(budget.optimize_greedy(df, 3000, 150), 150)
    rows = {r["scenario"]: r for r in budget.under_scenarios(base).collect()}
    assert len({r["n_targeted"] for r in rows.values()}) == 1
    assert rows["optimistic"]["incremental_revenue"] == pytest.approx(rows["base"]["incremental_revenue"] * 1.3)
    with pytest.raises(ValueError):
        budget.under_scenarios(base, {"none": 0.0})


def test_breakdown_and_empty_schema(df):
    table = budget.segment_breakdown(budget.optimize_greedy(df, 3000, 150), 150)
    rows = table.collect()
    assert sum(r["n_targeted"] for r in rows) == 20 and sum(r["pct_of_budget"] for r in rows) == pytest.approx(100, abs=0.3)
    empty = budget.segment_breakdown(budget.optimize_greedy(df, 0, 150), 150)
    assert empty.count() == 0 and set(empty.columns) == set(table.columns)


def test_report_gain(df, people):
    gains = budget.optimize_greedy(budget.with_clv_gain(df, 1.3), 3000, 150, gain="gain", positive_only=False)
    best = sorted(people, key=lambda p: (-p[1] * p[2], p[0]))[:20]
    assert {r["customer_id"] for r in gains.collect()} == {p[0] for p in best}
    curve = budget.cumulative_gain(budget.with_clv_gain(df), "gain").orderBy("rank").collect()
    assert curve[-1]["model_gain"] == pytest.approx(sum(p[1] * p[2] for p in people))
    assert curve[-1]["random_gain"] == pytest.approx(curve[-1]["model_gain"]) and curve[0]["random_gain"] == 0.0


def test_uplift_ranking_classes(df):
    ranked = uplift.rank_by_uplift(df).collect()
    assert sorted(r["uplift_rank"] for r in ranked) == list(range(1, 301))
    counts = {s: sum(r["segment"] == s for r in ranked) for s in ("Persuadable", "Favourable", "Neutral/Negative")}
    assert counts == {"Persuadable": 30, "Favourable": 60, "Neutral/Negative": 210}
    top = uplift.top_persuadable(uplift.rank_by_uplift(df), 10).collect()
    assert [r["uplift_rank"] for r in top] == list(range(1, 11))


def test_qini_curve(spark, people):
    draw = np.random.default_rng(2)
    rows = [(p[0], p[1], int(y), int(t)) for p, y, t in zip(people, draw.integers(0, 100, 300), draw.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "customer_id long, uplift_score long, y long, treatment long")
    got = {r["rank"]: r for r in uplift.qini_curve(df, "y", "uplift_score").collect()}
    st = sc = nt = nc = 0
    for i, (_, _, y, t) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1):
        st, nt, sc, nc = st + y * t, nt + t, sc + y * (1 - t), nc + 1 - t
        if i % 3 == 0 or i == 300:
            expected = (st / max(nt, 1) - sc / max(nc, 1)) * nt * i / 300
            assert got[i]["qini_model"] == pytest.approx(expected)
    assert got[0]["qini_model"] == 0.0 and got[300]["qini_random"] == pytest.approx(got[300]["qini_model"])
    assert len(got) == 101


def test_arm_summary(df):
    rows = uplift.arm_summary(uplift.assign_arms(df, 0.3), "uplift_score").collect()
    assert sum(r["n"] for r in rows) == 300 and {r["treatment"] for r in rows} == {0, 1}
    assert df.count() == uplift.assign_arms(df).where(F.col("treatment").isin(0, 1)).count()
