"""Global ranks, running totals and quantiles against plain numpy, with hot values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import order_statistic, quantiles, quantiles_many
from ledgerlens.operators.ranking import SLOT, by_score, place, running_totals


def hot_rows(n=3000, seed=1):
    """A third of all rows share one score."""
    draw = np.random.default_rng(seed)
    scores = draw.integers(-50, 50, n)
    scores[: n // 3] = 7
    return [(int(i), int(s), int(i) % 11) for i, s in enumerate(draw.permutation(scores))]


def test_rank_and_running_sum_match_a_plain_sort(spark):
    rows = hot_rows()
    got = running_totals(spark.createDataFrame(rows, "customer_id long, score long, amount long"),
                         by_score("score"), sums=["amount"]).collect()
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    sums = np.cumsum([r[2] for r in expected])
    by_id = {r["customer_id"]: r for r in got}
    assert len(got) == len(rows)
    for place_no, (row, total) in enumerate(zip(expected, sums), start=1):
        assert by_id[row[0]]["rank"] == place_no
        assert by_id[row[0]]["cum_amount"] == total


def test_a_hot_score_is_cut_into_several_slots(spark):
    df = spark.createDataFrame(hot_rows(), "customer_id long, score long, amount long")
    sizes = [r["count"] for r in place(df, by_score("score")).rows.groupBy(SLOT).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000


def test_ranks_within_groups_restart_at_one(spark):
    rows = [(i, i % 3, (i * 37) % 101) for i in range(600)]
    df = spark.createDataFrame(rows, "customer_id long, g long, score long")
    got = running_totals(df, by_score("score"), by=["g"]).collect()
    for g in range(3):
        expected = [r[0] for r in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))]
        assert [r["customer_id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])] == expected


@pytest.mark.parametrize("probs", [[0.0, 0.5, 1.0], [0.1 * i for i in range(11)], [0.999]])
def test_quantiles_equal_numpy(spark, probs):
    rows = hot_rows()
    got = quantiles(spark.createDataFrame(rows, "id long, score long, g long"), "score", probs).first()
    assert got["n"] == len(rows)
    np.testing.assert_allclose(got["q"], np.quantile([r[1] for r in rows], probs), rtol=0, atol=1e-9)


def test_grouped_quantiles_skip_nulls_and_nans(spark):
    rows = [(i % 4, float((i * 7919) % 997)) for i in range(2000)] + [(0, None), (1, float("nan"))]
    got = {r["g"]: r for r in quantiles(spark.createDataFrame(rows, "g long, v double"), "v", [0.25, 0.9], by=["g"]).collect()}
    for g in range(4):
        values = [v for k, v in rows if k == g and v is not None and v == v]
        assert got[g]["n"] == len(values)
        np.testing.assert_allclose(got[g]["q"], np.quantile(values, [0.25, 0.9]), atol=1e-9)


def test_quantiles_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(5.0,)] * 50, "v double")
    assert quantiles(one, "v", [0.0, 0.37, 1.0]).first()["q"] == [5.0, 5.0, 5.0]
    assert quantiles(one.where("v < 0"), "v", [0.5]).where("q[0] is not null").count() == 0


def test_several_columns_in_one_pass(spark):
    df = spark.range(101).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"))
    got = {r["column"]: r["q"] for r in quantiles_many(df, ["a", "b"], [0.5, 0.95]).collect()}
    assert got == {"a": [50.0, 95.0], "b": [100.0, 190.0]}


def test_order_statistic(spark):
    df = spark.range(100).select(((F.col("id") * 37) % 100).alias("v"))
    assert order_statistic(df, "v", lambda n: F.lit(10)).first()["v0"] == 9
    assert order_statistic(df, "v", lambda n: n + 1).where("v0 is not null").count() == 0
