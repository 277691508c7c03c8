"""Fits recover planted parameters; scoring and attributions obey their identities."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from ledgerlens.operators import bgnbd, boosting, conformal, gamma_gamma, likelihood, segments, stacking
from ledgerlens.operators.stability import materialise
from ledgerlens.sources.store import TableStore

TRUE = bgnbd.PurchaseModel(r=0.8, alpha=20.0, a=1.2, b=2.5)


def histories(n=6000, seed=4):
    """Purchase histories drawn from the model's own story: gamma rates, beta dropout."""
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rate, drop, length = draw.gamma(TRUE.r, 1 / TRUE.alpha), draw.beta(TRUE.a, TRUE.b), int(draw.integers(200, 700))
        clock, x, last = 0.0, 0, 0.0
        while True:
            clock += draw.exponential(1 / rate)
            if clock > length:
                break
            x, last = x + 1, clock
            if draw.random() < drop:
                break
        rows.append((i, x, int(round(last)), length))
    return rows


@pytest.fixture(scope="module")
def rfm(spark):
    rows = [(i, x, tx, t, float(100 + (i * 37) % 400) if x else 0.0) for i, x, tx, t in histories()]
    return materialise(spark.createDataFrame(rows, "customer_id long, frequency long, recency int, T int, monetary_value double"))


def test_purchase_model_recovers_planted_parameters(rfm):
    found = bgnbd.fit(rfm, penalizer=0.0)
    assert found.r == pytest.approx(TRUE.r, rel=0.15) and found.alpha == pytest.approx(TRUE.alpha, rel=0.25)
    assert found.a / (found.a + found.b) == pytest.approx(TRUE.a / (TRUE.a + TRUE.b), rel=0.2)


def test_spend_model_recovers_planted_parameters(spark):
    draw, (p, q, v) = np.random.default_rng(9), (6.0, 4.0, 15.0)
    rows = []
    for _ in range(5000):
        x, rate = int(draw.integers(1, 9)), draw.gamma(q, 1 / v)
        rows.append((x, float(draw.gamma(p * x, 1 / rate) / x)))
    found = gamma_gamma.fit(spark.createDataFrame(rows, "frequency long, monetary_value double"), penalizer=0.0)
    assert found.p * found.v / (found.q - 1) == pytest.approx(p * v / (q - 1), rel=0.05)
    assert found.q == pytest.approx(q, rel=0.2)


def test_fits_need_few_rounds_and_tell_when_they_stop_early(rfm, monkeypatch):
    rounds, evaluate = [], likelihood.evaluate
    monkeypatch.setattr(likelihood, "evaluate", lambda rows, model, points: rounds.append(len(points)) or evaluate(rows, model, points))
    assert bgnbd.fit(rfm, penalizer=0.0).converged and len(rounds) < 8
    assert not bgnbd.fit(rfm, penalizer=0.0, max_rounds=2).converged
    rounds.clear()
    assert gamma_gamma.fit(rfm, penalizer=0.01).converged and len(rounds) < 9
    assert not gamma_gamma.fit(rfm, penalizer=0.01, max_rounds=1).converged


@pytest.mark.parametrize("model,theta", [(bgnbd.row_model, (0.7, 12.0, 1.3, 2.1)), (gamma_gamma.row_model, (5.0, 3.5, 14.0))])
def test_row_derivatives_equal_differences(model, theta):
    draw = np.random.default_rng(3)
    x = draw.integers(1, 40, 50).astype(float)
    data = {"x": x, "t": x * 9 + 50, "tx": x * 9, "m": draw.lognormal(3, 1, 50), "weight": np.ones(50)}
    if model is bgnbd.row_model:
        data["x"][::4] = 0.0
    theta = np.array(theta)
    _, first, second = model(data, theta)
    for i in range(len(theta)):
        step = np.zeros(len(theta))
        step[i] = 1e-5 * theta[i]
        (up, up1, _), (down, down1, _) = model(data, theta + step), model(data, theta - step)
        assert np.allclose(first[i], (up - down) / (2 * step[i]), rtol=1e-5, atol=1e-6)
        assert np.allclose(second[i], (up1 - down1) / (2 * step[i]), rtol=1e-5, atol=1e-6)


def test_array_and_column_likelihoods_agree(rfm):
    part = rfm.where("customer_id < 300")
    mean = bgnbd.log_likelihood(part, TRUE).agg(F.avg("ll"), *[F.avg(f"g{i}") for i in range(4)]).first()
    rows = part.select(F.col("frequency").cast("double").alias("x"), F.col("recency").cast("double").alias("tx"),
                       F.col("T").cast("double").alias("t"), F.lit(1.0).alias("weight"))
    theta = (TRUE.r, TRUE.alpha, TRUE.a, TRUE.b)
    value, slopes, _ = likelihood.by_logarithms(np.log(theta), likelihood.evaluate(rows, bgnbd.row_model, [theta])[0])
    assert [value, *slopes] == pytest.approx(list(mean), rel=1e-7)


def test_scoring_identities(rfm):
    scored = rfm.select("frequency", bgnbd.p_alive(TRUE).alias("alive"), *[
        bgnbd.expected_purchases(TRUE, d).alias(f"e{d}") for d in (1, 30, 365)])
    row = scored.agg(
        F.min("alive").alias("lo"), F.max("alive").alias("hi"),
        F.min(F.when(F.col("frequency") == 0, F.col("alive"))).alias("new"),
        F.count_if((F.col("e1") > F.col("e30")) | (F.col("e30") > F.col("e365")) | (F.col("e1") < 0)).alias("bad")).first()
    assert 0 <= row["lo"] <= row["hi"] <= 1 and row["new"] == 1.0 and row["bad"] == 0


def test_expected_purchases_match_simulation_for_new_customers(spark):
    """x = 0, T = 0: the expectation is the unconditional mean, known in closed form for small t."""
    one = spark.createDataFrame([(0, 0, 0)], "frequency long, recency int, T int")
    got = one.select(bgnbd.expected_purchases(TRUE, 60).alias("e")).first()["e"]
    draw = np.random.default_rng(1)
    n, total = 40000, 0
    for rate, drop in zip(draw.gamma(TRUE.r, 1 / TRUE.alpha, n), draw.beta(TRUE.a, TRUE.b, n)):
        clock = draw.exponential(1 / rate)
        while clock <= 60:
            total += 1
            if draw.random() < drop:
                break
            clock += draw.exponential(1 / rate)
    assert got == pytest.approx(total / n, rel=0.04)


def test_customer_value_by_parts_equals_the_plain_sum(rfm):
    spend = gamma_gamma.SpendModel(6.0, 4.0, 15.0)
    plain = F.lit(0.0)
    for i in range(1, 13):
        before = bgnbd.expected_purchases(TRUE, 30 * (i - 1)) if i > 1 else F.lit(0.0)
        plain = plain + (bgnbd.expected_purchases(TRUE, 30 * i) - before) / F.lit(1.01 ** i)
    sample = rfm.where("customer_id < 200")
    rows = sample.select("frequency", gamma_gamma.customer_value(TRUE, spend, 12, 0.01, 0.6).alias("v"),
                         (plain * 0.6 * gamma_gamma.expected_spend(spend)).alias("plain")).collect()
    for r in rows:
        assert r["v"] == (pytest.approx(r["plain"], rel=1e-9) if r["frequency"] > 0 else 0.0)


def test_ridge_equals_numpy_and_round_trips(spark, tmp_path):
    draw = np.random.default_rng(6)
    y = draw.lognormal(2, 0.5, 300)
    u, v = y * draw.uniform(0.6, 1.4, 300), y * draw.uniform(0.7, 1.3, 300)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(y, u, v)], "y double, u double, v double")
    model = stacking.fit(df, "y", "u", "v", alpha=1.0)
    X = np.column_stack([u - u.mean(), v - v.mean()])
    beta = np.linalg.solve(X.T @ X + np.eye(2), X.T @ (y - y.mean()))
    assert (model.bgf, model.gbt) == pytest.approx(tuple(beta))
    assert model.intercept == pytest.approx(y.mean() - beta @ [u.mean(), v.mean()])
    store = TableStore(spark, str(tmp_path))
    store.write_params("stack", model)
    assert store.read_params("stack", stacking.StackModel) == model


INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(F.col("id").alias("customer_id"), (F.col("id") % 17).cast("double").alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("c"))
    return materialise(df.withColumn("y", F.col("a") * 3 + F.col("b") * F.col("b")))


SMALL = boosting.BoostParams(n_estimators=8, learning_rate=0.3, max_depth=4, min_child_samples=2, subsample=1.0, colsample=1.0)


def test_boosting_fits_and_round_trips(spark, table, tmp_path):
    model = boosting.train(table, INPUTS, "y", SMALL)
    fitted = boosting.predict(model, table, INPUTS)
    assert fitted.agg(F.corr("y", "prediction")).first()[0] > 0.97
    store = TableStore(spark, str(tmp_path))
    store.write_model("gbt", model)
    again = boosting.predict(store.read_model("gbt", GBTRegressionModel), table, INPUTS, "again")
    gap = fitted.join(again.select("customer_id", "again"), "customer_id").agg(F.max(F.abs(F.col("prediction") - F.col("again")))).first()[0]
    assert gap == 0.0


def test_attributions_add_up(table):
    model = boosting.train(table, INPUTS, "y", SMALL)
    parts = boosting.attributions(model, table, INPUTS, permutations=3)
    sums = parts.groupBy("customer_id").agg(F.sum("contribution").alias("total"), F.first("base_value").alias("base"), F.count("*").alias("n"))
    joined = sums.join(boosting.predict(model, table, INPUTS), "customer_id")
    row = joined.agg(F.max(F.abs(F.col("total") + F.col("base") - F.col("prediction"))).alias("gap"), F.min("n").alias("n")).first()
    assert row["gap"] < 1e-9 and row["n"] == 3
    steps = boosting.waterfall(parts, top=2)
    per = {r["label"] for r in steps.where("customer_id = 5").collect()}
    assert {"Base", "Others", "Predicted CLV"} <= per and len(per) == 5
    assert boosting.global_importance(parts).first()["feature"] == "a"


def test_search_and_out_of_fold(table):
    space = {**boosting.SEARCH_SPACE, "n_estimators": (2, 4), "max_depth": (2, 3)}
    trials = boosting.draw_trials(2, 42, space)
    assert trials == boosting.draw_trials(2, 42, space)
    best, errors = boosting.tune(table, INPUTS, "y", trials, folds=2, parallelism=2)
    assert best in trials and len(errors) == 2
    held = boosting.out_of_fold(table, INPUTS, "y", SMALL, folds=2)
    assert held.count() == 400 and held.select("customer_id").distinct().count() == 400


def test_conformal_coverage_and_small_sets(spark):
    draw = np.random.default_rng(12)
    rows = [(i, float(e)) for i, e in enumerate(draw.normal(0, 10, 4000))]
    df = spark.createDataFrame(rows, "customer_id long, y double").withColumn("p", F.lit(0.0))
    model = conformal.calibrate(df.where("customer_id < 2000"), "y", "p", 0.1)
    scores = sorted(abs(e) for _, e in rows[:2000])
    assert model.half_width == scores[int(np.ceil(2001 * 0.9)) - 1] and model.n_calibration == 2000
    test = conformal.with_intervals(df.where("customer_id >= 2000"), model, "p")
    assert conformal.evaluate_coverage(test, "y").first()["empirical_coverage"] >= 0.9 - 0.02
    with pytest.raises(ValueError):
        conformal.calibrate(df.where("customer_id < 5"), "y", "p", 0.1)
    label = spark.createDataFrame([(1, 4200.4)], "customer_id long, p double")
    shown = conformal.with_intervals(label, conformal.IntervalModel(1400.0, 0.1, 9), "p").first()["clv_label"]
    assert shown == "CLV ₹4,200 (₹2,800–₹5,600)"


def test_segments_find_separated_groups(spark, tmp_path):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(600):
        g = i % 3
        rows.append((i, float(np.expm1(draw.normal((9, 5, 2)[g], 0.2))), float(np.clip(draw.normal((0.9, 0.5, 0.1)[g], 0.03), 0, 1)),
                     float(draw.normal((10, 100, 300)[g], 5))))
    df = spark.createDataFrame(rows, "customer_id long, predicted_clv double, p_alive double, recency_days double")
    model = segments.fit(df, k_range=(2, 3), select_starts=2, final_starts=2, select_rounds=40, final_rounds=40)
    assert set(model.bic) == {2, 3} and model.bic[3] < model.bic[2]
    named = segments.label_segments(segments.predict(model, df), model.names)
    sizes = {r["segment_name"]: r["count"] for r in named.groupBy("segment_name").count().collect()}
    assert sum(sizes.values()) == 600 and sizes["Champions"] == 200
    store = TableStore(spark, str(tmp_path))
    store.write_model("mixture", model.mixture)
    again = store.read_model("mixture", GaussianMixtureModel)
    assert np.allclose(again.weights, model.mixture.weights)


def test_mixture_starts_share_passes_and_end_as_sparks_own(spark, tmp_path):
    draw = np.random.default_rng(9)
    rows = [(i, float(np.expm1(abs(draw.normal((7, 5, 3, 2)[i % 4], 0.9)))), 0.5 if i % 5 == 0 else float(draw.uniform(0, 1)),
             float(draw.normal((30, 90, 200, 0)[i % 4], 40))) for i in range(900)]
    rows += [(None, None, None, None), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "customer_id long, predicted_clv double, p_alive double, recency_days double").coalesce(2)
    spark.sparkContext.setJobGroup("mixture", "one fit")
    model = segments.fit(df, k_range=(2, 3), select_starts=3, final_starts=4, select_rounds=12, final_rounds=30)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("mixture"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 80  # one fit after another: some 30 rounds of four starts and 12 of six, a job each and more
    scaled = model.scaler.transform(segments._vector(segments.segment_inputs(df)))
    fits = {(k, s): GaussianMixture(featuresCol="_scaled", k=k, maxIter=m, tol=1e-3, seed=s).fit(scaled)
            for k, m, n in ((2, 12, 3), (3, 12, 3)) for s in range(42, 42 + n)}
    for k, value in model.bic.items():
        assert np.isclose(value, segments.bic(max(f.summary.logLikelihood for (j, _), f in fits.items() if j == k), k, 903), rtol=1e-10)
    k = min(model.bic, key=model.bic.get)
    last = [GaussianMixture(featuresCol="_scaled", k=k, maxIter=30, tol=1e-3, seed=s).fit(scaled) for s in range(42, 46)]
    best = max(last, key=lambda f: f.summary.logLikelihood)
    for got in (model.mixture, (TableStore(spark, str(tmp_path)).write_model("m", model.mixture),
                                TableStore(spark, str(tmp_path)).read_model("m", GaussianMixtureModel))[1]):
        assert np.allclose(got.weights, best.weights, rtol=1e-7)
        for one, other in zip(got.gaussians, best.gaussians):
            assert np.allclose(one.mean.toArray(), other.mean.toArray(), atol=1e-7) and np.allclose(one.cov.toArray(), other.cov.toArray(), atol=1e-7)
        assert got.getK() == k
    ids = lambda m: sorted(r["segment_id"] for r in m.setPredictionCol("segment_id").transform(scaled).collect())
    assert ids(model.mixture) == ids(best)


def test_cluster_names_rule(spark):
    rows = [(0, 9.0, 0.9), (1, 8.0, 0.2), (2, 5.0, 0.8), (3, 3.0, 0.5), (4, 1.0, 0.4), (5, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "segment_id int, log1p_clv double, p_alive double")
    got = {r["segment_id"]: r["segment_name"] for r in segments.cluster_names(df).collect()}
    assert got == {0: "Champions", 1: "At-Risk High-Value", 2: "Promising", 3: "Hibernating", 4: "Lost", 5: "Segment-5"}
    lively = df.withColumn("p_alive", F.when(F.col("segment_id") == 1, 0.95).otherwise(F.col("p_alive")))
    got = {r["segment_id"]: r["segment_name"] for r in segments.cluster_names(lively).collect()}
    assert got[1] == got[2] == "Promising"
