"""Tree fits over more labelled rows than a fit once took: covers, means, borders and scores come from all of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import forest, search, uplift
from ledgerlens.operators.boosting import BoostParams
from ledgerlens.operators.conformal import calibrate
from ledgerlens.operators.stability import materialise

ROWS = 200_600
PLAIN = BoostParams(n_estimators=1, learning_rate=1.0, num_leaves=7, min_child_samples=1, subsample=1.0, colsample=1.0, reg_alpha=0.0, reg_lambda=0.0)


@pytest.fixture(scope="module")
def many(spark):
    return materialise(spark.range(ROWS).select(
        F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 7919 % 1009).cast("double").alias("b"),
        (F.col("id") % 1000 * F.col("id") % 7877).cast("double").alias("y")))


def plain(many, *names):
    rows = many.orderBy("customer_id").select(*names).toPandas()
    return [rows[n].to_numpy() for n in names]


def test_attributions_start_from_the_mean_of_all_rows(many):
    model = forest.train(many, ["a", "b"], "y", PLAIN)
    (y,) = plain(many, "y")
    few = forest.attributions(model, many.where("customer_id < 20"), ["a", "b"]).collect()
    assert len(few) == 40 and all(r["base_value"] == pytest.approx(y.mean(), rel=1e-12) for r in few)


def test_the_first_split_counts_all_rows(spark, many):
    nodes = forest.train(many, ["a"], "y", PLAIN).table(spark).where("tree = 0").orderBy("node").collect()
    a, y = plain(many, "a", "y")
    root = nodes[0]
    left, right = nodes[root["left"]], nodes[root["right"]]
    goes_left = a <= root["threshold"]
    assert root["cover"] == ROWS and (left["cover"], right["cover"]) == (goes_left.sum(), (~goes_left).sum())
    assert [n["value"] for n in nodes if n["feature"] is None] == pytest.approx(
        [y[a == v].mean() - y.mean() for v in _values_by_leaf(nodes)], rel=1e-9)


def _values_by_leaf(nodes):
    """The one value of the input that each leaf is left with: the tree has as many leaves as there are values."""
    out = []
    for leaf in (n for n in nodes if n["feature"] is None):
        for value in range(7):
            at = nodes[0]
            while at["feature"] is not None:
                at = nodes[at["left"] if value <= at["threshold"] else at["right"]]
            if at["node"] == leaf["node"]:
                out.append(value)
    return out


def test_trials_are_scored_on_all_rows(many):
    """A search whose trials are all but constant: the error of the left-out folds is that of the other folds' means."""
    space = {"n_estimators": (1, 1, "int"), "reg_alpha": (1e12, 1e12, "log")}
    _, (trial,) = search.search(many, ["a"], "y", trials=1, folds=3, space=space)
    y, fold = plain(many.withColumn("fold", forest.fold_id("customer_id", 3)), "y", "fold")
    assert trial.loss == pytest.approx(np.mean([np.abs(y[fold == f] - y[fold != f].mean()).mean() for f in range(3)]), rel=1e-12)


def test_split_importance_weighs_the_gains_of_all_rows(many):
    a, b, y = plain(many, "a", "b", "y")
    edges = [forest.bin_edges(c) for c in (a, b)]
    codes = np.stack([np.searchsorted(e, c) for e, c in zip(edges, (a, b))], axis=1)
    _, (tree,) = forest.fit_sample(codes, y, PLAIN)
    gains = np.bincount([f for f in tree["feature"] if f >= 0], [g for f, g in zip(tree["feature"], tree["gain"]) if f >= 0], 2)
    model = forest.train(many, ["a", "b"], "y", PLAIN)
    got = {r["feature"]: r["importance"] for r in forest.split_importance(model, ["a", "b"]).collect()}
    assert (got["a"], got["b"]) == pytest.approx(tuple(gains / gains.sum()), rel=1e-6)
    assert model.gain.sum() == pytest.approx(gains.sum(), rel=1e-6)


def test_borders_are_those_of_all_values(spark):
    """Many and few values, ties across borders, none at all, missing and infinite ones: as sorting each whole column gives."""
    rows = materialise(spark.range(30_000).select(
        (F.col("id") * 7919 % 30_011).cast("double").alias("many"), F.floor(F.sqrt(F.col("id") % 90_000)).cast("double").alias("tied"),
        (F.col("id") % 255).cast("double").alias("just"), (F.col("id") % 256 - 128).cast("double").alias("over"), F.lit(None).cast("double").alias("none"),
        F.lit(4.0).alias("one"), F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).when(F.col("id") % 5 == 0, F.lit(float("-inf"))).otherwise(
            F.when(F.col("id") % 4 > 0, F.log(F.col("id") + 1.0))).alias("odd")))
    table = rows.toPandas().astype(float)
    for bins in (255, 16, 2):
        for name, got in zip(rows.columns, forest.borders(rows, rows.columns, bins)):
            values = table[name].to_numpy()
            assert np.array_equal(got, forest.bin_edges(values[~np.isnan(values)], bins)), (name, bins)


def test_intervals_rest_on_a_model_of_the_whole_training_part(spark):
    """Means of the training part are the centers, so the half width is an order statistic known beforehand."""
    matrix = materialise(spark.range(420_000).select(
        F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 1000 * F.col("id") % 7877).cast("double").alias("target"),
        F.when(F.col("id") % 2 == 0, "train").otherwise("calibration").alias("part")))
    model = forest.train(matrix.where("part = 'train'"), ["a"], "target", PLAIN)
    assert model.cover[0] == 210_000
    a, y, part = plain(matrix, "a", "target", "part")
    train, rest = part == "train", part != "train"
    centers = np.array([y[train & (a == v)].mean() for v in range(7)])
    scores = np.sort(np.abs(y[rest] - centers[a[rest].astype(int)]))
    half = calibrate(forest.predict(model, matrix.where("part <> 'train'"), ["a"], "p"), "target", "p", 0.1)
    assert half.half_width == pytest.approx(scores[int(np.ceil((len(scores) + 1) * 0.9)) - 1], rel=1e-9)


def test_out_of_fold_trees_see_all_rows_of_the_other_folds(many):
    """A leaf for each value: everybody gets the mean of their value in the other folds."""
    held = forest.out_of_fold(many, ["a"], "y", PLAIN, folds=3)
    a, y, fold, got = plain(held.join(many.select("customer_id", "a"), "customer_id").withColumn("fold", forest.fold_id("customer_id", 3)), "a", "y", "fold", "oof")
    assert len(got) == ROWS
    for f in range(3):
        for value in range(7):
            assert got[(fold == f) & (a == value)] == pytest.approx(y[(fold != f) & (a == value)].mean(), rel=1e-9)


def test_out_of_fold_means_are_those_of_all_other_rows(many):
    held = forest.out_of_fold(many, ["a"], "y", BoostParams(n_estimators=0), folds=4)
    y, fold, got = plain(held.withColumn("fold", forest.fold_id("customer_id", 4)), "y", "fold", "oof")
    for f in range(4):
        assert got[fold == f] == pytest.approx(y[fold != f].mean(), rel=1e-12)


def test_arms_are_fitted_on_all_their_rows(spark):
    table = materialise(spark.range(406_000).select(
        F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 1000 * F.col("id") % 7877).cast("double").alias("y"),
        (F.col("id") % 2).cast("int").alias("treatment")))
    models = uplift.fit_t_learner(table, ["a"], "y", params=PLAIN)
    assert [m.cover[0] for m in models] == [203_000, 203_000]
    a, y, treatment, got = plain(uplift.predict_uplift(models, table, ["a"]), "a", "y", "treatment", "uplift_score")
    for value in range(7):
        same = a == value
        assert got[same] == pytest.approx(y[same & (treatment == 1)].mean() - y[same & (treatment == 0)].mean(), rel=1e-9, abs=1e-6)
