"""Leaf-wise trees, exact attributions and the sequential search against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import forest, search
from ledgerlens.operators.boosting import BoostParams
from ledgerlens.operators.stability import materialise
from ledgerlens.plans import jobs
from ledgerlens.plans.catalog.registry import SETTINGS
from ledgerlens.sources.retail import retail_lines
from ledgerlens.sources.store import TableStore

INPUTS = ["a", "b", "c"]
FEW = BoostParams(n_estimators=12, learning_rate=0.3, min_child_samples=5, num_leaves=6)


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select(
        F.col("id").alias("customer_id"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 23).cast("double").alias("b"),
        (F.col("id") % 3).cast("double").alias("c"))
    df = df.withColumn("y", F.col("a") * 3 + F.when(F.col("b") > 11, F.col("c") * 20).otherwise(0.0))
    return materialise(df.withColumn("a", F.when(F.col("customer_id") % 50 == 7, None).otherwise(F.col("a"))))


def raw(table):
    rows = table.orderBy("customer_id").select("customer_id", *INPUTS).collect()
    return [r[0] for r in rows], np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], float)


def known_value(model, tree, node, x, known):
    """Conditional expectation: inputs outside ``known`` go both ways by training rows."""
    f = model.feature[node]
    if f < 0:
        return model.value[node]
    left, right = model.left[node], model.right[node]
    if f in known:
        return known_value(model, tree, left if x[f] <= model.threshold[node] else right, x, known)
    return sum(model.cover[s] / model.cover[node] * known_value(model, tree, s, x, known) for s in (left, right))


def brute_shapley(model, x, d=3):
    whole = lambda known: model.base + sum(known_value(model, t, r, x, known) for t, r in enumerate(model.roots))
    out = []
    for j in range(d):
        total = 0.0
        for size in range(d):
            for some in itertools.combinations([k for k in range(d) if k != j], size):
                weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                total += weight * (whole({*some, j}) - whole(set(some)))
        out.append(total)
    return out, whole(set())


def test_attributions_equal_all_subsets(spark, table):
    model = forest.train(table, INPUTS, "y", FEW)
    keys, x = raw(table)
    got = {}
    for r in forest.attributions(model, table, INPUTS).collect():
        got[r["customer_id"], r["feature"]] = (r["contribution"], r["base_value"])
    assert len(got) == 3 * len(keys)
    for i in range(0, len(keys), 23):
        want, base = brute_shapley(model, x[i])
        for name, w in zip(INPUTS, want):
            assert got[keys[i], name] == pytest.approx((w, base), abs=1e-9)
    predicted = {r["customer_id"]: r["prediction"] for r in forest.predict(model, table, INPUTS).collect()}
    assert all(predicted[k] == pytest.approx(sum(got[k, n][0] for n in INPUTS) + got[k, "a"][1], abs=1e-8) for k in keys)


def test_paths_cover_the_space(spark, table):
    model = forest.train(table, INPUTS, "y", FEW)
    paths = forest.path_table(model, spark)
    assert paths.where("lower >= upper or share <= 0 or share > 1").count() == 0
    shares = paths.groupBy("tree", "leaf").agg(F.product("share").alias("s")).groupBy("tree").agg(F.sum("s").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in shares)


def test_limits_penalties_and_fit(table):
    model = forest.train(table, INPUTS, "y", BoostParams(n_estimators=60, learning_rate=0.2, colsample=1.0, reg_alpha=0.0, reg_lambda=0.0))
    fitted = forest.predict(model, table, INPUTS)
    assert fitted.where("a is not null").agg(F.corr("y", "prediction")).first()[0] > 0.99
    ends = [*model.roots[1:], len(model.feature)]
    for begin, end in zip(model.roots, ends):
        leaves = model.feature[begin:end] < 0
        assert leaves.sum() <= 31 and model.cover[begin:end][leaves].min() >= 20
    shallow = forest.train(table, INPUTS, "y", BoostParams(n_estimators=3, max_depth=1))
    assert len(shallow.feature) <= 9
    heavy = forest.train(table, INPUTS, "y", BoostParams(n_estimators=3, reg_alpha=1e9))
    assert np.abs(heavy.value).max() == 0.0 and len(heavy.feature) == 3
    assert forest.train(table.limit(0), INPUTS, "y", FEW).getNumTrees == 0


def test_fits_repeat_and_survive_the_store(spark, table, tmp_path):
    first, again = (forest.train(t, INPUTS, "y", FEW) for t in (table, table.repartition(5)))
    for name in ("feature", "threshold", "value", "cover"):
        assert np.array_equal(getattr(first, name), getattr(again, name))
    store = TableStore(spark, str(tmp_path))
    jobs._store_forest(store, "model", first)
    loaded = jobs.load_boosting(store, "model")
    assert loaded.inputs == tuple(INPUTS)
    gap = forest.predict(loaded, forest.predict(first, table, INPUTS), INPUTS, "again").agg(F.max(F.abs(F.col("prediction") - F.col("again")))).first()[0]
    assert gap == 0.0
    with pytest.raises(ValueError):
        forest.predict(first, table, ["b", "a", "c"])
    importance = {r["feature"]: r["importance"] for r in forest.split_importance(first, INPUTS).collect()}
    assert sum(importance.values()) == pytest.approx(1.0) and importance["a"] > importance["b"]


def test_samples_are_bounded_and_the_rest_is_still_scored(table):
    sample = forest.draw_sample(table, INPUTS, "y", fit_rows=100)
    assert len(sample.target) == 100
    held = forest.out_of_fold(table, INPUTS, "y", FEW, folds=3, fit_rows=200)
    assert held.count() == 600 and held.where("oof is null").count() == 0
    many = forest.draw_sample(table.withColumn("customer_id", F.lit(5)), INPUTS, "y", fit_rows=50)  # one key on all rows
    assert len(many.target) == 50


def test_out_of_fold_models_have_not_seen_the_fold(table):
    """A table whose target is the fold itself: no model can predict its own fold's value."""
    own = table.withColumn("y", forest.fold_id("customer_id", 4).cast("double"))
    held = forest.out_of_fold(own, INPUTS, "y", BoostParams(n_estimators=0), folds=4).groupBy("y").agg(F.min("oof").alias("lo"), F.max("oof").alias("hi"))
    for r in held.collect():
        assert r["lo"] == r["hi"] != r["y"]


def test_bin_edges():
    assert forest.bin_edges(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5]
    edges = forest.bin_edges(np.arange(10_000.0))
    assert len(edges) == 254 and np.ptp(np.diff(edges)) < 3
    assert forest.bin_edges(np.array([])).tolist() == [] == forest.bin_edges(np.ones(5)).tolist()


SMALL_SPACE = {**search.SPACE, "n_estimators": (2, 9, "int"), "num_leaves": (2, 8, "int")}


def test_search_follows_from_its_table(table):
    best, trials = search.search(table, INPUTS, "y", trials=22, folds=3, space=SMALL_SPACE)
    assert len(trials) == 22 and [t.trial for t in trials] == list(range(22))
    done = [t for t in trials if t.finished]
    assert best == search.params_of(min(done, key=lambda t: (t.loss, t.trial)).unit, 42, SMALL_SPACE)
    assert len(done) < 22 and all(t.finished for t in trials[:search.STARTS])  # poor trials stop after a fold
    for round_start in (10, 15, 20):
        for number in range(round_start, min(round_start + 5, 22)):
            assert trials[number].unit == search.propose(trials[:round_start], number, 42, tuple(SMALL_SPACE))
    for t in trials:
        p = search.params_of(t.unit, 42, SMALL_SPACE)
        assert 2 <= p.n_estimators <= 9 and 3 <= p.max_depth <= 12 and 1e-8 <= p.reg_alpha <= 10 and 0.3 <= p.colsample <= 1
    assert search.search(table, INPUTS, "y", trials=0)[0] == BoostParams(seed=42)


def test_proposals_move_towards_good_trials():
    trials = [search.Trial(i, {"learning_rate": i / 40}, abs(i / 40 - 0.7), True) for i in range(40)]
    found = [search.propose(trials, 100 + k, 1, ["learning_rate"])["learning_rate"] for k in range(20)]
    assert sum(abs(f - 0.7) < 0.15 for f in found) >= 15 and all(0 <= f <= 1 for f in found)


def test_density_is_one_on_average():
    points = [0.02, 0.4, 0.41, 0.97]
    grid = (np.arange(20_000) + 0.5) / 20_000
    assert np.mean([search.density(x, points) for x in grid]) == pytest.approx(1.0, abs=2e-3)


def test_a_run_with_search(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    jobs.run_data(store, retail_lines(spark, "/root/testdata/sf0.001"), SETTINGS)
    jobs.run_probabilistic(store, SETTINGS)
    jobs.run_value_models(store, SETTINGS, jobs.ModelPlan(trials=12, search_space=SMALL_SPACE))
    trials = store.read("boost_trials")
    assert trials.count() == 12 and set(SMALL_SPACE) < set(trials.columns)
    assert 2 <= jobs.load_boosting(store).getNumTrees <= 9
    parts = store.read("attributions").groupBy("customer_id").agg((F.sum("contribution") + F.first("base_value")).alias("s"))
    gap = parts.join(store.read("boosted_predictions"), "customer_id").agg(F.max(F.abs(F.col("s") - F.col("prediction")))).first()[0]
    assert gap < 1e-6


def _grown_plainly(codes, gradient, rows, params):
    """Leaf-wise growth written down without histograms: every border of every input of every leaf is tried."""
    def split(some):
        best, total = (1e-12, None, None), gradient[some].sum()
        worth = lambda g, n: max(abs(g) - params.reg_alpha, 0.0) ** 2 / (n + params.reg_lambda)
        for j in range(codes.shape[1]):
            for cut in range(int(codes.max())):
                left = some[codes[some, j] <= cut]
                n = len(left)
                if min(n, len(some) - n) >= params.min_child_samples:
                    g = gradient[left].sum()
                    gain = worth(g, n) + worth(total - g, len(some) - n) - worth(total, len(some))
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, j, cut)
        return best

    leaves = [(rows, 0, split(rows))]
    while len(leaves) < params.num_leaves:
        open_ = [i for i, (_, depth, s) in enumerate(leaves) if s[1] is not None and (params.max_depth < 0 or depth < params.max_depth)]
        if not open_:
            break
        some, depth, (_, j, cut) = leaves.pop(max(open_, key=lambda i: leaves[i][2][0]))
        leaves += [(side, depth + 1, split(side)) for side in (some[codes[some, j] <= cut], some[codes[some, j] > cut])]
    return {tuple(some) for some, _, _ in leaves}


@pytest.mark.parametrize("params", [
    BoostParams(num_leaves=9, min_child_samples=5), BoostParams(num_leaves=30, min_child_samples=12, max_depth=3), BoostParams(num_leaves=1)])
def test_leaves_of_a_tree_and_what_rows_reach(params):
    source = np.random.default_rng(3)
    codes, gradient = source.integers(0, 12, (200, 3)), source.normal(size=200)
    rows = np.flatnonzero(source.random(200) < 0.8)
    tree, reached = forest._grow(codes, gradient, rows, np.arange(3), 12, params)
    assert np.array_equal(reached, forest._reach(codes[rows], tree))
    leaf = forest._reach(codes[rows], {**tree, "value": list(range(len(tree["value"])))})
    assert {tuple(rows[leaf == i]) for i in np.unique(leaf)} == _grown_plainly(codes, gradient, rows, params)


def test_tabulated_attributions_equal_the_integrals():
    """Short paths are looked up, longer ones integrated; both for values on borders, beyond them, missing and infinite."""
    trees = (("a", 1.0, ("b", 0.0, (3.0, 4.0), ("a", 0.5, (1.0, 2.0), (7.0, 3.0))), ("c", 2.0, ("a", 4.0, (2.0, 5.0), (6.0, 1.0)), (9.0, 2.0))),
             ("c", 0.0, (1.5, 3.0), (2.5, 4.0)))
    groups = forest._grouped(forest.from_nested(INPUTS, 1.0, trees))
    assert len(groups) > 1
    values = [-np.inf, -1.0, 0.0, 0.5, 0.7, 1.0, 2.0, 4.0, 9.0, np.inf, np.nan]
    x = np.array([[a, b, c] for a in values for b in values for c in values])
    plain = np.zeros(x.shape)
    for g in groups:
        paid = forest._payments(g, forest._met(g, x[:, g.feature]))
        for leaf in range(len(g.value)):
            for at, j in enumerate(g.feature[leaf]):
                plain[:, j] += paid[:, leaf, at]
    assert np.allclose(forest.shapley(groups, x, 3), plain, rtol=0, atol=1e-12)
    monkey, forest.TABLE_INPUTS = forest.TABLE_INPUTS, 1
    try:
        assert np.allclose(forest.shapley(groups, x, 3), plain, rtol=0, atol=1e-12)
    finally:
        forest.TABLE_INPUTS = monkey


def test_folds_of_trials_that_cannot_be_stopped_run_together(table, monkeypatch):
    calls = []
    fit = search.fit_side_by_side
    monkeypatch.setattr(search, "fit_side_by_side", lambda spark, sample, jobs, keep_trees: calls.append(len(jobs)) or fit(spark, sample, jobs, keep_trees))
    search.search(table, INPUTS, "y", trials=11, folds=3, space=SMALL_SPACE)
    assert calls[:2] == [30, 1] and len(calls) == 3
