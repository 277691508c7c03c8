"""Folds, stacking, attributions, intervals, and the tree and mixture fits."""

from __future__ import annotations

from itertools import combinations
from math import factorial
from uuid import uuid4

import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.functions.splits import conformal_part, fold_id
from ledgerlens.operators import bgnbd, boosting, conformal, forest, gamma_gamma, search, stacking, uplift
from ledgerlens.operators.stability import checkpoint_folder, materialise, ship, spread
from ledgerlens.plans.catalog import customers, inputs, value
from ledgerlens.plans.catalog.evaluation import HASH, pairs
from ledgerlens.plans.catalog.registry import SETTINGS, fragment, query
from ledgerlens.sources.store import TableStore

@query("split_folds", f"SELECT c_custkey AS customer_id, CAST({HASH.format(salt='fold', key='c_custkey')} % 5 AS INTEGER) AS fold FROM customer")
def split_folds(spark, sf):
    return spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias("customer_id"), fold_id("c_custkey", SETTINGS.folds).alias("fold"))


PART = "CASE WHEN {h} < 600 THEN 'train' WHEN {h} < 800 THEN 'calibration' ELSE 'test' END"
PART_SQL = PART.format(h=HASH.format(salt="conformal", key="customer_id"))


@query("split_conformal", f"SELECT customer_id, {PART_SQL} AS part FROM scores", ["scores"])
def split_conformal(spark, sf):
    return inputs.score_frame(spark, sf).select("customer_id", conformal_part("customer_id").alias("part"))


fragment("ridge", """
 WITH m AS (SELECT avg(y) AS my, avg(p2) AS mu, avg(p) AS mv, var_pop(p2) * count(*) + 1.0 AS uu, var_pop(p) * count(*) + 1.0 AS vv,
   covar_pop(p2, p) * count(*) AS uv, covar_pop(p2, y) * count(*) AS uy, covar_pop(p, y) * count(*) AS vy FROM pairs),
 b AS (SELECT *, (vv * uy - uv * vy) / (uu * vv - uv * uv) AS bgf, (uu * vy - uv * uy) / (uu * vv - uv * uv) AS gbt FROM m)
 SELECT my - bgf * mu - gbt * mv AS intercept, bgf, gbt FROM b""", ["pairs"])


def stack_pairs(spark, sf):
    """Base predictions that are not multiples of each other, so the normal equations are well posed."""
    return materialise(pairs(spark, sf))


@query("stack_ridge_parameters", "SELECT round(intercept, 1) AS intercept, round(bgf, 6) AS bgf, round(gbt, 6) AS gbt FROM ridge", ["ridge"])
def stack_ridge_parameters(spark, sf):
    return stacking.ridge_parameters(stack_pairs(spark, sf), "y", "p2", "p").select(
        F.round("intercept", 1).alias("intercept"), F.round("bgf", 6).alias("bgf"), F.round("gbt", 6).alias("gbt"))


FIXED = stacking.StackModel(intercept=250.0, bgf=-0.13, gbt=1.09)


@query("stack_predict", "SELECT customer_id, round(250.0::DOUBLE - 0.13::DOUBLE * p2 + 1.09::DOUBLE * p, 2) AS stacked FROM pairs", ["pairs"])
def stack_predict(spark, sf):
    return pairs(spark, sf).select(
        "customer_id", F.round(stacking.stacked(FIXED, F.col("p2"), F.col("p")), 2).alias("stacked"))


@query("stack_evaluate", " UNION ALL ".join(
    f"""SELECT '{label}' AS model, round(avg(abs(y - {p})), 2) AS "MAE", round(sqrt(avg((y - {p}) * (y - {p}))), 2) AS "RMSE",
     round(avg(abs((y - {p}) / y)) FILTER (y <> 0) * 100, 2) AS "MAPE" FROM pairs"""
    for label, p in (("BG/NBD + Gamma-Gamma", "p2"), ("LightGBM", "p"),
                     ("Stacked Ensemble", "(250.0::DOUBLE - 0.13::DOUBLE * p2 + 1.09::DOUBLE * p)"))), ["pairs"])
def stack_evaluate(spark, sf):
    table = pairs(spark, sf).withColumn("s", stacking.stacked(FIXED, F.col("p2"), F.col("p")))
    return stacking.evaluate(table, "y", "p2", "p", "s")


@query("stack_final_predictions", """
 SELECT f.customer_id, round(250.0::DOUBLE - 0.13::DOUBLE * coalesce(s.predicted_clv, 0.0) + 1.09::DOUBLE * coalesce(g.prediction, 0.0), 6) AS predicted_clv,
   coalesce(s.predicted_clv, 0.0) AS predicted_clv_bgnbd, coalesce(g.prediction, 0.0) AS predicted_clv_lgbm,
   coalesce(s.p_alive, 0.0) AS p_alive
 FROM rfm f LEFT JOIN stand_in s USING (customer_id)
 LEFT JOIN (SELECT customer_id, CAST(customer_id % 777 AS DOUBLE) AS prediction FROM rfm) g USING (customer_id)""", ["rfm", "stand_in"])
def stack_final_predictions(spark, sf):
    inputs.land_lines(spark, sf)
    rfm = inputs.rfm(spark, sf)
    boosted = rfm.select("customer_id", (F.col("customer_id") % 777).cast("double").alias("prediction"))
    table = stacking.final_predictions(rfm, customers.stand_in(spark, sf), boosted, FIXED)
    return table.withColumn("predicted_clv", F.round("predicted_clv", 6))


# --- intervals -------------------------------------------------------------------------------

fragment("residual_scores", f"SELECT * FROM (SELECT *, abs(y - p) AS score, {PART_SQL} AS part FROM pairs)", ["pairs"])
fragment("half", """
 SELECT score AS half_width, n AS n_calibration FROM (
  SELECT score, row_number() OVER (ORDER BY score) AS r, count(*) OVER () AS n FROM residual_scores WHERE part = 'calibration')
 WHERE r = CAST(ceil((n + 1) * 0.9::DOUBLE - 1e-9) AS BIGINT)""", ["residual_scores"])


def parted(spark, sf):
    return pairs(spark, sf).withColumn("part", conformal_part("customer_id"))


def interval_model(spark, sf):
    return conformal.calibrate(parted(spark, sf).where(F.col("part") == "calibration"), "y", "p", SETTINGS.conformal_alpha)


@query("interval_calibration", "SELECT round(half_width, 2) AS half_width, n_calibration FROM half", ["half"])
def interval_calibration(spark, sf):
    table = conformal.calibration_quantile(
        parted(spark, sf).where(F.col("part") == "calibration"), "y", "p", SETTINGS.conformal_alpha)
    return table.select(F.round("half_width", 2).alias("half_width"), F.col("n_calibration"))


@query("interval_predictions", """
 SELECT customer_id, round(p - half_width, 2) AS clv_lower, round(p + half_width, 2) AS clv_upper,
   round(2 * half_width, 2) AS interval_width,
   'CLV ₹' || format('{:,}', CAST(round(p) AS BIGINT)) || ' (₹' || format('{:,}', CAST(round(p - half_width) AS BIGINT))
     || '–₹' || format('{:,}', CAST(round(p + half_width) AS BIGINT)) || ')' AS clv_label
 FROM pairs, half""", ["pairs", "half"])
def interval_predictions(spark, sf):
    table = conformal.with_intervals(pairs(spark, sf), interval_model(spark, sf), "p")
    return table.select("customer_id", *[F.round(c, 2).alias(c) for c in ("clv_lower", "clv_upper", "interval_width")], "clv_label")


@query("interval_coverage", """
 SELECT round(avg(CAST(y BETWEEN p - half_width AND p + half_width AS INTEGER)), 9) AS empirical_coverage,
   round(avg(2 * half_width), 2) AS avg_interval_width FROM residual_scores, half WHERE part = 'test'""", ["residual_scores", "half"])
def interval_coverage(spark, sf):
    test = conformal.with_intervals(parted(spark, sf).where(F.col("part") == "test"), interval_model(spark, sf), "p")
    return conformal.evaluate_coverage(test, "y").select(
        F.round("empirical_coverage", 9).alias("empirical_coverage"), F.round("avg_interval_width", 2).alias("avg_interval_width"))


@query("interval_width_statistics", """
 WITH w AS (SELECT (customer_id * 7919 % 1000)::DOUBLE AS w FROM scores)
 SELECT round(avg(w), 9) AS mean_width, round(quantile_cont(w, 0.5), 9) AS median_width, round(quantile_cont(w, 0.95), 9) AS p95_width FROM w""", ["scores"])
def interval_width_statistics(spark, sf):
    widths = inputs.score_frame(spark, sf).select((F.col("customer_id") * 7919 % 1000).cast("double").alias("interval_width"))
    table = conformal.width_statistics(widths)
    return table.select(*[F.round(c, 9).alias(c) for c in table.columns])


@query("interval_merge", """
 SELECT s.customer_id, s.predicted_clv, i.clv_lower, i.clv_upper, i.interval_width
 FROM (SELECT customer_id, predicted_clv FROM scores) s LEFT JOIN (
  SELECT customer_id, predicted_clv - 10 AS clv_lower, predicted_clv + 10 AS clv_upper, 20 AS interval_width
  FROM scores) i USING (customer_id)""", ["scores"])
def interval_merge(spark, sf):
    frame = inputs.score_frame(spark, sf).select("customer_id", "predicted_clv")
    ranges = frame.select(
        "customer_id", (F.col("predicted_clv") - 10).alias("clv_lower"), (F.col("predicted_clv") + 10).alias("clv_upper"),
        F.lit(20).alias("interval_width"))
    return conformal.merge_intervals(frame, ranges)


# --- attributions ----------------------------------------------------------------------------

COEFFICIENTS = {"frequency": 900.0, "recency": -2.5, "T": 1.75, "active_months": 400.0, "n_products": -33.0, "n_orders": 120.0}
fragment("linear_parts", " UNION ALL ".join(
    f"""SELECT customer_id, {' + '.join(f'{c}::DOUBLE * (SELECT avg({n}) FROM features)' for n, c in COEFFICIENTS.items())} + 50.0 AS base_value,
     '{name}' AS feature, {coefficient}::DOUBLE * ({name} - (SELECT avg({name}) FROM features)) AS contribution FROM features"""
    for name, coefficient in COEFFICIENTS.items()), ["features"])


def linear_parts(spark, sf):
    table = materialise(inputs.customer_features(spark, sf).select("customer_id", *COEFFICIENTS))
    return boosting.linear_attributions(table, COEFFICIENTS, intercept=50.0)


@query("attribution_linear", """
 SELECT customer_id, feature, round(base_value, 5) AS base_value, round(contribution, 5) AS contribution FROM linear_parts""", ["linear_parts"])
def attribution_linear(spark, sf):
    return linear_parts(spark, sf).withColumns({"base_value": F.round("base_value", 5), "contribution": F.round("contribution", 5)})


@query("attribution_waterfall", """
 WITH r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS r FROM linear_parts)
 SELECT customer_id, 0 AS position, 'Base' AS label, round(any_value(base_value), 5) AS amount FROM r GROUP BY 1
 UNION ALL SELECT customer_id, CAST(r AS INTEGER), feature, round(contribution, 5) FROM r WHERE r <= 4
 UNION ALL SELECT customer_id, 5, 'Others', round(sum(contribution) FILTER (r > 4), 5) FROM r GROUP BY 1
 UNION ALL SELECT customer_id, 6, 'Predicted CLV', round(any_value(base_value) + sum(contribution), 5) FROM r GROUP BY 1""", ["linear_parts"])
def attribution_waterfall(spark, sf):
    table = materialise(inputs.customer_features(spark, sf).select("customer_id", *COEFFICIENTS))
    parts = boosting.linear_parts(table, COEFFICIENTS, intercept=50.0)
    return boosting.waterfall_of_parts(parts, list(COEFFICIENTS)).withColumn("amount", F.round("amount", 5))


@query("attribution_global_importance", "SELECT feature, round(avg(abs(contribution)), 5) AS importance FROM linear_parts GROUP BY 1", ["linear_parts"])
def attribution_global_importance(spark, sf):
    return boosting.global_importance(linear_parts(spark, sf)).withColumn("importance", F.round("importance", 5))


# --- trees written down by hand: what is exact about a model, in SQL -----------------------------

TREE_INPUTS = ("frequency", "recency", "T")
BY_HAND = (
    ("frequency", 3.5, ("recency", 400.0, (120.0, 30.0), (340.0, 20.0)),
     ("T", 1500.0, (90.0, 10.0), ("frequency", 9.5, (410.0, 25.0), (700.0, 15.0)))),
    ("T", 1000.0, (-50.0, 40.0), ("recency", 900.0, (15.5, 35.0), ("T", 1700.5, (260.0, 15.0), (31.0, 10.0)))),
    ("recency", 200.0, ("frequency", 1.5, (-20.0, 12.0), (33.0, 18.0)), ("T", 1700.5, (5.0, 44.0), (88.0, 26.0))),
)
OTHER_ARM = (("T", 1200.0, (60.0, 50.0), ("frequency", 5.5, (-10.0, 20.0), (25.0, 30.0))),)


def _cover(node):
    return node[1] if len(node) == 2 else _cover(node[2]) + _cover(node[3])


def tree_sql(node, known=TREE_INPUTS):
    """The tree's value where the inputs in ``known`` are known: the others go both ways, by their shares of training rows."""
    if len(node) == 2:
        return f"{node[0]}::DOUBLE"
    name, cut, left, right = node
    a, b = tree_sql(left, known), tree_sql(right, known)
    if name in known:
        return f"(CASE WHEN {name} <= {cut} THEN {a} ELSE {b} END)"
    return f"(({_cover(left)}::DOUBLE * {a} + {_cover(right)}::DOUBLE * {b}) / {_cover(left) + _cover(right)}::DOUBLE)"


def forest_sql(trees, base, known=TREE_INPUTS):
    return " + ".join([f"{base}::DOUBLE", *(tree_sql(t, known) for t in trees)])


def shapley_sql(trees, base, name):
    """Σ over subsets of the other inputs of |S|!(d−|S|−1)!/d! times what knowing ``name`` adds."""
    others, d, terms = [n for n in TREE_INPUTS if n != name], len(TREE_INPUTS), []
    for size in range(len(others) + 1):
        weight = factorial(size) * factorial(d - size - 1) / factorial(d)
        terms += [f"{weight!r}::DOUBLE * (({forest_sql(trees, base, (*s, name))}) - ({forest_sql(trees, base, s)}))" for s in combinations(others, size)]
    return " + ".join(terms)


def by_hand(trees=BY_HAND, base=1000.0):
    return forest.from_nested(TREE_INPUTS, base, trees)


@query("attribution_tree_exact", " UNION ALL ".join(
    f"SELECT customer_id, '{n}' AS feature, round({shapley_sql(BY_HAND, 1000.0, n)}, 6) AS contribution, "
    f"round({forest_sql(BY_HAND, 1000.0, ())}, 6) AS base_value FROM rfm" for n in TREE_INPUTS), ["rfm"])
def attribution_tree_exact(spark, sf):
    """Attributions by path integrals; the SQL enumerates all subsets of the inputs."""
    return forest.attributions(by_hand(), inputs.rfm(spark, sf), TREE_INPUTS).withColumns(
        {"contribution": F.round("contribution", 6), "base_value": F.round("base_value", 6)})


@query("store_forest_reloaded", f"SELECT customer_id, {forest_sql(BY_HAND, 1000.0)} AS prediction FROM rfm", ["rfm"])
def store_forest_reloaded(spark, sf):
    """Trees stored as a table, loaded and applied."""
    store = TableStore(spark, f"{checkpoint_folder(spark)}/store-{uuid4().hex}")
    store.write("model", by_hand().table(spark).repartition(3))
    model = forest.from_table(store.read("model"), TREE_INPUTS)
    return forest.predict(model, inputs.rfm(spark, sf), TREE_INPUTS).select("customer_id", "prediction")


@query("uplift_stored_arms", f"""
 SELECT customer_id, ({forest_sql(BY_HAND, 1000.0)}) - ({forest_sql(OTHER_ARM, 900.0)}) AS uplift_score FROM rfm""", ["rfm"])
def uplift_stored_arms(spark, sf):
    """The treated model's prediction less the control model's, value by value."""
    arms = (by_hand(), by_hand(OTHER_ARM, 900.0))
    return uplift.predict_uplift(arms, inputs.rfm(spark, sf), TREE_INPUTS).select("customer_id", "uplift_score")


@query("store_value_models_reloaded", """
 SELECT customer_id, round(predicted_purchases, 7) AS predicted_purchases, round(p_alive, 9) AS p_alive,
   round(predicted_clv, 0) AS predicted_clv FROM predictions""", ["predictions"])
def store_value_models_reloaded(spark, sf):
    """Purchase and spend model stored, loaded and applied."""
    store = TableStore(spark, f"{checkpoint_folder(spark)}/store-{uuid4().hex}")
    store.write_params("model_purchases", value.BUY)
    store.write_params("model_spend", value.SPEND)
    scored = gamma_gamma.predict_all(
        inputs.rfm(spark, sf), store.read_params("model_purchases", bgnbd.PurchaseModel), store.read_params("model_spend", gamma_gamma.SpendModel), SETTINGS)
    return scored.select("customer_id", F.round("predicted_purchases", 7).alias("predicted_purchases"),
                         F.round("p_alive", 9).alias("p_alive"), F.round("predicted_clv", 0).alias("predicted_clv"))


# --- fits at the published sizes -------------------------------------------------------------------

MATRIX_INPUTS = ("frequency", "recency", "T", "monetary_value", "n_orders", "n_products", "avg_order_value", "return_rate")
PUBLISHED = boosting.BoostParams(seed=SETTINGS.seed)


def training_matrix(spark, sf):
    table = inputs.customer_features(spark, sf).join(inputs.actuals(spark, sf), "customer_id", "left")
    return materialise(spread(table.select("customer_id", *MATRIX_INPUTS, F.coalesce("holdout_revenue", F.lit(0.0)).alias("target"))))


@query("boost_predictions")
def boost_predictions(spark, sf):
    matrix = training_matrix(spark, sf)
    model = forest.train(matrix, MATRIX_INPUTS, "target", PUBLISHED)
    return forest.predict(model, matrix, MATRIX_INPUTS).select("customer_id", "target", "prediction")


SPLIT_INPUTS = ("frequency", "active_months", "cohort_index")
_WORTH = "(greatest(abs({g}) - 0.1::DOUBLE, 0) * greatest(abs({g}) - 0.1::DOUBLE, 0) / ({n} + 0.1::DOUBLE))"


@query("boost_first_split", f"""
 WITH y AS (SELECT f.*, coalesce(holdout_revenue, 0.0::DOUBLE) AS y FROM features f LEFT JOIN actuals USING (customer_id)),
 g AS (SELECT y.*, m - y AS g FROM y, (SELECT avg(y) AS m FROM y)),
 v AS ({" UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS feature, {c}::DOUBLE AS x, g FROM g" for i, c in enumerate(SPLIT_INPUTS))}),
 d AS (SELECT place, feature, x, count(*) AS n, sum(g) AS g FROM v GROUP BY ALL),
 c AS (SELECT place, feature, x, lead(x) OVER w AS next, sum(n) OVER w AS n, sum(g) OVER w AS g,
   sum(n) OVER (PARTITION BY place) AS all_n, sum(g) OVER (PARTITION BY place) AS all_g FROM d WINDOW w AS (PARTITION BY place ORDER BY x)),
 s AS (SELECT *, {_WORTH.format(g='g', n='n')} + {_WORTH.format(g='(all_g - g)', n='(all_n - n)')} - {_WORTH.format(g='all_g', n='all_n')} AS gain
   FROM c WHERE next IS NOT NULL AND n >= 20 AND all_n - n >= 20)
 SELECT feature, (x + next) / 2 AS threshold, round(-sign(g) * greatest(abs(g) - 0.1::DOUBLE, 0) / (n + 0.1::DOUBLE), 2) AS left_value,
   round(-sign(all_g - g) * greatest(abs(all_g - g) - 0.1::DOUBLE, 0) / (all_n - n + 0.1::DOUBLE), 2) AS right_value,
   CAST(n AS DOUBLE) AS left_rows FROM s ORDER BY gain DESC, place, x LIMIT 1""", ["features", "actuals"])
def boost_first_split(spark, sf):
    """The first split of a fitted model under both penalties; the SQL tries every border of every input."""
    table = inputs.customer_features(spark, sf).join(inputs.actuals(spark, sf), "customer_id", "left").withColumn(
        "target", F.coalesce("holdout_revenue", F.lit(0.0)))
    one = boosting.BoostParams(n_estimators=1, learning_rate=1.0, num_leaves=2, subsample=1.0, colsample=1.0)
    nodes = forest.train(table, SPLIT_INPUTS, "target", one).table(spark).where("tree = 0")
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("value").alias(f"{name}_value"), F.col("cover").alias(f"{name}_rows"))
    return nodes.where("node = 0").join(side("left"), "left").join(side("right"), "right").select(
        "feature", "threshold", F.round("left_value", 2).alias("left_value"), F.round("right_value", 2).alias("right_value"), "left_rows")


@query("boost_search")
def boost_search(spark, sf):
    """The published search: 30 trials over five folds."""
    best, trials = search.search(training_matrix(spark, sf), MATRIX_INPUTS, "target", SETTINGS.tuning_trials, SETTINGS.seed, SETTINGS.folds)
    table = search.trial_table(spark, trials, SETTINGS.seed)
    chosen = next(t.trial for t in trials if search.params_of(t.unit, SETTINGS.seed) == best)
    return table.withColumn("chosen", F.col("trial") == chosen)


STUDY_NAMES = ("learning_rate", "num_leaves")
_HEX = "CAST('0x' || substr(md5({text}), {at}, {n}) AS BIGINT)"
_KEY = "'42:' || next_trial || ':' || name || ':{what}' || c"
_UNIFORM = "(" + _HEX.format(text=_KEY, at=1, n=8) + " / 4294967296.0::DOUBLE)"
_NORMAL = "(((" + " + ".join(_HEX.format(text=_KEY, at=4 * i + 1, n=4) for i in range(8)) + ") / 65536.0::DOUBLE - 4) / sqrt(8.0::DOUBLE / 12))"
_KERNEL = "exp(-0.5::DOUBLE * pow((x - {m}) / width, 2))"
_DENSITY = f"(1 + sum({' + '.join(_KERNEL.format(m=m) for m in ('u', '(-u)', '(2 - u)'))}) / (any_value(width) * sqrt(2 * pi()))) / (count(*) + 1)"


@query("boost_search_proposals", f"""
 WITH t AS (SELECT c_nationkey AS study, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS trial,
   (c_custkey * 7919 % 1009) / 1009.0::DOUBLE AS learning_rate, (c_custkey * 104729 % 2003) / 2003.0::DOUBLE AS num_leaves,
   (c_custkey * 31 % 977)::DOUBLE AS loss, c_custkey % 6 <> 0 AS finished FROM customer),
 r AS (SELECT *, row_number() OVER (PARTITION BY study ORDER BY finished DESC, loss, trial) AS place, count(*) OVER (PARTITION BY study) AS n FROM t),
 p AS MATERIALIZED (
  SELECT study, name, place, n AS next_trial, least(CAST(ceil(0.1::DOUBLE * n) AS BIGINT), 25) AS top, place <= least(CAST(ceil(0.1::DOUBLE * n) AS BIGINT), 25) AS good,
   CASE name WHEN 'learning_rate' THEN learning_rate ELSE num_leaves END AS u FROM r, (SELECT unnest(['learning_rate', 'num_leaves']) AS name) WHERE n >= 10),
 w AS MATERIALIZED (SELECT study, name, good, any_value(next_trial) AS next_trial, any_value(top) AS top,
   greatest(1.06::DOUBLE * sqrt(greatest(0, avg(u * u) - avg(u) * avg(u))) * pow(count(*), -0.2::DOUBLE), 1 / (1.0::DOUBLE + count(*))) AS width FROM p GROUP BY 1, 2, 3),
 k AS (SELECT study, name, width, c, next_trial, top, CAST(floor({_UNIFORM.format(what='kernel')} * (top + 1)) AS BIGINT) AS kernel,
   {_UNIFORM.format(what='flat')} AS flat, {_NORMAL.format(what='normal')} AS z FROM w, (SELECT unnest(range(24)) AS c) WHERE good),
 m AS (SELECT k.*, CASE WHEN kernel = k.top THEN flat ELSE u + width * z END AS raw FROM k LEFT JOIN p ON p.study = k.study AND p.name = k.name AND place = kernel + 1),
 x AS MATERIALIZED (SELECT study, name, c, CASE WHEN kernel = top THEN raw WHEN raw - 2 * floor(raw / 2) > 1 THEN 2 - (raw - 2 * floor(raw / 2)) ELSE raw - 2 * floor(raw / 2) END AS x FROM m),
 d AS (SELECT x.study, x.name, c, any_value(x) AS pt, p.good, ln({_DENSITY}) AS density FROM x JOIN p ON p.study = x.study AND p.name = x.name
   JOIN w ON w.study = x.study AND w.name = x.name AND w.good = p.good GROUP BY x.study, x.name, c, p.good),
 s AS (SELECT study, name, c, any_value(pt) AS x, sum(CASE WHEN good THEN density ELSE -density END) AS score FROM d GROUP BY 1, 2, 3)
 SELECT study, name AS parameter, round(arg_max(x, score), 9) AS proposal FROM s GROUP BY 1, 2""")
def boost_search_proposals(spark, sf):
    """Next points of many searches, each from its trial table alone: a nation's customers stand for the trials of one."""
    key = F.col("c_custkey")
    table = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_nationkey").alias("study"), key.alias("key"), (key * 7919 % 1009 / 1009.0).alias("learning_rate"),
        (key * 104729 % 2003 / 2003.0).alias("num_leaves"), (key * 31 % 977).cast("double").alias("loss"), (key % 6 != 0).alias("finished"))
    ship(spark)

    def next_point(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        trials = [search.Trial(i, {n: getattr(r, n) for n in STUDY_NAMES}, r.loss, bool(r.finished)) for i, r in enumerate(rows.itertuples())]
        if len(trials) < search.STARTS:
            return pd.DataFrame({"study": [], "parameter": [], "proposal": []})
        point = search.propose(trials, len(trials), SETTINGS.seed, STUDY_NAMES)
        return pd.DataFrame({"study": rows["study"].iloc[0], "parameter": list(point), "proposal": list(point.values())})

    found = table.groupBy("study").applyInPandas(next_point, f"study {table.schema['study'].dataType.simpleString()}, parameter string, proposal double")
    return found.withColumn("proposal", F.round("proposal", 9))


@query("boost_attributions")
def boost_attributions(spark, sf):
    matrix = training_matrix(spark, sf)
    model = forest.train(matrix, MATRIX_INPUTS, "target", PUBLISHED)
    return forest.attributions(model, matrix, MATRIX_INPUTS)


@query("boost_attribution_totals", f"SELECT customer_id, {len(MATRIX_INPUTS)}::BIGINT AS n_features, true AS adds_up FROM features", ["features"])
def boost_attribution_totals(spark, sf):
    """Base and contributions of a customer add up to the prediction."""
    matrix = training_matrix(spark, sf)
    model = forest.train(matrix, MATRIX_INPUTS, "target", PUBLISHED)
    totals = forest.attributions(model, matrix, MATRIX_INPUTS).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_features"), (F.sum("contribution") + F.first("base_value")).alias("total"))
    scored = forest.predict(model, matrix, MATRIX_INPUTS).select("customer_id", "prediction")
    gap = F.abs(F.col("total") - F.col("prediction"))
    return totals.join(scored, "customer_id").select(
        "customer_id", "n_features", (gap <= F.abs("prediction") * 1e-9 + 1e-6).alias("adds_up"))


@query("boost_split_importance")
def boost_split_importance(spark, sf):
    matrix = training_matrix(spark, sf)
    return forest.split_importance(forest.train(matrix, MATRIX_INPUTS, "target", PUBLISHED), MATRIX_INPUTS)


@query("stack_out_of_fold")
def stack_out_of_fold(spark, sf):
    return forest.out_of_fold(training_matrix(spark, sf), MATRIX_INPUTS, "target", PUBLISHED, SETTINGS.folds)


FOLD_SQL = f"CAST({HASH.format(salt='fold', key='customer_id')} % 5 AS INTEGER)"


@query("stack_out_of_fold_rows", f"""
 SELECT customer_id, {FOLD_SQL} AS fold,
   coalesce(holdout_revenue, 0.0::DOUBLE) AS target, 1::BIGINT AS predictions
 FROM features LEFT JOIN actuals USING (customer_id)""", ["features", "actuals"])
def stack_out_of_fold_rows(spark, sf):
    """Every customer is predicted once, beside the own target."""
    table = forest.out_of_fold(training_matrix(spark, sf), MATRIX_INPUTS, "target", PUBLISHED, SETTINGS.folds)
    return table.groupBy("customer_id", fold_id("customer_id", SETTINGS.folds).alias("fold"), "target").agg(
        F.count("oof").alias("predictions"))


@query("stack_out_of_fold_means", f"""
 WITH y AS (SELECT customer_id, {FOLD_SQL} AS fold, coalesce(holdout_revenue, 0.0::DOUBLE) AS target FROM features LEFT JOIN actuals USING (customer_id)),
 f AS (SELECT fold, sum(target) AS s, count(*) AS n FROM y GROUP BY 1)
 SELECT customer_id, target, round(((SELECT sum(s) FROM f) - s) / ((SELECT sum(n) FROM f) - n), 2) AS oof FROM y JOIN f USING (fold)""", ["features", "actuals"])
def stack_out_of_fold_means(spark, sf):
    """Models without trees: everybody gets the mean of the folds that are not their own."""
    bare = boosting.BoostParams(n_estimators=0)
    table = forest.out_of_fold(training_matrix(spark, sf), MATRIX_INPUTS, "target", bare, SETTINGS.folds)
    return table.withColumn("oof", F.round("oof", 2))


@query("store_models_reloaded", """
 SELECT customer_id, round((intercept + bgf * p2 + gbt * p) / 1000, 0) AS stacked_thousands, round(2 * half_width, 2) AS interval_width,
   n_calibration FROM pairs, ridge, half""", ["pairs", "ridge", "half"])
def store_models_reloaded(spark, sf):
    """Stack and interval model fitted, stored, loaded and applied."""
    store, table = TableStore(spark, f"{checkpoint_folder(spark)}/store-{uuid4().hex}"), stack_pairs(spark, sf)
    store.write_params("model_stack", stacking.fit(table, "y", "p2", "p"))
    store.write_params("model_intervals", conformal.calibrate(
        table.where(conformal_part("customer_id") == "calibration"), "y", "p", SETTINGS.conformal_alpha))
    stack, half = store.read_params("model_stack", stacking.StackModel), store.read_params("model_intervals", conformal.IntervalModel)
    scored = table.select("customer_id", stacking.stacked(stack, F.col("p2"), F.col("p")).alias("p"))
    return conformal.with_intervals(scored, half, "p").select(
        "customer_id", F.round(F.col("p") / 1000, 0).alias("stacked_thousands"), F.round("interval_width", 2).alias("interval_width"),
        F.lit(half.n_calibration).cast("bigint").alias("n_calibration"))


@query("uplift_t_learner")
def uplift_t_learner(spark, sf):
    matrix = materialise(uplift.assign_arms(training_matrix(spark, sf)))
    models = uplift.fit_t_learner(matrix, MATRIX_INPUTS, "target")
    return uplift.predict_uplift(models, matrix, MATRIX_INPUTS).select("customer_id", "uplift_score")


@query("uplift_difference_of_arms", "SELECT customer_id, true AS equals_difference FROM features", ["features"])
def uplift_difference_of_arms(spark, sf):
    """The score is the treated prediction less the control prediction, each made on its own."""
    matrix = materialise(uplift.assign_arms(training_matrix(spark, sf)))
    models = uplift.fit_t_learner(matrix, MATRIX_INPUTS, "target")
    scored = uplift.predict_uplift(models, matrix, MATRIX_INPUTS).select("customer_id", "uplift_score")
    for name, model in zip(("treated", "control"), models):
        scored = scored.join(forest.predict(model, matrix, MATRIX_INPUTS, name).select("customer_id", name), "customer_id")
    return scored.select("customer_id", (F.col("uplift_score") == F.col("treated") - F.col("control")).alias("equals_difference"))


@query("interval_fitted_model")
def interval_fitted_model(spark, sf):
    """Fit on the training part, calibrate on the next, report coverage on the last."""
    matrix = materialise(training_matrix(spark, sf).withColumn("part", conformal_part("customer_id")))
    model = forest.train(matrix.where(F.col("part") == "train"), MATRIX_INPUTS, "target", boosting.INTERVAL_BASE)
    scored = forest.predict(model, matrix.where(F.col("part") != "train"), MATRIX_INPUTS, "p")
    half = conformal.calibrate(scored.where(F.col("part") == "calibration"), "target", "p", SETTINGS.conformal_alpha)
    return conformal.evaluate_coverage(conformal.with_intervals(scored.where(F.col("part") == "test"), half, "p"), "target")
