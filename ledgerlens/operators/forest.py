"""Boosted regression trees grown leaf by leaf over histograms, with exact attributions.

A model is fitted on all labelled rows, each fit in a task of its own: the folds of an out-of-fold table
and the trials of a search run side by side.  Borders of bins are found and rows encoded on the executors;
a task then holds a byte per row and input, and some tens of bytes a row while it fits.  Prediction, attribution
and out-of-fold scores are passes over the customers' rows.  Trees carry the published penalties and leaf
limits; ``operators.boosting`` trains Spark's own boosted trees instead, level by level and without them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.splits import fold_id
from ledgerlens.operators.boosting import BoostParams
from ledgerlens.operators.quantiles import melt, place_counts, value_counts
from ledgerlens.operators.ranking import unfold
from ledgerlens.operators.stability import landed, materialise, ship

MAX_BINS = 255  # a code fits a byte
PACKED_ROWS = 10_000  # rows of the sample that travel as one
_TREES = ("job int, tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
          "value array<double>, cover array<double>, gain array<double>, base double, score double")
_PARTS = ("feature", "threshold", "left", "right", "value", "cover", "gain")  # as Forest holds them


@dataclass(frozen=True)
class Sample:
    """Binned inputs (a byte each, column by column), the upper edges of the bins but the last, targets and folds."""

    inputs: tuple[str, ...]
    codes: np.ndarray
    edges: list[np.ndarray]
    target: np.ndarray
    fold: np.ndarray


@dataclass(frozen=True)
class Forest:
    """Trees one after another in flat arrays; ``feature`` −1 marks a leaf, left and right point into the arrays."""

    inputs: tuple[str, ...]
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @property
    def getNumTrees(self) -> int:  # noqa: N802  (the name Spark's own tree models use)
        return len(self.roots)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node, and one (tree −1) for what all trees start from: the form in which a model is stored."""
        ends = [*self.roots[1:].tolist(), len(self.feature)]
        rows = [(-1, 0, None, None, None, None, self.base, 0.0, 0.0)]
        for tree, (begin, end) in enumerate(zip(self.roots.tolist(), ends)):
            for i in range(begin, end):
                leaf = self.feature[i] < 0
                rows.append((tree, i - begin, None if leaf else self.inputs[self.feature[i]], None if leaf else float(self.threshold[i]),
                             None if leaf else int(self.left[i]) - begin, None if leaf else int(self.right[i]) - begin,
                             float(self.value[i]), float(self.cover[i]), float(self.gain[i])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, left int, right int, value double, "
                                           "cover double, gain double")


def from_table(table: DataFrame, inputs: Sequence[str]) -> Forest:
    """The model of a node table; its size is bounded by trees times leaves."""
    place = {name: i for i, name in enumerate(inputs)}
    rows = sorted(table.collect(), key=lambda r: (r["tree"], r["node"]))
    nodes, base = [r for r in rows if r["tree"] >= 0], next(r["value"] for r in rows if r["tree"] < 0)
    starts = {}
    for i, r in enumerate(nodes):
        starts.setdefault(r["tree"], i)
    begin = [starts[r["tree"]] for r in nodes]
    return Forest(
        tuple(inputs), float(base), np.array(sorted(starts.values()), np.int64),
        np.array([-1 if r["feature"] is None else place[r["feature"]] for r in nodes], np.int64),
        np.array([r["threshold"] or 0.0 for r in nodes], float),
        np.array([0 if r["left"] is None else r["left"] + b for r, b in zip(nodes, begin)], np.int64),
        np.array([0 if r["right"] is None else r["right"] + b for r, b in zip(nodes, begin)], np.int64),
        *(np.array([r[c] for r in nodes], float) for c in ("value", "cover", "gain")))


def from_nested(inputs: Sequence[str], base: float, trees: Sequence) -> Forest:
    """A model written down by hand: a leaf is (value, cover), an inner node (input, threshold, left, right)."""
    flat: dict[str, list] = {p: [] for p in _PARTS}
    roots = []

    def put(node) -> tuple[int, float]:
        at = len(flat["feature"])
        for name in _PARTS:
            flat[name].append(0.0)
        if len(node) == 2:
            flat["feature"][at], flat["value"][at], flat["cover"][at] = -1, *node
        else:
            flat["feature"][at], flat["threshold"][at] = list(inputs).index(node[0]), node[1]
            (flat["left"][at], a), (flat["right"][at], b) = put(node[2]), put(node[3])
            flat["cover"][at] = a + b
        return at, flat["cover"][at]

    for tree in trees:
        roots.append(put(tree)[0])
    kind = lambda name: np.int64 if name in ("feature", "left", "right") else float
    return Forest(tuple(inputs), float(base), np.array(roots, np.int64), *(np.array(flat[n], kind(n)) for n in _PARTS))


# --- fitting: array arithmetic over the rows --------------------------------------------------

def bin_edges(values: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Borders between neighbouring values; with more distinct values than bins, those nearest to equal shares."""
    ordered = np.sort(values)
    distinct = np.unique(ordered)
    if len(distinct) > bins:
        distinct = np.unique(ordered[(np.arange(bins) * (len(ordered) - 1)) // (bins - 1)])
    return (distinct[:-1] + distinct[1:]) / 2


def _worth(gradient: np.ndarray, rows: np.ndarray, params: BoostParams) -> np.ndarray:
    """Twice the loss that the best value of a leaf takes away, under the L1 and L2 penalties."""
    out = np.abs(gradient)
    out -= params.reg_alpha
    np.maximum(out, 0.0, out=out)
    out *= out
    weight = rows + params.reg_lambda
    out /= np.maximum(weight, 1e-300, out=weight)
    return out


def _best_split(histogram: np.ndarray, params: BoostParams) -> tuple[float, int, int]:
    """(gain, feature, bin) from the counts and sums per bin; (0, …) if no split leaves enough rows on both sides."""
    upto = histogram.cumsum(axis=-1)
    whole, bins = upto[:, 0, -1:], upto.shape[-1] - 1
    upto = upto[:, :, :-1].reshape(2, -1)
    least = params.min_child_samples
    places = np.flatnonzero((upto[0] >= least) & (upto[0] <= whole[0, 0] - least))
    if not len(places):
        return 0.0, 0, 0
    left = upto.take(places, axis=1)
    sides = np.stack([left, whole - left])
    worth = _worth(sides[:, 1], sides[:, 0], params)
    gain = worth[0]
    gain += worth[1]
    n, total = whole[:, 0]
    gain -= np.maximum(np.abs(total) - params.reg_alpha, 0.0) ** 2 / np.maximum(n + params.reg_lambda, 1e-300)
    at = int(gain.argmax())
    return (float(gain[at]), *divmod(int(places[at]), bins))


def _grow(codes: np.ndarray, gradient: np.ndarray, rows: np.ndarray, chosen: np.ndarray, width: int, params: BoostParams,
          ) -> tuple[dict[str, list], np.ndarray]:
    """One tree, always the leaf with the largest gain split next, and the leaf values that ``rows`` reach.

    Leaves that cannot be split (too few rows, depth, the last leaves) get no histogram.  Inner nodes give up their rows.
    """
    tree: dict[str, list] = {name: [] for name in _PARTS}
    columns, slopes = [codes[:, f].take(rows) for f in chosen], gradient[rows]
    members: list[np.ndarray | None] = []

    def histogram(some: np.ndarray) -> np.ndarray:
        out, weights = np.empty((2, len(columns), width)), slopes[some]
        for i, column in enumerate(columns):
            bins = column[some].astype(np.intp)
            out[0, i], out[1, i] = np.bincount(bins, minlength=width), np.bincount(bins, weights, width)
        return out

    def may_split(some: np.ndarray, depth: int) -> bool:
        return len(some) >= max(2, 2 * params.min_child_samples) and (params.max_depth < 0 or depth < params.max_depth)

    def add(some: np.ndarray, counted: np.ndarray | None, depth: int) -> None:
        total, at = float(slopes[some].sum()), len(members)
        members.append(some)
        value = -math.copysign(max(abs(total) - params.reg_alpha, 0.0), total) / max(len(some) + params.reg_lambda, 1e-300)
        for name, one in zip(_PARTS, (-1, 0.0, 0, 0, value * params.learning_rate, float(len(some)), 0.0)):
            tree[name].append(one)
        if counted is not None:
            gain, feature, cut = _best_split(counted, params)
            if gain > 1e-12:
                heapq.heappush(waiting, (-gain, at, feature, cut, counted, depth))

    waiting: list[tuple] = []
    everything, leaves = np.arange(len(rows)), 1
    add(everything, histogram(everything) if params.num_leaves > 1 and may_split(everything, 0) else None, 0)
    while waiting and leaves < params.num_leaves:
        gain, at, feature, cut, counted, depth = heapq.heappop(waiting)
        leaves += 1
        some, members[at] = members[at], None
        goes_left = columns[feature][some] <= cut
        sides = [some[goes_left], some[~goes_left]]
        small = int(len(sides[1]) < len(sides[0]))
        found: dict[int, np.ndarray] = {}
        if leaves < params.num_leaves and may_split(sides[1 - small], depth + 1):
            first = histogram(sides[small])
            found[1 - small] = counted - first
            if may_split(sides[small], depth + 1):
                found[small] = first
        tree["feature"][at], tree["threshold"][at], tree["gain"][at] = int(chosen[feature]), float(cut), -gain
        for side, name in enumerate(("left", "right")):
            tree[name][at] = len(members)
            add(sides[side], found.get(side), depth + 1)
    reached = np.empty(len(rows))
    for feature, value, some in zip(tree["feature"], tree["value"], members):
        if feature < 0:
            reached[some] = value
    return tree, reached


def _add_reached(out: np.ndarray, codes: np.ndarray, tree: dict[str, list], rows: np.ndarray) -> None:
    """Add to ``out`` the leaf values of the binned rows of these numbers."""
    waiting = [(0, rows)]
    while waiting:
        node, some = waiting.pop()
        feature = tree["feature"][node]
        if feature < 0:
            out[some] += tree["value"][node]
            continue
        goes_left = codes[:, feature][some] <= tree["threshold"][node]
        waiting += [(tree["left"][node], some[goes_left]), (tree["right"][node], some[~goes_left])]


def _reach(codes: np.ndarray, tree: dict[str, list]) -> np.ndarray:
    """Leaf values of binned rows."""
    out = np.zeros(len(codes))
    _add_reached(out, codes, tree, np.arange(len(codes)))
    return out


def _chosen_rows(codes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Rows of a table that lies in memory column by column, and stays so."""
    out = np.empty((int(some.sum()), codes.shape[1]), codes.dtype, order="F")
    for i in range(codes.shape[1]):
        out[:, i] = codes[some, i]
    return out


def fit_sample(codes: np.ndarray, target: np.ndarray, params: BoostParams) -> tuple[float, list[dict[str, list]]]:
    """(mean target, trees); thresholds are bin numbers.  Rows and inputs of a tree follow from seed and tree number."""
    n, inputs = codes.shape
    base = float(target.mean()) if n else 0.0
    prediction, trees = np.full(n, base), []
    width = int(codes.max(initial=0)) + 1
    for t in range(params.n_estimators if n else 0):
        draw, drawn = np.random.default_rng((params.seed, t)), np.ones(n, bool)
        if params.subsample < 1:
            drawn[draw.permutation(n)[max(1, math.ceil(params.subsample * n)):]] = False
        wanted = max(1, round(params.colsample * inputs))
        chosen = np.arange(inputs) if wanted >= inputs else np.sort(draw.permutation(inputs)[:wanted])
        tree, reached = _grow(codes, prediction - target, np.flatnonzero(drawn), chosen, width, params)
        prediction[drawn] += reached
        if not drawn.all():
            _add_reached(prediction, codes, tree, np.flatnonzero(~drawn))
        trees.append(tree)
    return base, trees


def borders(rows: DataFrame, columns: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """:func:`bin_edges` of each column over all rows: counted values are placed in order, and only those that borders lie between are read."""
    found: dict[str, list[float]] = {c: [] for c in columns}
    if columns:
        placement = place_counts(value_counts(melt(rows, columns), "value", by=["column"]), by=["column"])
        whole = Window.partitionBy("column")
        slots = placement.slots.withColumns({"_total": F.sum("_in_n").over(whole), "_distinct": F.sum("_in_rows").over(whole)})
        last = F.greatest(F.col("_total") - 1, F.lit(1)).alias("_last")
        values = unfold(placement, slots, ["_total", "_distinct"]).select("column", "value", "_distinct", (F.col("cum_n") - F.col("n")).alias("before"), "cum_n", last)
        # Wanted are the positions i·last // (bins − 1); so many of them lie before position p:
        wanted = lambda p: F.least(F.expr(f"({p} * {bins - 1} + _last - 1) div _last"), F.lit(bins))
        for r in values.where((F.col("_distinct") <= bins) | (wanted("cum_n") > wanted("before"))).select("column", "value").collect():  # at most bins a column
            found[r["column"]].append(r["value"])
    return [bin_edges(np.array(found[c], float), bins) for c in columns]


def draw_sample(df: DataFrame, inputs: Sequence[str], label: str, fit_rows: int | None = None, folds: int = 5, key: str = "customer_id") -> Sample:
    """All labelled rows, ordered by the hashes of their keys, or the first ``fit_rows``; null inputs count as NaN, which lies in the last bin."""
    names = [f"x{i}" for i in range(len(inputs))]
    rows = df.where(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double").alias(x) for c, x in zip(inputs, names)], F.col(label).cast("double").alias("y"),
        F.coalesce(fold_id(key, folds), F.lit(-1)).alias("f"), F.xxhash64(F.col(key)).alias("h"), F.col(key).alias("k"))
    rows = landed(rows if fit_rows is None else rows.orderBy("h", "k").limit(fit_rows))
    edges = borders(rows, names)
    ship(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, PACKED_ROWS) for at in range(0, whole.num_rows, PACKED_ROWS)):
                x = _matrix(batch, len(names)) if names else np.zeros((batch.num_rows, 0))
                codes = [np.searchsorted(e, x[:, i], side="left").astype(np.uint8).tobytes() for i, e in enumerate(edges)]
                target, fold = (batch.column(len(names) + i).to_numpy(zero_copy_only=False) for i in range(2))
                yield pa.RecordBatch.from_arrays([pa.array([one], pa.binary()) for one in (
                    b"".join(codes), target.astype(float).tobytes(), fold.astype(np.int32).tobytes())], ["codes", "target", "fold"])

    packed = rows.orderBy("h", "k").select(*names, "y", "f").mapInArrow(work, "codes binary, target binary, fold binary").toArrow()  # 12 bytes a row, and one per input
    pieces = lambda name, kind: [np.frombuffer(one.as_buffer(), kind) for one in packed.column(name)]
    target, fold = (np.concatenate([np.zeros(0, kind), *pieces(name, kind)]) for name, kind in (("target", float), ("fold", np.int32)))
    codes, at = np.empty((len(target), len(names)), np.uint8, order="F"), 0
    for piece in pieces("codes", np.uint8) if names else []:
        part = piece.reshape(len(names), -1).T
        codes[at:at + len(part)] = part
        at += len(part)
    return Sample(tuple(inputs), codes, edges, target, fold)


def _as_forest(sample: Sample, base: float, trees: Sequence[dict]) -> Forest:
    sizes = [len(t["feature"]) for t in trees]
    roots = np.cumsum([0, *sizes[:-1]]).astype(np.int64) if trees else np.zeros(0, np.int64)
    join = lambda name, kind: np.concatenate([np.array(t[name], kind) for t in trees]) if trees else np.zeros(0, kind)
    offset = np.repeat(roots, sizes) if trees else np.zeros(0, np.int64)
    feature, cut = join("feature", np.int64), join("threshold", float)
    threshold = np.array([sample.edges[f][int(c)] if f >= 0 else 0.0 for f, c in zip(feature, cut)], float)
    return Forest(sample.inputs, base, roots, feature, threshold, join("left", np.int64) + offset, join("right", np.int64) + offset,
                  join("value", float), join("cover", float), join("gain", float))


def fit_side_by_side(spark: SparkSession, sample: Sample, jobs: Sequence[tuple[BoostParams, int | None]],
                     keep_trees: bool = True) -> list[tuple[Forest | None, float | None]]:
    """One task per (parameters, fold left out or None): the model, and the mean absolute error on the fold left out.

    Tasks start in the order of their expected time, longest first, so that none is left to run alone at the end.
    """
    if not jobs:
        return []
    order = sorted(range(len(jobs)), key=lambda i: -jobs[i][0].n_estimators * jobs[i][0].num_leaves)
    ship(spark)
    shared = spark.sparkContext.broadcast((sample.codes, sample.target, sample.fold))
    names = [f.split(" ")[0] for f in _TREES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, target, fold = shared.value
        for batch in batches:
            for number in (order[i] for i in batch.column(0).to_pylist()):
                params, left_out = jobs[number]
                known = np.ones(len(target), bool) if left_out is None else fold != left_out
                base, trees = fit_sample(codes if known.all() else _chosen_rows(codes, known), target[known], params)
                score = None
                if left_out is not None and not known.all():
                    held, unseen = np.full(len(target), base), np.flatnonzero(~known)
                    for tree in trees:
                        _add_reached(held, codes, tree, unseen)
                    score = float(np.abs(held[unseen] - target[unseen]).mean())
                rows = [[number, t, *(tree[p] for p in _PARTS), base, score] for t, tree in enumerate(trees if keep_trees else [])]
                rows.append([number, -1, *[[]] * len(_PARTS), base, score])
                kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), *[pa.list_(pa.int32())] * 2,
                         *[pa.list_(pa.float64())] * 3, pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    numbers = spark.range(0, len(jobs), 1, len(jobs))  # one partition per job
    found: dict[int, list] = {}
    for row in numbers.mapInArrow(work, _TREES).collect():  # bounded: jobs × trees × leaves
        found.setdefault(row["job"], []).append(row)
    out = []
    for number in range(len(jobs)):
        rows = sorted(found[number], key=lambda r: r["tree"])
        trees = [{p: r[p] for p in _PARTS} for r in rows[1:]]
        out.append((_as_forest(sample, rows[0]["base"], trees) if keep_trees else None, rows[0]["score"]))
    return out


def train(df: DataFrame, inputs: Sequence[str], label: str, params: BoostParams = BoostParams(), fit_rows: int | None = None,
          key: str = "customer_id") -> Forest:
    """A model of ``label``, fitted in one task on all labelled rows, or on ``fit_rows`` of them."""
    return fit_side_by_side(df.sparkSession, draw_sample(df, inputs, label, fit_rows, key=key), [(params, None)])[0][0]


# --- passes over all rows ----------------------------------------------------------------------

def scores(model: Forest, x: np.ndarray) -> np.ndarray:
    """Predictions of rows of raw inputs."""
    out = np.full(len(x), model.base)
    step = max(1, (1 << 18) // max(1, len(model.roots)))
    for at in range(0, len(x) if len(model.roots) else 0, step):
        part = x[at:at + step]
        rows, node = np.arange(len(part))[:, None], np.tile(model.roots, (len(part), 1))
        while True:
            feature = model.feature[node]
            inner = feature >= 0
            if not inner.any():
                break
            left = part[rows, np.maximum(feature, 0)] <= model.threshold[node]
            node = np.where(inner, np.where(left, model.left[node], model.right[node]), node)
        out[at:at + step] += model.value[node].sum(axis=1)
    return out


def _matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(columns)], axis=1)


def predict(model: Forest | Sequence[Forest], df: DataFrame, inputs: Sequence[str], alias: str = "prediction", which: str | None = None) -> DataFrame:
    """``df`` plus predictions.  With several models, ``which`` names the column that says which one scores a row."""
    models = [model] if isinstance(model, Forest) else list(model)
    for one in models:
        if tuple(inputs) != one.inputs:
            raise ValueError(f"the model was fitted on {one.inputs}")
    ship(df.sparkSession)
    shared, n = df.sparkSession.sparkContext.broadcast(models), len(inputs)

    @F.pandas_udf("double")
    def scored(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for piece in pieces:
            x = piece.iloc[:, :n].to_numpy(dtype=float, na_value=np.nan)
            if which is None:
                yield pd.Series(scores(shared.value[0], x))
                continue
            number, out = piece.iloc[:, n].to_numpy(), np.empty(len(x))
            for i in np.unique(number):
                out[number == i] = scores(shared.value[i], x[number == i])
            yield pd.Series(out)

    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)]
    return df.withColumn(alias, scored(F.struct(*columns, *([F.col(which).alias("which")] if which else []))))


def out_of_fold(df: DataFrame, inputs: Sequence[str], label: str, params: BoostParams, folds: int = 5, key: str = "customer_id",
                fit_rows: int | None = None) -> DataFrame:
    """(key, label, oof): every customer predicted by the one of ``folds`` models that has not seen their fold."""
    rows = materialise(df.select(key, *inputs, F.col(label).cast("double").alias(label)).withColumn("_fold", fold_id(key, folds)))
    sample = draw_sample(rows, inputs, label, fit_rows, folds, key)
    models = [m for m, _ in fit_side_by_side(df.sparkSession, sample, [(params, i) for i in range(folds)])]
    return predict(models, rows, inputs, "oof", "_fold").select(key, label, "oof")


@dataclass(frozen=True)
class Paths:
    """Leaves with equally many inputs on their way: per input the interval (lower, upper] it must lie in and the share of training rows kept."""

    feature: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_paths(model: Forest) -> list[tuple[int, int, float, dict[int, tuple[float, float, float]]]]:
    """(tree, leaf, value, input → (lower, upper, share)) of all leaves; repeated splits on an input are one interval."""
    out = []
    for tree, root in enumerate(model.roots.tolist()):
        stack = [(root, {})]
        while stack:
            node, path = stack.pop()
            f = int(model.feature[node])
            if f < 0:
                out.append((tree, node - root, float(model.value[node]), path))
                continue
            low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
            cut, whole = float(model.threshold[node]), float(model.cover[node])
            for child, bounds in ((int(model.left[node]), (low, min(high, cut))), (int(model.right[node]), (max(low, cut), high))):
                stack.append((child, {**path, f: (*bounds, share * float(model.cover[child]) / whole)}))
    return out


def path_table(model: Forest, spark: SparkSession) -> DataFrame:
    """(tree, leaf, value, feature, lower, upper, share): the paths as a table, one row per leaf and input."""
    rows = [(t, leaf, value, model.inputs[f], *one) for t, leaf, value, path in leaf_paths(model) for f, one in sorted(path.items())]
    return spark.createDataFrame(rows, "tree int, leaf int, value double, feature string, lower double, upper double, share double")


def _grouped(model: Forest) -> list[Paths]:
    groups: dict[int, list] = {}
    for _, _, value, path in leaf_paths(model):
        groups.setdefault(len(path), []).append((value, sorted(path.items())))
    out = []
    for size, leaves in groups.items():
        if size:
            take = lambda i: np.array([[p[1][i] for p in path] for _, path in leaves])
            out.append(Paths(np.array([[p[0] for p in path] for _, path in leaves]), take(0), take(1), take(2), np.array([v for v, _ in leaves])))
    return out


def expected_value(model: Forest) -> float:
    """The prediction without any input: leaves by their share of training rows."""
    return model.base + sum(value * math.prod(s for _, _, s in path.values()) for _, _, value, path in leaf_paths(model))


TABLE_INPUTS = 8  # longest paths whose payments are tabulated: 2**8 answers a leaf
LEAVES_AT_ONCE, CELLS_AT_ONCE = 512, 1 << 14  # so that a step's numbers stay in the cache


def _payments(group: Paths, met: np.ndarray) -> np.ndarray:
    """What leaves pay to the inputs on their paths, given which of them are ``met``: the last two axes are leaves and inputs of ``group``.

    A leaf pays input j its value times (met_j − share_j) times the mean, over orders in which inputs
    become known, of the product of met_k for those known before and share_k for the others.  That mean is
    ∫ Π_{k≠j} (met_k·u + share_k·(1−u)) du over 0..1, a polynomial that a few Gauss nodes integrate exactly.
    """
    nodes, weights = np.polynomial.legendre.leggauss(max(1, (group.feature.shape[1] + 1) // 2))
    met, total = met.astype(float), np.zeros(met.shape)
    for u, w in zip((nodes + 1) / 2, weights / 2):
        factor = met * u + group.share * (1 - u)
        total += w * factor.prod(axis=-1, keepdims=True) / factor
    return (met - group.share) * total * group.value[:, None]


def _met(group: Paths, values: np.ndarray) -> np.ndarray:
    """Whether ``values`` of the inputs on the leaves' paths lie in their intervals."""
    inside = ((values > group.lower) | ((group.lower == -np.inf) & (values == -np.inf))) & (values <= group.upper)
    return inside | (np.isnan(values) & (group.upper == np.inf))  # NaN lies above every border


def _tabulated(group: Paths, x: np.ndarray, inputs: int) -> np.ndarray:
    """Attributions of leaves whose paths have few inputs: each pays one of 2**inputs sums, looked up per row.

    An input's value matters to a leaf only as inside or outside; a row's bits of a leaf are added up from one row of
    bits per input, found by the interval that its value lies in.
    """
    leaves, size = group.feature.shape
    bits = np.left_shift(1, np.arange(size))
    patterns = (np.arange(1 << size)[:, None] & bits) > 0  # pattern × input on the path
    paid = np.zeros((leaves, 1 << size, inputs))
    answers = _payments(group, np.broadcast_to(patterns[:, None], (1 << size, leaves, size)))  # pattern, leaf, input on the path
    paid[np.arange(leaves)[:, None, None], np.arange(1 << size)[None, :, None], group.feature[:, None]] = answers.transpose(1, 0, 2)
    paid = paid.reshape(-1, inputs)
    start = np.arange(leaves) << size
    out = np.zeros((len(x), inputs))
    lookups = []
    for j in range(inputs):
        leaf, at = np.nonzero(group.feature == j)
        if len(leaf):
            lower, upper = group.lower[leaf, at], group.upper[leaf, at]
            borders = np.unique(np.concatenate([lower, upper]))
            borders = borders[np.isfinite(borders)]
            first = np.where(lower == -np.inf, 0, np.searchsorted(borders, lower) + 1)
            last = np.where(upper == np.inf, len(borders), np.searchsorted(borders, upper))
            interval = np.arange(len(borders) + 1)[:, None]
            agrees = np.zeros((len(borders) + 1, leaves), np.int64)
            agrees[:, leaf] = ((interval >= first) & (interval <= last)) * bits[at]
            lookups.append((agrees, np.searchsorted(borders, x[:, j], side="left")))  # NaN sorts behind every border
    step, each = max(1, CELLS_AT_ONCE // leaves), np.ones(leaves)
    for at in range(0, len(x), step):
        code = np.broadcast_to(start, (len(x[at:at + step]), leaves)).copy()
        for agrees, interval in lookups:
            code += agrees.take(interval[at:at + step], axis=0)
        out[at:at + step] = each @ paid.take(code, axis=0)
    return out


def shapley(groups: Sequence[Paths], x: np.ndarray, inputs: int) -> np.ndarray:
    """Exact attributions, rows × inputs: what each leaf pays (see :func:`_payments`), summed over the leaves."""
    out = np.zeros((len(x), inputs))
    for group in groups:
        leaves, size = group.feature.shape
        if size <= TABLE_INPUTS:
            for begin in range(0, leaves, LEAVES_AT_ONCE):
                some = slice(begin, begin + LEAVES_AT_ONCE)
                out += _tabulated(Paths(group.feature[some], group.lower[some], group.upper[some], group.share[some], group.value[some]), x, inputs)
            continue
        flat = group.feature.ravel()
        order = np.argsort(flat, kind="stable")
        owners, begins = np.unique(flat[order], return_index=True)
        step = max(1, (1 << 20) // (leaves * size))
        for at in range(0, len(x), step):
            met = _met(group, x[at:at + step][:, group.feature])
            paid = _payments(group, met).reshape(len(met), -1)
            out[at:at + step, owners] += np.add.reduceat(paid[:, order], begins, axis=1)
    return out


def attributions(model: Forest, df: DataFrame, inputs: Sequence[str], key: str = "customer_id") -> DataFrame:
    """(key, feature, contribution, base_value): exact path-dependent Shapley values; base and contributions add up to the prediction."""
    if tuple(inputs) != model.inputs:
        raise ValueError(f"the model was fitted on {model.inputs}")
    ship(df.sparkSession)
    base, names, n = expected_value(model), list(inputs), len(inputs)
    shared = df.sparkSession.sparkContext.broadcast(_grouped(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paid = shapley(shared.value, _matrix(batch.select(list(range(1, n + 1))), n), n)
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), n)))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(names * batch.num_rows, pa.string()), pa.array(paid.ravel()), pa.array(np.full(batch.num_rows * n, base))],
                [key, "feature", "contribution", "base_value"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(inputs)]).mapInArrow(
        work, f"`{key}` {kind}, feature string, contribution double, base_value double")


def split_importance(model: Forest, inputs: Sequence[str]) -> DataFrame:
    """(feature, importance): each input's share of the gain of all splits; one row per input."""
    total = np.bincount(model.feature[model.feature >= 0], model.gain[model.feature >= 0], len(inputs))
    shares = total / total.sum() if total.sum() > 0 else total
    return SparkSession.active().createDataFrame(
        [(name, float(v)) for name, v in zip(inputs, shares)], "feature string, importance double")
