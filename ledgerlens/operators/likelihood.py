"""Maximum likelihood over a DataFrame: the data stay on the executors, only sums come back.

Parameters are positive, so the search runs on their logarithms.  A round sends a handful of points out;
every task adds up log-likelihood, gradient and Hessian of its rows at all of them in array arithmetic,
and one row per point comes back.  With exact second derivatives the next points are Newton steps of
several lengths and dampings (a k×k system, k ≤ 4), so a handful of rounds suffice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.stability import ship

# (columns of the rows, parameters) → per row: log-likelihood, first derivatives (k, n), second derivatives (k, k, n).
RowModel = Callable[[dict[str, np.ndarray], np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
MAX_LOG_STEP = 8.0
MAX_LOG = 18.0  # beyond e^18 differences of ln Γ lose the digits that the search needs
FLAT = 1e-11  # a round that gains less, relative to the value, has only rounding left to gain


def evaluate(rows: DataFrame, model: RowModel, points: Sequence[Sequence[float]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Per point (the parameters themselves): mean log-likelihood, its gradient and its Hessian.

    ``rows`` holds double columns, among them ``weight``.  Non-finite sums of a point are handed back as they are.
    """
    ship(rows.sparkSession)
    points = [np.asarray(p, dtype=float) for p in points]
    k = len(points[0])
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    names = ["w", "ll", *[f"s{i}" for i in range(k)], *[f"h{i}_{j}" for i, j in pairs]]
    columns = rows.columns

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(points), len(names)))
        for batch in batches:
            data = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(columns)}
            weight = data["weight"]
            with np.errstate(all="ignore"):
                for at, point in enumerate(points):
                    ll, first, second = model(data, point)
                    total[at] += [weight.sum(), weight @ ll, *(first @ weight), *(weight @ second[i, j] for i, j in pairs)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(points)), pa.int32()), *[pa.array(c, pa.float64()) for c in total.T]], ["i", *names])

    added = rows.mapInArrow(sums, ", ".join(["i int", *[f"{n} double" for n in names]]))
    found = {row["i"]: row for row in added.groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect()}  # one row per point
    out = []
    for at in range(len(points)):
        row = found[at]
        total, hessian = float(row["w"]), np.zeros((k, k))
        for i, j in pairs:
            hessian[i, j] = hessian[j, i] = row[f"h{i}_{j}"] / total
        out.append((row["ll"] / total, np.array([row[f"s{i}"] for i in range(k)]) / total, hessian))
    return out


def by_logarithms(log_point: np.ndarray, parts) -> tuple[float, np.ndarray, np.ndarray]:
    """Value, gradient and Hessian by the logarithms of the parameters, from those by the parameters."""
    value, first, second = parts
    theta = np.exp(log_point)
    return value, theta * first, np.outer(theta, theta) * second + np.diag(theta * first)


def _steps(gradient: np.ndarray, hessian: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Newton steps of several dampings, and the gain the undamped one promises.  Directions of wrong curvature are turned uphill."""
    bends, axes = np.linalg.eigh(-hessian)
    bends = np.abs(bends)
    floor = max(bends.max(), 1e-12) * 1e-9
    along = axes.T @ gradient
    steps = [axes @ (along / np.maximum(bends + damping * bends.max(), floor)) for damping in (0.0, 1e-2, 1e-1, 1.0)]
    # Towards a maximum at the edge (a parameter that tends to 0) every Newton step has length 1 in the logarithm: try longer ones.
    return [steps[0], 0.3 * steps[0], 4 * steps[0], 16 * steps[0], *steps[1:]], float(along @ (along / np.maximum(bends, floor)))


def maximise(rows: DataFrame, model: RowModel, start: Sequence[float], penalizer: float,
             max_rounds: int = 200, tolerance: float = 1e-8) -> tuple[np.ndarray, float, bool]:
    """(parameters, penalised mean log-likelihood, whether the gain expected, or that of a round, became negligible).

    The penalty is ``penalizer · Σ θ²`` on the parameters themselves.
    """

    def penalised(log_point: np.ndarray, parts):
        value, first, second = by_logarithms(log_point, parts)
        square = np.exp(2 * log_point)
        return value - penalizer * square.sum(), first - 2 * penalizer * square, second - 4 * penalizer * np.diag(square)

    point = np.log(np.asarray(start, dtype=float))
    value, gradient, hessian = penalised(point, evaluate(rows, model, [np.exp(point)])[0])
    rounds, shrink, converged = 1, 1.0, False
    while True:
        # A parameter that has reached the border and would leave it takes no part.
        free = np.flatnonzero(~(((point >= MAX_LOG) & (gradient > 0)) | ((point <= -MAX_LOG) & (gradient < 0))))
        if not len(free):
            converged = True
            break
        inner, expected = _steps(gradient[free], hessian[np.ix_(free, free)])
        steps = [np.zeros(len(point)) for _ in inner]
        for whole, step in zip(steps, inner):
            whole[free] = step
        converged = expected < tolerance
        if converged or shrink < 1e-4 or rounds >= max_rounds:
            break
        steps = [shrink * s * min(1.0, MAX_LOG_STEP / max(np.abs(s).max(), 1e-300)) for s in steps]
        candidates = [np.clip(point + s, -MAX_LOG, MAX_LOG) for s in steps]
        results = [penalised(c, parts) for c, parts in zip(candidates, evaluate(rows, model, [np.exp(c) for c in candidates]))]
        rounds += 1
        usable = [i for i, (v, g, h) in enumerate(results) if np.isfinite(v) and np.isfinite(g).all() and np.isfinite(h).all()]
        best = max(usable, key=lambda i: results[i][0], default=None)
        if best is None or not results[best][0] > value:
            shrink /= 10
            continue
        shrink, converged = 1.0, bool(results[best][0] - value < FLAT * (1 + abs(value)))
        point, (value, gradient, hessian) = candidates[best], results[best]
        if converged:
            break
    return np.exp(point), float(value), converged
