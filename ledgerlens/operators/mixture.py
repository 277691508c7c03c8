"""Gaussian mixtures from several starts at once: every pass over the rows advances all of them.

Starts, steps and the rule to stop are those of Spark's ``GaussianMixture``, and so is the model that
comes out; a fit after the other would pass over the rows once for every round of every start.  Rows lie
packed in arrays on the executors; a task adds up the moments of its rows under all components of
all starts by matrix products, and one row of sums per task comes back.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame

from ledgerlens.operators.stability import ship

EPSILON = sys.float_info.epsilon  # what Spark adds to each density, and to which it compares eigenvalues
BLOCK = 1 << 17  # rows of a packed array
CHUNK = 2048  # rows worked on at once, so that their densities stay in the processor's cache
LEAST, MOST = 1 << 14, 1 << 22  # rows worth a task; rows of the largest task
DRAWS = 4  # starts drawn side by side


@dataclass(frozen=True)
class Fit:
    """Where one start stands.  ``log_likelihood`` is that of the parameters before the last round, as in Spark."""

    k: int
    seed: int
    weights: np.ndarray  # (k,)
    means: np.ndarray  # (k, d)
    covariances: np.ndarray  # (k, d, d)
    log_likelihood: float = -sys.float_info.max
    previous: float = 0.0
    rounds: int = 0

    def goes_on(self, max_rounds: int, tolerance: float) -> bool:
        return self.rounds < max_rounds and abs(self.log_likelihood - self.previous) > tolerance


def draw(rows: DataFrame, starts: Sequence[tuple[int, int]], features: str) -> list[Fit]:
    """The starting points that Spark draws from ``rows`` for pairs of (k, seed): its estimator without a round."""

    def one(start: tuple[int, int]) -> Fit:
        k, seed = start
        model = GaussianMixture(featuresCol=features, k=k, maxIter=0, seed=seed).fit(rows)
        shapes = model.gaussians  # k of them
        return Fit(k, seed, np.array(model.weights), np.array([g.mean.toArray() for g in shapes]), np.array([g.cov.toArray() for g in shapes]))

    if not starts:
        return []
    with ThreadPool(min(DRAWS, len(starts))) as pool:
        return pool.map(one, starts)


def packed(rows: DataFrame, features: str, n: int) -> RDD:
    """The vectors of the ``n`` rows, dealt evenly over the tasks, as persisted (d, n) arrays.

    A pass is short and there are hundreds of them: one task per core, or fewer where rows are few.
    """
    ship(rows.sparkSession)
    tasks = max(min(rows.sparkSession.sparkContext.defaultParallelism, n // LEAST + 1), n // MOST + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            column = batch.column(0)
            parts.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
            n += len(column)
            if n >= BLOCK:
                yield block(parts)
                parts, n = [], 0
        if n:
            yield block(parts)

    def block(parts: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.concatenate(parts)
        return pa.RecordBatch.from_arrays([pa.array([whole.shape[1]], pa.int32()), pa.array([whole.T.tobytes()])], ["d", "x"])

    plain = rows.select(vector_to_array(features).alias("x")).repartition(tasks)
    blocks = plain.mapInArrow(pack, "d int, x binary").rdd
    return blocks.map(lambda row: np.frombuffer(row["x"]).reshape(row["d"], -1)).persist(StorageLevel.MEMORY_AND_DISK)


def _densities(fits: Sequence[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all components, one below the other: axes (d, K, d) and offsets (d, K) that whiten a vector, log heights and weights.

    Directions in which a component has no extent take no part, as in Spark's pseudo-inverse.
    """
    means = np.concatenate([f.means for f in fits])
    values, vectors = np.linalg.eigh(np.concatenate([f.covariances for f in fits]))
    d = means.shape[1]
    kept = values > EPSILON * values.max(axis=1, keepdims=True) * d
    known = np.where(kept, values, 1.0)
    axes = np.where(kept, 1.0 / np.sqrt(known), 0.0)[:, :, None] * vectors.transpose(0, 2, 1)  # (K, axis, d)
    offsets = np.einsum("kad,kd->ak", axes, means)
    heights = -0.5 * (d * math.log(2.0 * math.pi) + np.log(known).sum(axis=1))
    return axes.transpose(1, 0, 2).copy(), offsets, heights, np.concatenate([f.weights for f in fits])


def _moments(blocks: Iterator[np.ndarray], axes: np.ndarray, offsets: np.ndarray, heights: np.ndarray, weights: np.ndarray,
             sizes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood per fit; per component the sums of responsibility, of x and of the products x_i x_j, i ≤ j."""
    d = len(axes)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    likelihoods, sums = np.zeros(len(sizes)), np.zeros((len(weights), 1 + d + len(pairs)))
    edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    spans = list(zip(edges, edges[1:]))
    for block in blocks:
        for begin in range(0, block.shape[1], CHUNK):
            x = np.ascontiguousarray(block[:, begin : begin + CHUNK])
            monomials = np.concatenate([np.ones((1, x.shape[1])), x, *[x[i : i + 1] * x[j : j + 1] for i, j in pairs]])
            square = np.zeros((len(weights), x.shape[1]))
            for axis, offset in zip(axes, offsets):
                along = axis @ x
                along -= offset[:, None]
                along *= along
                square += along
            square *= -0.5
            square += heights[:, None]
            share = np.exp(square, out=square)
            share *= weights[:, None]
            share += EPSILON
            for at, (a, b) in enumerate(spans):
                total = share[a:b].sum(axis=0)
                likelihoods[at] += np.log(total).sum()
                share[a:b] /= total
            sums += share @ monomials.T
    return likelihoods, sums


def _pass(blocks: RDD, fits: Sequence[Fit]) -> list[Fit]:
    """One round of every fit."""
    parameters, sizes = _densities(fits), [f.k for f in fits]
    found = blocks.mapPartitions(lambda part: [_moments(part, *parameters, sizes)]).collect()  # a few KB per task
    likelihoods, sums = sum(ll for ll, _ in found), sum(s for _, s in found)
    d = fits[0].means.shape[1]
    upper = np.triu_indices(d)
    out, at = [], 0
    for fit, ll in zip(fits, likelihoods):
        own = sums[at : at + fit.k]
        at += fit.k
        weight = own[:, 0]
        means = own[:, 1 : 1 + d] / weight[:, None]
        products = np.zeros((fit.k, d, d))
        products[:, upper[0], upper[1]] = products[:, upper[1], upper[0]] = own[:, 1 + d :]
        covariances = (products - weight[:, None, None] * means[:, :, None] * means[:, None, :]) / weight[:, None, None]
        out.append(Fit(fit.k, fit.seed, weight / weight.sum(), means, covariances, float(ll), fit.log_likelihood, fit.rounds + 1))
    return out


def advance(blocks: RDD, fits: Sequence[Fit], max_rounds: int, tolerance: float) -> list[Fit]:
    """The fits, each taken on until it stands still or has had ``max_rounds`` rounds in all."""
    fits = list(fits)
    while going := [i for i, fit in enumerate(fits) if fit.goes_on(max_rounds, tolerance)]:
        for i, fit in zip(going, _pass(blocks, [fits[i] for i in going])):
            fits[i] = fit
    return fits


def spark_model(fit: Fit, features: str, max_rounds: int, tolerance: float) -> GaussianMixtureModel:
    """The fit as Spark's model, made from its parts as in ``CountVectorizerModel.from_vocabulary``."""
    jvm, make = SparkContext._active_spark_context._gateway.jvm, JavaWrapper._new_java_obj
    shape = "org.apache.spark.ml.stat.distribution.MultivariateGaussian"
    shapes = [make(shape, Vectors.dense(m), DenseMatrix(len(m), len(m), c.T.ravel())) for m, c in zip(fit.means, fit.covariances)]
    weights = JavaWrapper._new_java_array(fit.weights.tolist(), jvm.double)
    made = make("org.apache.spark.ml.clustering.GaussianMixtureModel", GaussianMixture().uid, weights,
                JavaWrapper._new_java_array(shapes, jvm.org.apache.spark.ml.stat.distribution.MultivariateGaussian))
    model = GaussianMixtureModel(made)
    for name, value in (("featuresCol", features), ("k", fit.k), ("maxIter", max_rounds), ("tol", tolerance), ("seed", fit.seed)):
        model.set(model.getParam(name), value)
    return model
