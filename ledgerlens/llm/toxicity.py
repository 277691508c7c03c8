"""Toxicity grades by cumulative-link ordinal regression.

Grade 0 is not toxic.  Labels only say toxic or not; labelled toxic texts get the grades 1 to 3, by
terciles of the rate of words that toxic texts hold far more often than others.  These are words that
the model reads too, so the order among grades 1 to 3 says how dense such words are, no more.  One weight per word is shared by all grades;
ordered thresholds separate them: P(grade ≥ k) = 1/(1+exp(threshold_k − w·x)).  The sum of these
over k is the expected severity.  Features are the words of a bounded vocabulary and beginnings of
longer words, which catch inflected and compound forms; x holds log(1 + occurrences per 100 words).

The model is fitted on a bounded sample of labelled rows (``SAMPLE``, chosen by key hash); word
statistics of the sample, its sparse rows and the vocabulary are bounded by ``SAMPLE`` and ``VOCABULARY``.
Scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import plain_words, ship
from ledgerlens.operators.stability import materialise

SAMPLE = 8_000
VOCABULARY = 4_096
GRADES = 3  # above grade 0
LEAST = 3  # texts a word must stand in
CERTAIN = 16.0  # least log-likelihood ratio of a word's split between toxic and other texts; keeps chance words out
FAR_MORE = 8.0  # ratio of shares that makes a word a mark of toxic texts
PENALTY = 1e-4
BEGINNING = 5  # characters of a beginning; shorter words have none
ROUNDS = 400


def features(text: str | None) -> tuple[list[str], list[str]]:
    """Words and, marked by ``^``, beginnings of longer words."""
    words = [w.decode("utf-8", "replace") for w in plain_words(text)]
    return words, ["^" + w[:BEGINNING] for w in words if len(w) > BEGINNING]


def rates(text: str | None, known: dict[str, float]) -> list[tuple[str, float]]:
    """(feature, log(1 + occurrences per 100 words)) of the ``known`` features of a text."""
    words, beginnings = features(text)
    counts = Counter(filter(known.__contains__, words))
    counts.update(filter(known.__contains__, beginnings))
    return sorted((f, math.log1p(100 * n / len(words))) for f, n in counts.items())


@dataclass(frozen=True)
class Model:
    """Feature weights and ordered thresholds."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def chances(self, text: str | None) -> list[float]:
        """P(grade ≥ k) for k = 1, 2, …"""
        score = sum(self.weights[f] * x for f, x in rates(text, self.weights))
        return [1 / (1 + math.exp(min(700.0, max(-700.0, t - score)))) for t in self.thresholds]


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """(toxic, text) of at most ``size`` labelled keys, those with the least hashes; one row per key.

    A key labelled more than once is toxic if any label says so; of a key on several texts the one with the
    least hash is taken.  ``size`` bounds rows, whatever repeats.
    """
    known = (
        labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("toxic")).where("k is not null and toxic is not null")
        .groupBy("k").agg(F.max("toxic").alias("toxic"))
    )
    total, space = known.count(), 1 << 62
    if total > size:  # a quarter more than wanted, as some labelled keys have no text
        known = known.where(F.pmod(F.xxhash64("k"), F.lit(space)) < F.lit(min(space - 1, space * 5 * size // (4 * total))))
    # About ``size`` rows of two numbers: bounded by the parameter.
    found = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(known), "k")
    folded = found.groupBy("k").agg(F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    return folded.orderBy(F.pmod(F.xxhash64("k"), F.lit(space)), "k").limit(size).select("toxic", "one.text")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = {0: Counter(), 1: Counter()}
    for batch in batches:
        for toxic, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            words, beginnings = features(value.as_py())
            seen[int(toxic > 0)].update({*words, *beginnings})
    words = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), *(pa.array([seen[c][w] for w in words], pa.int64()) for c in (0, 1))], ["word", "clean", "toxic"],
    )


def vocabulary(sample: DataFrame, size: int) -> tuple[list[str], set[str]]:
    """Words that tell toxic from other texts best, and those of them that mark toxic texts."""
    sums = sample.groupBy().agg(
        F.sum((F.col("toxic") > 0).cast("bigint")).alias("t"), F.sum((F.col("toxic") <= 0).cast("bigint")).alias("c"),
    ).first()
    toxic, clean = sums["t"] or 0, sums["c"] or 0
    if not toxic or not clean:
        return [], set()
    share = lambda n, of: (F.col(n) + 0.5) / (of + 1.0)
    both, part = F.col("clean") + F.col("toxic"), toxic / (toxic + clean)
    term = lambda n, of: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (both * of))).otherwise(0.0)
    counted = (
        sample.mapInArrow(_word_counts, "word string, clean bigint, toxic bigint").groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(both >= LEAST)
        .withColumn("ratio", share("toxic", toxic) / share("clean", clean))
        .withColumn("pull", 2 * (term("toxic", part) + term("clean", 1 - part))).where(F.col("pull") >= CERTAIN)
    )
    best = counted.orderBy(F.desc("pull"), "word").limit(size).collect()  # bounded by VOCABULARY
    return [r["word"] for r in best], {r["word"] for r in best if r["ratio"] >= FAR_MORE}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = SAMPLE, words: int = VOCABULARY) -> Model:
    """The model of the labelled sample.  Without both toxic and other labelled texts, one that finds nothing toxic."""
    ship(docs.sparkSession)
    sample = materialise(labelled_sample(docs, labels, key, text, label, sample_rows))
    chosen, marks = vocabulary(sample, words)
    if not chosen:
        return Model({}, (math.inf,) * GRADES)
    place = {f: i for i, f in enumerate(chosen)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rates(value.as_py(), place) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[place[f] for f, _ in one] for one in found], pa.list_(pa.int32())),
                 pa.array([[x for _, x in one] for one in found], pa.list_(pa.float64())),
                 pa.array([sum(math.expm1(x) for f, x in one if f in marks) for one in found], pa.float64())],
                ["toxic", "at", "x", "rate"],
            )

    sparse = sample.mapInArrow(rows, "toxic int, at array<int>, x array<double>, rate double")
    taken = sparse.orderBy("toxic", "rate", "at", "x").toArrow()  # bounded by SAMPLE
    toxic = np.array(taken.column("toxic").to_pylist()) > 0
    rate = taken.column("rate").to_numpy()
    at, x = taken.column("at").to_pylist(), taken.column("x").to_pylist()
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    column = np.array([i for a in at for i in a], np.int64)
    value = np.array([v for one in x for v in one], np.float64)
    borders = np.quantile(rate[toxic], [i / GRADES for i in range(1, GRADES)])
    grade = np.where(toxic, 1 + np.searchsorted(borders, rate, side="right"), 0)
    weights, thresholds = cumulative_link(row, column, value, grade, len(chosen))
    return Model({w: float(weights[i]) for w, i in place.items()}, tuple(map(float, thresholds)))


def loss_and_slope(theta: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
                   penalty: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with its penalty, and the gradient, at weights, first threshold and logarithms of the gaps."""
    levels, count, at_grade = GRADES, len(grade), np.arange(len(grade))
    weights, cuts = theta[:width], theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])
    score = np.bincount(row, value * weights[column], count)
    above = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -60, 60)))
    padded = np.concatenate([np.ones((count, 1)), above, np.zeros((count, 1))], axis=1)
    chance = np.maximum(padded[at_grade, grade] - padded[at_grade, grade + 1], 1e-12)
    slope = padded * (1 - padded)
    upper, lower = slope[at_grade, grade], slope[at_grade, grade + 1]
    by_score = (upper - lower) / chance / count
    gradient = np.zeros_like(theta)
    gradient[:width] = -np.bincount(column, value * by_score[row], width) + penalty * weights
    by_cut = np.zeros(levels + 2)
    np.add.at(by_cut, grade, upper / chance / count)
    np.add.at(by_cut, grade + 1, -lower / chance / count)
    by_cut = by_cut[1:-1]
    gradient[width] = by_cut.sum()
    gradient[width + 1:] = [by_cut[k:].sum() * np.exp(theta[width + k]) for k in range(1, levels)]
    return float(-np.log(chance).mean() + 0.5 * penalty * (weights * weights).sum()), gradient


def cumulative_link(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
                    penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the ordinal model, by Adam steps on the mean negative log-likelihood.

    Thresholds are a first value plus positive gaps, so their order holds by construction.
    """
    levels, count = GRADES, len(grade)
    share = np.array([max(0.5, (grade >= k).sum()) / (count + 1) for k in range(1, levels + 1)])
    start = np.maximum.accumulate(np.log1p(-share) - np.log(share))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    theta = np.concatenate([np.zeros(width), start[:1], gaps])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        _, gradient = loss_and_slope(theta, row, column, value, grade, width, penalty)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:width], theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, severity (expected grade), grade (highest k with P(grade ≥ k) ≥ 1/2), toxic (grade ≥ 1), after ``keep``.

    Null and empty texts hold no word of the model and get the severity of such texts.  Repeated rows
    stay; an empty table gives an empty result; columns not in ``keep`` are ignored.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY
    plain = [c for c in dict.fromkeys((key, *keep)) if c != text]
    fields = [*plain, *([text] if text in keep else []), "severity", "grade", "toxic"]

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            chances = [model.chances(value.as_py()) for value in batch.column(len(plain))]
            grades = [sum(c >= 0.5 for c in one) for one in chances]
            columns = batch.columns if text in keep else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([sum(one) for one in chances], pa.float64()), pa.array(grades, pa.int32()),
                 pa.array([g >= 1 for g in grades], pa.bool_())], fields,
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in fields[:-3])
    return docs.select(*plain, text).mapInArrow(grade, f"{kinds}, severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the texts of grade 1 or more, as judged by the model fitted on ``labels``."""
    model = fit(docs, labels, key, text)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def pass_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, at = sent.value, names.index(text)
        for batch in batches:
            yield batch.filter(pa.array([model.chances(v.as_py())[0] < 0.5 for v in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(pass_clean, docs.schema)
