"""Sequential search for tree parameters: Parzen proposals from a trial table, poor trials stopped after their first fold.

A trial is a point of the unit cube, one coordinate per parameter.  After a start at random, the best
tenth of the finished trials and the others are each described by kernels; a coordinate's proposal is
the one of some candidates, drawn from the good trials' kernels, at which the good are densest against
the others.  All chance comes from hashes of seed, trial and parameter, so a proposal follows from the
table alone.  A round's trials, and the folds of a trial, are fitted side by side, a task each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, fields
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.boosting import BoostParams
from ledgerlens.operators.forest import Sample, draw_sample, fit_side_by_side

# The published search ranges.
SPACE = {
    "n_estimators": (100, 1500, "int"),
    "learning_rate": (0.005, 0.3, "log"),
    "num_leaves": (15, 127, "int"),
    "max_depth": (3, 12, "int"),
    "min_child_samples": (5, 100, "int"),
    "subsample": (0.5, 1.0, "share"),
    "colsample": (0.3, 1.0, "share"),
    "reg_alpha": (1e-8, 10.0, "log"),
    "reg_lambda": (1e-8, 10.0, "log"),
}
STARTS = 10  # random trials before the first proposal
TOGETHER = 5  # trials proposed from one state of the table
CANDIDATES = 24
GOOD_SHARE = 0.1


@dataclass(frozen=True)
class Trial:
    trial: int
    unit: dict[str, float]
    loss: float  # mean absolute error: over all folds, or of the first where the trial was stopped there
    finished: bool


def uniform(seed: int, trial: int, name: str, what: str) -> float:
    return int(hashlib.md5(f"{seed}:{trial}:{name}:{what}".encode()).hexdigest()[:8], 16) / 2**32


def normal(seed: int, trial: int, name: str, what: str) -> float:
    """Nearly standard normal: the sum of the eight 16-bit pieces of a hash."""
    digest = hashlib.md5(f"{seed}:{trial}:{name}:{what}".encode()).hexdigest()
    return (sum(int(digest[4 * i:4 * i + 4], 16) for i in range(8)) / 65536 - 4) / math.sqrt(8 / 12)


def bandwidth(points: Sequence[float]) -> float:
    n = len(points)
    mean = sum(points) / n
    spread = math.sqrt(max(0.0, sum(p * p for p in points) / n - mean * mean))
    return max(1.06 * spread * n ** -0.2, 1 / (1 + n))


def density(x: float, points: Sequence[float]) -> float:
    """Kernels at the points, mirrored at 0 and 1, and one flat kernel."""
    if not points:
        return 1.0
    width = bandwidth(points)
    mass = sum(math.exp(-0.5 * ((x - m) / width) ** 2) for p in points for m in (p, -p, 2 - p))
    return (1 + mass / (width * math.sqrt(2 * math.pi))) / (len(points) + 1)


def propose(table: Sequence[Trial], trial: int, seed: int, names: Sequence[str] = tuple(SPACE)) -> dict[str, float]:
    """The point of the unit cube to try as number ``trial``; at random as long as the table is short."""
    if len(table) < STARTS:
        return {name: uniform(seed, trial, name, "start") for name in names}
    ordered = sorted(table, key=lambda t: (not t.finished, t.loss, t.trial))
    count = min(math.ceil(GOOD_SHARE * len(ordered)), 25)
    point = {}
    for name in names:
        good, rest = [t.unit[name] for t in ordered[:count]], [t.unit[name] for t in ordered[count:]]
        width, best = bandwidth(good), None
        for c in range(CANDIDATES):
            kernel = math.floor(uniform(seed, trial, name, f"kernel{c}") * (count + 1))
            if kernel == count:
                x = uniform(seed, trial, name, f"flat{c}")
            else:
                x = (good[kernel] + width * normal(seed, trial, name, f"normal{c}")) % 2
                x = 2 - x if x > 1 else x
            score = math.log(density(x, good)) - math.log(density(x, rest))
            if best is None or score > best[0]:
                best = (score, x)
        point[name] = best[1]
    return point


def params_of(unit: dict[str, float], seed: int, space: dict = SPACE) -> BoostParams:
    """Parameters of a point: whole numbers and shares uniform in their ranges, the others in the logarithm."""
    chosen = {}
    for name, u in unit.items():
        low, high, kind = space[name]
        if kind == "int":
            chosen[name] = min(high, low + math.floor(u * (high - low + 1)))
        elif kind == "log":
            chosen[name] = math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
        else:
            chosen[name] = low + u * (high - low)
    return BoostParams(**chosen, seed=seed)


def run_round(spark: SparkSession, sample: Sample, points: dict[int, dict[str, float]], earlier: Sequence[float], folds: int, seed: int,
              space: dict) -> tuple[list[Trial], list[float]]:
    """Trials of a round and their errors on the first fold; those above the middle of ``earlier`` first-fold errors stop there."""
    numbers = sorted(points)
    params = {t: params_of(points[t], seed, space) for t in numbers}
    errors: dict[int, list[float | None]] = {t: [] for t in numbers}

    def add_folds(some: Sequence[int], which: Sequence[int]) -> None:
        jobs = [(t, f) for t in some for f in which]
        for (t, _), (_, e) in zip(jobs, fit_side_by_side(spark, sample, [(params[t], f) for t, f in jobs], keep_trees=False)):
            errors[t].append(e)

    bar = median(earlier) if len(earlier) >= STARTS else math.inf
    add_folds(numbers, range(1 if bar < math.inf else folds))  # where no trial can be stopped, all folds run side by side
    first = {t: errors[t][0] for t in numbers}
    going = [t for t in numbers if first[t] is None or first[t] <= bar]
    if bar < math.inf:
        add_folds(going, range(1, folds))
    errors = {t: [e for e in errors[t] if e is not None] for t in going}
    trials = [Trial(t, points[t], sum(errors[t]) / max(1, len(errors[t])) if t in errors else first[t], t in errors) for t in numbers]
    return trials, [first[t] for t in numbers if first[t] is not None]


def search(df: DataFrame, inputs: Sequence[str], label: str, trials: int = 30, seed: int = 42, folds: int = 5, key: str = "customer_id",
           space: dict = SPACE, fit_rows: int | None = None) -> tuple[BoostParams, list[Trial]]:
    """(best parameters by cross-validated mean absolute error, all trials).

    Folds hang on the key alone; all labelled rows take part unless ``fit_rows`` says how many.  With ``trials`` 0 the published defaults are returned.
    """
    sample = draw_sample(df, inputs, label, fit_rows, folds, key)
    table: list[Trial] = []
    first: list[float] = []
    while len(table) < trials:
        count = min(TOGETHER if len(table) >= STARTS else STARTS - len(table), trials - len(table))
        points = {len(table) + i: propose(table, len(table) + i, seed, tuple(space)) for i in range(count)}
        done, errors = run_round(df.sparkSession, sample, points, first, folds, seed, space)
        table += done
        first += errors
    finished = [t for t in table if t.finished]
    best = min(finished, key=lambda t: (t.loss, t.trial), default=None)
    return (params_of(best.unit, seed, space) if best else BoostParams(seed=seed)), table


def trial_table(spark: SparkSession, table: Sequence[Trial], seed: int, space: dict = SPACE) -> DataFrame:
    """(trial, the parameters, mae, finished): one row per trial."""
    kinds = {f.name: "int" if f.type == "int" else "double" for f in fields(BoostParams)}
    rows = [(t.trial, *[getattr(params_of(t.unit, seed, space), n) for n in space], t.loss, t.finished) for t in table]
    return spark.createDataFrame(rows, ", ".join(["trial int", *[f"{n} {kinds[n]}" for n in space], "mae double", "finished boolean"]))
