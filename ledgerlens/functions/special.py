"""Special functions Spark SQL lacks, as plain column arithmetic (JVM side), and the same over arrays for likelihood sums."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8


def _shift_product(z: Column) -> Column:
    return reduce(lambda acc, i: acc * (z + F.lit(float(i))), range(1, _SHIFT), z)


def ln_gamma(z: Column) -> Column:
    """ln Γ(z) for z > 0: recurrence up to z + 8, then the Stirling series."""
    w = z + F.lit(float(_SHIFT))
    inv = F.lit(1.0) / w
    inv2 = inv * inv
    series = inv * (F.lit(1 / 12) - inv2 * (F.lit(1 / 360) - inv2 * (F.lit(1 / 1260) - inv2 / F.lit(1680.0))))
    stirling = (w - F.lit(0.5)) * F.log(w) - w + F.lit(0.5 * math.log(2 * math.pi)) + series
    return stirling - F.log(_shift_product(z))


def digamma(z: Column) -> Column:
    """ψ(z) for z > 0: recurrence up to z + 8, then the asymptotic series."""
    w = z + F.lit(float(_SHIFT))
    inv = F.lit(1.0) / w
    inv2 = inv * inv
    series = inv2 * (F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * (F.lit(1 / 252) - inv2 / F.lit(240.0))))
    steps = reduce(lambda acc, i: acc + F.lit(1.0) / (z + F.lit(float(i))), range(1, _SHIFT), F.lit(1.0) / z)
    return F.log(w) - F.lit(0.5) * inv - series - steps


def polygammas(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln Γ(z), ψ(z) and ψ′(z) for z > 0: recurrence up to z + 8, then the asymptotic series."""
    z = np.asarray(z, dtype=float)
    product, steps, squares = np.ones_like(z), np.zeros_like(z), np.zeros_like(z)
    for i in range(_SHIFT):
        inverse = 1.0 / (z + i)
        product, steps, squares = product * (z + i), steps + inverse, squares + inverse * inverse
    w = z + _SHIFT
    inv = 1.0 / w
    inv2, log = inv * inv, np.log(w)
    series = inv * (1 / 12 - inv2 * (1 / 360 - inv2 * (1 / 1260 - inv2 * (1 / 1680 - inv2 / 1188))))
    ln_gamma_ = (w - 0.5) * log - w + 0.5 * math.log(2 * math.pi) + series - np.log(product)
    psi = log - 0.5 * inv - inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132)))) - steps
    psi1 = inv + 0.5 * inv2 + inv * inv2 * (1 / 6 - inv2 * (1 / 30 - inv2 * (1 / 42 - inv2 * (1 / 30 - inv2 * 5 / 66)))) + squares
    return ln_gamma_, psi, psi1
