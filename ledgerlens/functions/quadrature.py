"""Means over beta distributions by the trapezoidal rule on the logit scale.

A mean of g(p) over Beta(a, b + x) is ∫ g(p) pᵃ (1−p)ᵇ⁺ˣ dξ over the same without g, with p = 1/(1+e^−ξ).  On the logit
scale the integrands are analytic around the real line and fall off exponentially at both ends, so
equidistant nodes converge geometrically; numerator and denominator share them.  The nodes hang on a, b
and how small a p can matter, not on x: every row of a table uses the same ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

REACH = 1e5  # how often the rate of a row may exceed the prior's, at least


@dataclass(frozen=True)
class LogitRule:
    """Nodes p, the logarithm of pᵃ(1−p)ᵇ at them, and log(1−p); b and the spacing for the tail behind the last node."""

    p: np.ndarray
    log_weight: np.ndarray
    log_rest: np.ndarray
    b: float
    step: float

    def weights(self, x: np.ndarray) -> np.ndarray:
        """Weights of the nodes (columns) under Beta(a, b + x) for each x (rows), the largest of a row near 1."""
        log = self.log_weight + x[:, None] * self.log_rest
        out = np.exp(log - log.max(axis=1, keepdims=True))
        # Nodes further on would see the same function value; their weights fall in a geometric series.
        out[:, -1] /= -np.expm1(-(self.b + x) * self.step)
        return out


def _step(a: float, digits: float) -> float:
    """The widest spacing whose error, e^(−2πη/h) times the growth cos(η)^−(a+1) at height η off the line, stays below e^−digits."""
    return max(2 * math.pi * eta / (digits - (a + 1) * math.log(math.cos(eta))) for eta in np.linspace(0.02, 1.56, 400))


def logit_rule(a: float, b: float, reach: float = REACH, tolerance: float = 1e-12) -> LogitRule:
    """Nodes for Beta(a, b + x), any x ≥ 0, and functions of p that vary on scales down to 1 / ``reach``."""
    if not (a > 0 and b > 0):
        raise ValueError(f"beta parameters must be positive: {a}, {b}")
    digits = -math.log(tolerance)
    step = _step(a, digits)
    # Where a (or b) is small the tail towards 0 (or 1) falls slowly, but there the function no longer changes: the
    # nodes end where it has settled, and the last one carries the rest of its geometric series.
    first = -(digits / max(a, 1.0) + math.log(max(reach, REACH)))
    last, settled = math.log(a / b), digits + math.log(max(a, 1.0)) + math.log(REACH)
    fall = lambda logit: -a * np.logaddexp(0, -logit) - b * np.logaddexp(0, logit)
    lowest = fall(last) - digits
    last = max(last, first + step)
    while last < settled and fall(last) > lowest:
        last += step
    logit = np.arange(math.floor(first / step), math.ceil(last / step) + 1) * step
    log_p, log_rest = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    log_weight = a * log_p + b * log_rest
    log_weight[0] -= math.log(-math.expm1(-a * step))
    return LogitRule(np.exp(log_p), log_weight, log_rest, b, step)
