"""BG/NBD purchase model (Fader, Hardie & Lee 2005): scoring as columns, fitting as aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.quadrature import LogitRule, logit_rule
from ledgerlens.functions.special import digamma, ln_gamma, polygammas
from ledgerlens.operators.likelihood import maximise
from ledgerlens.operators.stability import materialise, ship
from ledgerlens.schemas import require_columns


@dataclass(frozen=True)
class PurchaseModel:
    """Gamma(r, alpha) purchase rates, beta(a, b) dropout."""

    r: float
    alpha: float
    a: float
    b: float
    converged: bool = True


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def _dropout_odds(model: PurchaseModel) -> Column:
    """Odds that a repeat customer has dropped out since the last purchase."""
    x, tx, t = _double("frequency"), _double("recency"), _double("T")
    ratio = F.pow((F.lit(model.alpha) + t) / (F.lit(model.alpha) + tx), F.lit(model.r) + x)
    return F.when(x > 0, F.lit(model.a) / (F.lit(model.b) + x - 1) * ratio).otherwise(F.lit(0.0))


def p_alive(model: PurchaseModel) -> Column:
    """Probability of still being a customer; 1 without a repeat purchase."""
    return F.lit(1.0) / (F.lit(1.0) + _dropout_odds(model))


def active_purchases(model: PurchaseModel, plans: Sequence[Sequence[tuple[float, float]]], arrow: bool = True) -> Column:
    """Struct p0, p1, …: per plan Σ weight · E[purchases in the next ``days`` | still active] over its (days, weight) pairs.

    A customer active now with dropout chance p and purchase rate λ buys (1 − e^(−λpt)) / p times on
    average; λ is gamma and p beta distributed given the history, which leaves the mean of
    (1 − (1 + p·t/(α+T))^−(r+x)) / p over Beta(a, b+x).  All rows and plans share one set of nodes
    (about a hundred, set by the model alone), and nothing special happens where a nears 1, T nears 0
    or t is long.  By default array arithmetic over batches of rows in Python workers; without ``arrow`` one fold over the
    nodes in the JVM, which takes ten times as long where tables are large.  Rows should be spread (``stability.spread``) before.
    """
    longest = max((days for plan in plans for days, _ in plan), default=1.0)
    rule = logit_rule(model.a, model.b, longest * max(1.0, model.r / model.alpha))
    names = [f"p{i}" for i in range(len(plans))]
    complete = F.col("frequency").isNotNull() & F.col("T").isNotNull()
    evaluate = _in_batches if arrow else _in_rows
    return F.when(complete, evaluate(model, plans, rule, names))


def _in_rows(model: PurchaseModel, plans, rule: LogitRule, names: list[str]) -> Column:
    x, pace = _double("frequency"), F.lit(1.0) / (F.lit(model.alpha) + _double("T"))
    rest = F.lit(model.b) + x
    # The weights' exact maximum, taken off before the exponential.
    peak = F.lit(model.a) * F.log(F.lit(model.a) / (F.lit(model.a) + rest)) + rest * F.log(rest / (F.lit(model.a) + rest))

    def terms(p: Column, inverse: Column, log_weight: Column, log_rest: Column) -> tuple[Column, list[Column]]:
        weight, out = F.exp(log_weight + x * log_rest - peak), []
        for plan in plans:
            total = F.lit(0.0)
            for days, factor in plan:
                total = total - F.lit(factor) * F.expm1(-(F.lit(model.r) + x) * F.log1p(p * pace * F.lit(days)))
            out.append(inverse * total)
        return weight, out

    parts = list(zip(rule.p.tolist(), (1.0 / rule.p).tolist(), rule.log_weight.tolist(), rule.log_rest.tolist()))
    fields = ("p", "inverse", "log_weight", "log_rest")
    nodes = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, node)]) for node in parts[:-1]])

    def add(sums: Column, node: Column) -> Column:
        weight, values = terms(*(node[f] for f in fields))
        return F.struct((sums["w"] + weight).alias("w"), *[(sums[n] + weight * v).alias(n) for n, v in zip(names, values)])

    weight, values = terms(*(F.lit(v) for v in parts[-1]))
    weight = weight / -F.expm1(-rest * F.lit(rule.step))
    start = F.struct(weight.alias("w"), *[(weight * v).alias(n) for n, v in zip(names, values)])
    return F.aggregate(nodes, start, add, lambda sums: F.struct(*[(sums[n] / sums["w"]).alias(n) for n in names]))


def _in_batches(model: PurchaseModel, plans, rule: LogitRule, names: list[str]) -> Column:
    ship(SparkSession.active())
    alpha, r, inverse = model.alpha, model.r, 1.0 / rule.p
    slice_rows = max(1, (1 << 18) // len(rule.p))

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def means(frequency: pd.Series, age: pd.Series) -> pd.DataFrame:
        out = np.empty((len(frequency), len(plans)))
        for at in range(0, len(frequency), slice_rows):
            here = slice(at, at + slice_rows)
            x = frequency.to_numpy(np.float64, na_value=np.nan)[here, None]
            pace = rule.p / (alpha + age.to_numpy(np.float64, na_value=np.nan)[here, None])
            weight = rule.weights(x[:, 0])
            known: dict[float, np.ndarray] = {}
            for i, plan in enumerate(plans):
                total = np.zeros_like(weight)
                for days, factor in plan:
                    if days not in known:
                        known[days] = np.expm1(-(r + x) * np.log1p(pace * days))
                    total -= factor * known[days]
                out[here, i] = (weight * inverse * total).sum(axis=1) / weight.sum(axis=1)
        return pd.DataFrame(out, columns=names)

    return means(_double("frequency"), _double("T"))


def expected_purchases(model: PurchaseModel, days: float) -> Column:
    """Expected purchases in the next ``days``."""
    return active_purchases(model, [[(float(days), 1.0)]])["p0"] * p_alive(model)


@lru_cache(maxsize=1)
def _rising_terms() -> tuple[Column, ...]:
    """Log ratio of the rising factorials and its slopes; they hang on column names only, so every round uses the same ones.

    Several hundred operations: putting them together anew took longer than a round's job.
    """
    rising = lambda top, low: ln_gamma(F.col(top)) - ln_gamma(F.col(low))
    inverse = lambda top, low: digamma(F.col(top)) - digamma(F.col(low))
    return (
        rising("rx", "r") + rising("bx", "b") - rising("abx", "ab"), inverse("rx", "r"), inverse("bx", "b"), inverse("abx", "ab"),
    )


def _log_likelihood(rows: DataFrame, theta: list[Column]) -> DataFrame:
    """Row log-likelihood and gradient in the log-parameters (r, alpha, a, b), at the same cost for any number of purchases."""
    x, r, al, a, b = (F.col(c) for c in ("x", "r", "al", "a", "b"))
    # Every stage names what later stages use more than once, which keeps the expressions small.
    staged = rows.select("i", "weight", "x", "tx", "t", *[v.alias(n) for n, v in zip(("r", "al", "a", "b"), theta)])
    staged = staged.select(
        "*", (a + b).alias("ab"), (r + x).alias("rx"), (b + x).alias("bx"), (a + b + x).alias("abx"),
        (al + F.col("t")).alias("at"), (al + F.col("tx")).alias("atx"), F.when(x > 0, b + x - 1).otherwise(1.0).alias("last"),
    )
    staged = staged.select("*", F.log("at").alias("log_t"), F.log("atx").alias("log_tx"))
    # Log odds of the dropped-out branch against the active one; both branches share the factor (α+T)^−(r+x).
    log_odds = F.when(x > 0, F.log(a) - F.log("last") + F.col("rx") * (F.col("log_t") - F.col("log_tx"))).otherwise(
        F.lit(float("-inf")))
    staged = staged.select("*", log_odds.alias("lo"))
    lo = F.col("lo")
    staged = staged.select(
        "*", (1 / (1 + F.exp(-lo))).alias("out"), (1 / (1 + F.exp(lo))).alias("in"),
        F.when(lo > 0, lo + F.log1p(F.exp(-lo))).otherwise(F.log1p(F.exp(lo))).alias("log_sum"),
    )
    log_ratio, inv_r, inv_b, inv_ab = _rising_terms()
    staged = staged.select(
        "*", log_ratio.alias("log_ratio"), inv_r.alias("inv_r"), inv_b.alias("inv_b"), inv_ab.alias("inv_ab"),
    )
    ll = F.col("log_ratio") + r * F.log(al) - F.col("rx") * F.col("log_t") + F.col("log_sum")
    d_r = F.col("inv_r") + F.log(al) - F.col("in") * F.col("log_t") - F.col("out") * F.col("log_tx")
    d_al = r / al - F.col("rx") * (F.col("in") / F.col("at") + F.col("out") / F.col("atx"))
    d_a = F.col("out") / a - F.col("inv_ab")
    d_b = F.col("inv_b") - F.col("inv_ab") - F.col("out") / F.col("last")
    return staged.select(
        "i", "weight", ll.alias("ll"), (r * d_r).alias("g0"), (al * d_al).alias("g1"),
        (a * d_a).alias("g2"), (b * d_b).alias("g3"),
    )


def log_likelihood(rfm: DataFrame, model: PurchaseModel) -> DataFrame:
    """(customer_id, ll, g0…g3): each customer's log-likelihood and its slopes by ln r, ln alpha, ln a, ln b."""
    rows = rfm.select(F.col("customer_id").alias("i"), F.lit(1.0).alias("weight"), _double("frequency").alias("x"),
                      _double("recency").alias("tx"), _double("T").alias("t"))
    theta = [F.lit(float(v)) for v in (model.r, model.alpha, model.a, model.b)]
    return _log_likelihood(rows, theta).withColumnRenamed("i", "customer_id").drop("weight")


def row_model(data: dict[str, np.ndarray], theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of histories (x, tx, t) and its first and second derivatives by r, alpha, a, b."""
    r, al, a, b = (float(v) for v in theta)
    x, tx, t = data["x"], data["tx"], data["t"]
    again = x > 0
    rx, at, atx, last = r + x, al + t, al + tx, np.where(again, b + x - 1, 1.0)
    (l_rx, p_rx, q_rx), (l_bx, p_bx, q_bx), (l_abx, p_abx, q_abx) = (polygammas(v) for v in (rx, b + x, a + b + x))
    (l_r, p_r, q_r), (l_b, p_b, q_b), (l_ab, p_ab, q_ab) = (polygammas(np.array([v])) for v in (r, b, a + b))
    log_t, log_tx = np.log(at), np.log(atx)
    # Odds of having dropped out since the last purchase against being active; "out" and "in" are the two chances.
    odds = np.where(again, np.log(a) - np.log(last) + rx * (log_t - log_tx), -np.inf)
    out = np.where(odds > 0, 1 / (1 + np.exp(-np.abs(odds))), np.exp(-np.abs(odds)) / (1 + np.exp(-np.abs(odds))))
    stay = 1 - out
    ll = (l_rx - l_r) + (l_bx - l_b) - (l_abx - l_ab) + r * np.log(al) - rx * log_t + np.maximum(odds, 0) + np.log1p(np.exp(-np.abs(odds)))
    none = np.zeros_like(x)
    # Slopes of the two branches: active, dropped out.
    active = np.stack([-log_t, -rx / at, none, none])
    gone = np.stack([-log_tx, -rx / atx, none + 1 / a, -1 / last])
    first = stay * active + out * gone
    first += np.stack([p_rx - p_r + np.log(al), none + r / al, p_ab - p_abx, p_bx - p_b + p_ab - p_abx])
    apart = gone - active
    second = stay * out * apart[:, None] * apart[None]
    second[0, 0] += q_rx - q_r
    second[0, 1] += 1 / al - stay / at - out / atx
    second[1, 0] = second[0, 1]
    second[1, 1] += -r / al ** 2 + rx * (stay / at ** 2 + out / atx ** 2)
    second[2, 2] += q_ab - q_abx - out / a ** 2
    second[2, 3] += q_ab - q_abx
    second[3, 2] = second[2, 3]
    second[3, 3] += q_bx - q_b + q_ab - q_abx + out / last ** 2
    return ll, first, second


def fit(rfm: DataFrame, penalizer: float = 0.01, max_rounds: int = 200) -> PurchaseModel:
    """Penalised maximum likelihood; ``converged`` tells whether the search ended at a maximum.

    Customers with equal (frequency, recency, T) are one weighted row, so the iterations run over
    combinations of day counts — bounded by the calendar — and not over customers.
    """
    require_columns(rfm, ("frequency", "recency", "T"))
    counts = materialise(rfm.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("n")))
    longest = counts.agg(F.max("T")).first()[0]
    scale = 10.0 / max(float(longest), 1.0)  # published convention: the longest history becomes 10
    rows = materialise(counts.select(
        _double("frequency").alias("x"), (_double("recency") * scale).alias("tx"), (_double("T") * scale).alias("t"),
        F.col("n").cast("double").alias("weight"),
    ))
    found, _, converged = maximise(rows, row_model, (1.0, 1.0, 1.0, 1.0), penalizer, max_rounds)
    r, alpha, a, b = (float(v) for v in found)
    return PurchaseModel(r, alpha / scale, a, b, converged)
