"""Maximum likelihood for the gamma-gamma model of customer spend.

The likelihood, its gradient and its curvature need a few sums per purchase count only:
each step of Newton's method is one aggregate, and the driver sees a row for each count.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Guess = tuple[float, float, float]


def log_likelihood(x: int, z: float, p: float, q: float, gamma: float) -> float:
    """Log-likelihood of one customer with x purchases of mean z."""
    return (
        math.lgamma(p * x + q)
        - math.lgamma(p * x)
        - math.lgamma(q)
        + q * math.log(gamma)
        + (p * x - 1) * math.log(z)
        + p * x * math.log(x)
        - (p * x + q) * math.log(gamma + x * z)
    )


def score(rows: DataFrame, x: str, z: str, guesses: list[Guess]) -> list[float]:
    """Total log-likelihood of each guess.

    The gamma functions depend on the purchase count alone, so customers are
    first counted per purchase count and only the logarithms of spend stay with
    the rows; all of it is built-in aggregation.
    """
    kept = rows.where((F.col(x) > 0) & (F.col(z) > 0))
    n, mean = F.col(x).cast("double"), F.col(z)
    sums = []
    for i, (p, _, gamma) in enumerate(guesses):
        sums.append(F.sum((p * n - 1) * F.log(mean)).alias(f"a{i}"))
        sums.append(F.sum(F.log(gamma + n * mean)).alias(f"b{i}"))
    per_count = kept.groupBy(x).agg(F.count(F.lit(1)).alias("customers"), *sums)
    totals = [0.0] * len(guesses)
    for row in per_count.toLocalIterator():
        k, count = row[x], row["customers"]
        for i, (p, q, gamma) in enumerate(guesses):
            fixed = math.lgamma(p * k + q) - math.lgamma(p * k) - math.lgamma(q) + q * math.log(gamma)
            fixed += p * k * math.log(k)
            totals[i] += count * fixed + row[f"a{i}"] - (p * k + q) * row[f"b{i}"]
    return totals


def digamma(v: np.ndarray) -> np.ndarray:
    """Derivative of the logarithm of the gamma function: recurrence up to 10, then its series."""
    v, out = np.asarray(v, float).copy(), np.zeros(np.shape(v))
    while (low := v < 10).any():
        out, v = out - np.where(low, 1 / v, 0), np.where(low, v + 1, v)
    r = 1 / (v * v)
    return out + np.log(v) - 0.5 / v - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))


def trigamma(v: np.ndarray) -> np.ndarray:
    v, out = np.asarray(v, float).copy(), np.zeros(np.shape(v))
    while (low := v < 10).any():
        out, v = out + np.where(low, 1 / (v * v), 0), np.where(low, v + 1, v)
    r = 1 / (v * v)
    return out + 1 / v + r / 2 + r / v * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * 5 / 66))))


def moments(rows: DataFrame, x: str, z: str, gamma: float) -> dict[str, np.ndarray]:
    """Per purchase count: customers and the sums over them that value, gradient and curvature are made of."""
    kept = rows.where((F.col(x) > 0) & (F.col(z) > 0))
    reach = gamma + F.col(x).cast("double") * F.col(z)
    per = kept.groupBy(F.col(x).cast("double").alias("x")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.log(z)).alias("log_z"),
        F.sum(F.log(reach)).alias("log_reach"),
        F.sum(1 / reach).alias("inverse"),
        F.sum(1 / (reach * reach)).alias("square"),
    )
    found = sorted(per.collect(), key=lambda r: r["x"])  # a row for each purchase count
    return {c: np.array([r[c] for r in found], float) for c in per.columns}


def value(m: dict[str, np.ndarray], p: float, q: float, gamma: float) -> float:
    """Log-likelihood from the sums."""
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    x, n = m["x"], m["n"]
    fixed = lgamma(p * x + q) - lgamma(p * x) - math.lgamma(q) + q * math.log(gamma) + p * x * np.log(x)
    return float((n * fixed + (p * x - 1) * m["log_z"] - (p * x + q) * m["log_reach"]).sum())


def slopes(m: dict[str, np.ndarray], p: float, q: float, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log-likelihood by the logarithms of p, q and gamma."""
    x, n, a = m["x"], m["n"], p * m["x"] + q
    g = np.array(
        [
            (n * x * (digamma(a) - digamma(p * x) + np.log(x)) + x * (m["log_z"] - m["log_reach"])).sum(),
            (n * (digamma(a) - digamma(np.full(1, q)) + math.log(gamma)) - m["log_reach"]).sum(),
            (n * q / gamma - a * m["inverse"]).sum(),
        ]
    )
    pq, pg, qg = (n * x * trigamma(a)).sum(), -(x * m["inverse"]).sum(), (n / gamma - m["inverse"]).sum()
    h = np.array(
        [
            [(n * x * x * (trigamma(a) - trigamma(p * x))).sum(), pq, pg],
            [pq, (n * (trigamma(a) - trigamma(np.full(1, q)))).sum(), qg],
            [pg, qg, (a * m["square"] - n * q / gamma**2).sum()],
        ]
    )
    at = np.array([p, q, gamma])
    return g * at, h * np.outer(at, at) + np.diag(g * at)


def fit(rows: DataFrame, x: str, z: str, tolerance: float = 1e-6, rounds: int = 200) -> tuple[float, float, float, float]:
    """(p, q, gamma, log-likelihood) by Newton's method on the logarithms of the parameters.

    Every step is one aggregate of a few sums per purchase count. A step that does not
    raise the likelihood is halved; where the curvature is not that of a summit it is
    bent until it is. The fit ends when no part of the gradient exceeds ``tolerance`` for a
    customer, which it also does far out where customers are so alike that the likelihood
    only levels off; if it does not within ``rounds`` steps, that is an error.
    """
    known = rows.where((F.col(x) > 0) & (F.col(z) > 0))
    mean = known.agg(F.avg(z)).first()[0]
    if mean is None:
        raise ValueError("no customer with purchases")
    at = np.log([2.0, 3.0, mean])
    m = moments(rows, x, z, math.exp(at[2]))
    best, customers = value(m, *np.exp(at)), float(m["n"].sum())
    for _ in range(rounds):
        g, h = slopes(m, *np.exp(at))
        if np.abs(g).max() <= tolerance * customers:
            p, q, gamma = (float(v) for v in np.exp(at))
            return p, q, gamma, best
        top = np.linalg.eigvalsh(h).max()
        if top >= -1e-9 * customers:
            h = h - (top + 1e-3 * customers) * np.eye(3)
        step = np.linalg.solve(h, -g)
        step *= min(1.0, 2 / np.abs(step).max())
        for _ in range(40):
            tried = at + step
            own = moments(rows, x, z, math.exp(tried[2]))
            new = value(own, *np.exp(tried))
            if new >= best - 1e-13 * abs(best):
                break
            step = step / 2
        else:
            break
        at, m, best = tried, own, new
        if np.abs(at).max() > 40:
            break
    raise ValueError("the likelihood of the gamma-gamma model has no summit that could be reached on these customers")
