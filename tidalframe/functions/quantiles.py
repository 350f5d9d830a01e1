"""Quantiles of the normal and of Student's t distribution."""

from __future__ import annotations

import math
from statistics import NormalDist


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def t_above(t: float, degrees: int) -> float:
    """Probability that Student's t exceeds ``t`` (0 or more), a finite sum of cosines of its angle."""
    angle = math.atan2(t, math.sqrt(degrees))
    c2, term, total = math.cos(angle) ** 2, 1.0, 0.0
    if degrees % 2:
        term = math.cos(angle)
        for k in range(1, degrees - 1, 2):
            total += term
            term *= c2 * (k + 1) / (k + 2)
        inside = 2 / math.pi * (angle + math.sin(angle) * total)
    else:
        for k in range(0, degrees - 1, 2):
            total += term
            term *= c2 * (k + 1) / (k + 2)
        inside = math.sin(angle) * total
    return (1 - inside) / 2


def t_quantile(p: float, degrees: int) -> float:
    """The t below which a share ``p`` (a half or more) lies, by halving an interval."""
    low, high = 0.0, 1.0
    while t_above(high, degrees) > 1 - p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if t_above(middle, degrees) > 1 - p else (low, middle)
    return (low + high) / 2
