"""Exact (Clopper-Pearson) bounds on a rate."""

from __future__ import annotations

import math


def _at_most(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` hits in ``n``."""
    if p <= 0:
        return 1.0
    if p >= 1:
        return float(k >= n)
    whole, hit, miss = math.lgamma(n + 1), math.log(p), math.log1p(-p)
    return math.fsum(math.exp(whole - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * hit + (n - i) * miss) for i in range(k + 1))


def binomial_lower(hits: int, n: int, confidence: float) -> float:
    """Lower bound on the rate behind ``hits`` of ``n``, by bisection; 0 without evidence."""
    if n <= 0 or hits <= 0:
        return 0.0
    low, high = 0.0, hits / n
    # The bound falls with the misses; few of them are summed.
    for _ in range(50):
        p = (low + high) / 2
        low, high = (p, high) if _at_most(n - hits, n, 1 - p) < 1 - confidence else (low, p)
    return low
