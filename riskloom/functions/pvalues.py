"""Tail probabilities of the two drift tests, for scalars already reduced by Spark."""

from __future__ import annotations

import math


def chi_square_p(statistic: float, dof: int) -> float:
    """Upper tail of chi-square with whole degrees of freedom, by its finite closed form."""
    if dof <= 0 or statistic <= 0:
        return 1.0
    half = statistic / 2.0
    odd = dof % 2 == 1
    # even: sum of h^s e^-h / s! for s = 0 .. dof/2 - 1
    # odd:  erfc(sqrt h) + the same sum for s = 1/2, 3/2 .. dof/2 - 1
    total = math.erfc(math.sqrt(half)) if odd else 0.0
    s = 0.5 if odd else 0.0
    while s <= dof / 2.0 - 1.0:
        total += math.exp(s * math.log(half) - half - math.lgamma(s + 1.0))
        s += 1.0
    return min(1.0, max(0.0, total))


def ks_p(distance: float, n: int, m: int) -> float:
    """Asymptotic two-sided Kolmogorov tail at sqrt(nm/(n+m)) * D."""
    if n <= 0 or m <= 0:
        return 1.0
    lam = distance * math.sqrt(n * m / (n + m))
    if lam < 0.04:
        return 1.0
    if lam < 1.18:
        # the theta-function form converges fast for small arguments
        y = math.exp(-math.pi**2 / (8.0 * lam * lam))
        cdf = math.sqrt(2.0 * math.pi) / lam * (y + y**9 + y**25 + y**49)
        return min(1.0, max(0.0, 1.0 - cdf))
    x = math.exp(-2.0 * lam * lam)
    return min(1.0, max(0.0, 2.0 * (x - x**4 + x**9)))
