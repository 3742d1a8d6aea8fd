"""Small numeric helpers that Spark has no expression for."""
from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float, terms: int = 500, tiny: float = 1e-300) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz method."""
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or tiny)
    result = d
    for m in range(1, terms):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for coefficient in (even, odd):
            d = 1.0 / (1.0 + coefficient * d or tiny)
            c = 1.0 + coefficient / c or tiny
            result *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return result


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def correlation_p_value(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a Pearson correlation of ``n`` pairs; None below three pairs."""
    if r is None or math.isnan(r) or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    freedom = n - 2
    t2 = freedom * r * r / (1.0 - r * r)
    return regularized_beta(freedom / 2.0, 0.5, freedom / (freedom + t2))
