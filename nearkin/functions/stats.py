"""Closed-form p-values for a handful of correlation coefficients."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            total *= step
        if abs(step - 1.0) < 1e-14:
            break
    return total


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def correlation_p_value(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a correlation coefficient over ``n`` rows."""
    if r is None or math.isnan(r) or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    freedom = n - 2
    t2 = r * r * freedom / (1.0 - r * r)
    return incomplete_beta(freedom / 2.0, 0.5, freedom / (freedom + t2))
