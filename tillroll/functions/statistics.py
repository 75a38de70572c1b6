"""Statistic expressions over aggregates, and the one scalar helper for the t distribution's tail."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def skew_g1(c: Column) -> Column:
    """Bias-corrected sample skewness as an aggregate: null under three values, 0 for a constant."""
    n = F.count(c).cast("double")
    corrected = F.try_divide(F.skewness(c) * F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, None).when(F.min(c) == F.max(c), 0.0).otherwise(corrected)


def t_of_r(r: Column, n: Column) -> Column:
    return r * F.sqrt(F.try_divide((n - 2).cast("double"), 1 - r * r))


def _log_gamma_step(a: float) -> float:
    """ln gamma(a + 1/2) - ln gamma(a), without the cancellation of two large logarithms."""
    shift = 0.0
    while a < 20.0:
        shift += math.log(a) - math.log(a + 0.5)
        a += 1.0
    inverse = 1.0 / a
    series = inverse * (-1 / 8 + inverse**2 * (1 / 192 + inverse**2 * (-1 / 640 + inverse**2 * 17 / 14336)))
    return 0.5 * math.log(a) + series + shift


def _tail_integral(t: float, df: float, steps: int) -> float:
    """Integral over v > 0 of the density at t + v relative to the density at t: exp-sinh rule with ``steps`` a unit,
    in units of the length over which the density falls."""
    total, half = 0.0, 4 * steps
    unit = min((df + t * t) / ((df + 1.0) * t), math.sqrt((df + t * t) / (df + 1.0)))
    for i in range(-half, half + 1):
        w = i / steps
        v = unit * math.exp(0.5 * math.pi * math.sinh(w))
        grown = math.log1p(v * (2.0 * t + v) / (df + t * t))
        total += math.exp(-0.5 * (df + 1.0) * grown) * v * 0.5 * math.pi * math.cosh(w)
    return total / steps


def two_sided_t_tail(t, df):
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom, by one rule for every ``df``."""
    if t is None or df is None or df <= 0:
        return None
    t = abs(t)
    if t == 0.0:
        return 1.0
    if math.isinf(t):
        return 0.0
    rough, fine = _tail_integral(t, df, 16), _tail_integral(t, df, 32)
    if abs(fine - rough) > 1e-9 * fine:
        raise ArithmeticError(f"tail of t = {t}, df = {df} did not converge")
    log_density = _log_gamma_step(df / 2.0) - 0.5 * math.log(math.pi * df) - 0.5 * (df + 1.0) * math.log1p(t * t / df)
    return min(1.0, 2.0 * math.exp(log_density) * fine)


def t_tail(t: Column, df: Column) -> Column:
    """Two-sided p-value. Only ever applied to a one-row frame of finished statistics."""
    return F.udf(two_sided_t_tail, "double", useArrow=False)(t.cast("double"), df.cast("double"))
