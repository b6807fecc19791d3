"""Null-safe numeric helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """Cast to double; text that is not a number, and NaN, become null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def clip(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a double column but keep its nulls and NaN (``greatest``/``least`` alone would replace them)."""
    bounded = bound(c, lower, upper)
    return bounded if upper is None else F.when(F.isnan(c), c).otherwise(bounded)  # NaN sorts above all numbers


def bound(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """``clip`` for columns without NaN, which ``upper`` would replace.

    Written as CASE, which compiles to half the byte code: a generated method above 8,000 bytes is never
    compiled by the JVM, and the feature projection has twenty of these.
    """
    bounded = F
    if lower is not None:
        bounded = bounded.when(c < F.lit(float(lower)), F.lit(float(lower)))
    if upper is not None:
        bounded = bounded.when(c > F.lit(float(upper)), F.lit(float(upper)))
    return bounded.otherwise(c)


def log10_floor(c: Column, floor: float) -> Column:
    return F.log10(bound(c, lower=floor))


def polynomial(c: Column, coefficients: Sequence[float]) -> Column:
    """c0 + c1*x + c2*x^2 ..., with powers as products so that results do not depend on ``pow``."""
    power, terms = None, [F.lit(coefficients[0])]
    for k in coefficients[1:]:
        power = c if power is None else power * c
        terms.append(F.lit(k) * power)
    return reduce(lambda a, b: a + b, terms)


def linspace(low: float | Column, high: float | Column, points: int) -> Column:
    """Array of ``points`` evenly spaced doubles from ``low`` to ``high`` inclusive."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    if points == 1:
        return F.array(low)
    step = F.lit(float(points - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: low + i.cast("double") * (high - low) / step)


def lookup(key: Column, table: dict[str, float], default: float | None = None) -> Column:
    """Constant lookup as one CASE expression: no join for tables of a handful of entries."""
    out = reduce(lambda acc, kv: acc.when(key == kv[0], F.lit(float(kv[1]))), table.items(), F)
    return out.otherwise(F.lit(default).cast("double"))


# Rational approximation of the inverse normal distribution (P. J. Acklam). Fixed values.
_TAIL = 0.02425
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
      1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
      6.680131188771972e01, -1.328068155288572e01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
      -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)


def _horner(x: Column, coefficients: Sequence[float]) -> Column:
    return reduce(lambda acc, k: acc * x + F.lit(k), coefficients[1:], F.lit(coefficients[0]))


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile of p in (0, 1); relative error below 1.2e-9."""
    low = F.sqrt(F.lit(-2.0) * F.ln(p))
    high = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    q = p - F.lit(0.5)
    r = q * q
    tail = lambda t: _horner(t, _C) / (_horner(t, _D) * t + F.lit(1.0))
    middle = _horner(r, _A) * q / (_horner(r, _B) * r + F.lit(1.0))
    return F.when(p < _TAIL, tail(low)).when(p > 1 - _TAIL, -tail(high)).otherwise(middle)


# erf coefficients (Abramowitz and Stegun 7.1.26 is too coarse; this is the W. J. Cody-style
# complementary form from Numerical Recipes, error below 1.2e-7). Fixed values.
_ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807,
         -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, absolute error below 1.2e-7."""
    x = F.abs(z) / F.lit(2.0 ** 0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    upper = F.lit(0.5) * t * F.exp(_horner(t, _ERFC) - x * x)
    return F.when(z >= 0, F.lit(1.0) - upper).otherwise(upper)
