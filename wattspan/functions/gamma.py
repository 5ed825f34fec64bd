"""The incomplete gamma function and tail probabilities built on it, as column expressions."""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column, functions as F

SHIFT = 10
TINY = 1e-300


def log_gamma(a: Column) -> Column:
    """Natural logarithm of the gamma function for ``a`` > 0: the asymptotic series at ``a + SHIFT``, carried back."""
    z = a + SHIFT
    inverse = 1.0 / (z * z)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse * (1 / 1680 - inverse / 1188)))) / z
    back = F.lit(0.0)
    for i in range(SHIFT):
        back = back + F.log(a + i)
    return (z - 0.5) * F.log(z) - z + 0.5 * log(2 * pi) + series - back


def _series(a: Column, x: Column, steps: Column) -> Column:
    """Sum of x^n / ((a + 1) ... (a + n)), which converges fast below a + 1."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc, n):
        term = acc["term"] * x / (a + n)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(steps, start, add, lambda acc: acc["total"] / a)


def _fraction(a: Column, x: Column, steps: Column) -> Column:
    """Continued fraction of the upper part, by the ratios of successive numerators and denominators."""
    first = x + 1.0 - a
    start = F.struct(F.lit(1.0 / TINY).alias("c"), (1.0 / first).alias("d"), (1.0 / first).alias("value"))
    held = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

    def step(acc, n):
        factor, b = n * (a - n), first + 2 * n
        d = 1.0 / held(factor * acc["d"] + b)
        c = held(b + factor / acc["c"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["value"] * c * d).alias("value"))

    return F.aggregate(steps, start, step, lambda acc: acc["value"])


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function for ``a`` > 0, ``x`` >= 0; null otherwise.

    The number of terms grows with the square root of ``a``, so figures stay within 1e-9 up to ``a`` in the thousands.
    """
    a, x = a.cast("double"), x.cast("double")
    steps = F.sequence(F.lit(1), (40 + 12 * F.sqrt(a)).cast("int"))
    scale = F.exp(a * F.log(x) - x - log_gamma(a))
    lower = 1.0 - scale * _series(a, x, steps)
    upper = scale * _fraction(a, x, steps)
    inside = F.when(x == 0, 1.0).when(x < a + 1.0, lower).otherwise(upper)
    return F.when((a > 0) & (x >= 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), inside)))


def chi_square_p_value(statistic: Column, degrees: Column) -> Column:
    """Probability of a chi-square figure at least this large; null without degrees of freedom."""
    return upper_gamma(degrees / 2.0, statistic / 2.0)
