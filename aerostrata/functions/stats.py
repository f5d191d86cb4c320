"""Distribution functions as native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients for g = 7.
LANCZOS_G = 7
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]
TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x of 0.5 or more, to about 15 digits."""
    z = x - 1
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + i)
    t = z + LANCZOS_G + 0.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(series)


def _fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """Continued fraction of the incomplete beta function, two terms a step, from the front (Lentz)."""
    away = lambda v: F.when(F.abs(v) < TINY, TINY).otherwise(v)

    def term(acc: Column, by: Column) -> Column:
        d = 1 / away(1 + by * acc["d"])
        c = away(1 + by / acc["c"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    def step(acc: Column, m: Column) -> Column:
        even = term(acc, m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)))
        both = F.transform(F.array(even), lambda e: term(e, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))))
        return both[0]

    d = 1 / away(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    numbers = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda m: m.cast("double"))
    return F.aggregate(numbers, start, step, lambda acc: acc["h"])


def incomplete_beta(x: Column, a: Column, b: Column, steps: int = 200) -> Column:
    """Regularised incomplete beta function I_x(a, b) for x in [0, 1], a and b of 0.5 or more.

    The fraction is taken on the side of the mean where it converges within a fixed number of steps; 200 are enough
    for a and b up to about 10,000. Null, and x outside [0, 1], give null.
    """
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    low = front * _fraction(a, b, x, steps) / a
    high = 1 - front * _fraction(b, a, 1 - x, steps) / b
    inside = F.when(x < (a + 1) / (a + b + 2), low).otherwise(high)
    return F.when(x == 0, 0.0).when(x == 1, 1.0).when((x > 0) & (x < 1), inside)


def t_test_p(t: Column, dof: Column, steps: int = 200) -> Column:
    """Two-sided p-value of Student's t with `dof` degrees of freedom, of 1 or more; null if either is null or NaN."""
    t, dof = t.cast("double"), dof.cast("double")
    known = ~F.isnan(t) & ~F.isnan(dof) & (dof >= 1)
    return F.when(known, incomplete_beta(dof / (dof + t * t), dof / 2, F.lit(0.5), steps))
