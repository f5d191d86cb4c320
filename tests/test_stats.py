"""Distribution functions against closed forms and numeric integration."""

import math

import numpy as np
from pyspark.sql import functions as F

from aerostrata.functions import stats


def plain_p(t, dof):
    """Twice the density's integral beyond t: Simpson over u with x = t + u / (1 - u)."""
    u = np.linspace(0, 1, 400_001)[:-1]
    x = abs(t) + u / (1 - u)
    log = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    y = np.append(np.exp(log - (dof + 1) / 2 * np.log1p(x * x / dof)) / (1 - u) ** 2, 0.0 if dof > 1 else math.exp(log) * dof)
    w = np.ones(len(y))
    w[1:-1:2], w[2:-1:2] = 4, 2
    return 2 * float((w * y).sum()) * (u[1] - u[0]) / 3


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 12345.6]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(stats.log_gamma(F.col("x")).alias("g")).collect()
    assert all(abs(r.g - math.lgamma(v)) <= 1e-11 * max(1, abs(math.lgamma(v))) for r, v in zip(got, values))


def test_p_of_t(spark):
    pairs = [(t, d) for t in (0.0, 0.1, -0.7, 1.0, 2.3, -5.0, 12.0) for d in (1.0, 2.0, 3.7, 9.0, 55.5, 400.0, 8000.0)]
    rows = spark.createDataFrame([*pairs, (None, 3.0), (1.0, None), (float("nan"), 2.0), (1.0, 0.5)], "t double, d double")
    got = {(r.t, r.d): r.p for r in rows.select("t", "d", stats.t_test_p(F.col("t"), F.col("d")).alias("p")).collect()}
    assert got[1.0, 1.0] == 0.5 or abs(got[1.0, 1.0] - 0.5) < 1e-12
    assert abs(got[2.3, 2.0] - (1 - 2.3 / math.sqrt(2 + 2.3**2))) < 1e-12
    for t, d in pairs:
        assert abs(got[t, d] - plain_p(t, d)) < 1e-8, (t, d)
    assert sum(p is None for p in got.values()) == 4


def test_incomplete_beta_is_symmetric(spark):
    df = spark.createDataFrame([(x, a, b) for x in (0.0, 0.02, 0.4, 0.77, 1.0) for a in (0.5, 3.0, 80.0) for b in (0.5, 2.5, 40.0)], "x double, a double, b double")
    both = df.select(stats.incomplete_beta(F.col("x"), F.col("a"), F.col("b")).alias("p"),
                     stats.incomplete_beta(1 - F.col("x"), F.col("b"), F.col("a")).alias("q")).collect()
    assert all(abs(r.p + r.q - 1) < 1e-11 and 0 <= r.p <= 1 for r in both)
