"""p-values of test statistics, as column expressions over the few result rows.

Spark has no error function, no t and no chi-square distribution. They are sums
here, so that no Python worker takes part.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, functions as F


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0.

    Below 2 by the series of positive terms z^(2k+1) 2^k / (2k+1)!!, above by the
    continued fraction, which keeps its digits however small the value is.
    """
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(z.alias("term"), z.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * 2.0 * z * z / (2.0 * k + 1.0)).alias("term"),
            (acc["total"] + acc["term"] * 2.0 * z * z / (2.0 * k + 1.0)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    fraction = F.aggregate(
        F.sequence(F.lit(100), F.lit(1), F.lit(-1)), z, lambda below, k: z + k / 2.0 / below
    )
    bell = F.exp(-z * z) / math.sqrt(math.pi)
    return F.when(z < 2.0, 1.0 - 2.0 * bell * series).otherwise(bell / fraction)


def f_tail(statistic: Column, df_within: Column) -> Column:
    """P(F > statistic) for F with (1, df_within) degrees of freedom, a two-sided t tail.

    With q^2 = (d / 2) log(1 + u^2 / d) the t density becomes exp(-q^2) times a slowly varying factor. The
    tail from q0 on is exp(-q0^2) times an integral that 64 Gauss-Legendre points give: one formula for all
    sizes, and its digits do not depend on how small the tail is. NULL without degrees of freedom.
    """
    d = df_within.cast("double")
    square = d * F.log1p(statistic / d) / 2.0
    start = F.sqrt(square)
    # Beyond this the integrand is below exp(-40) of its start.
    width = 40.0 / (start + F.sqrt(square + 40.0))
    points = _gauss_points()

    def add(total: Column, point: Column) -> Column:
        y = width * point["x"]
        q = start + y
        slow = 2.0 * q / F.sqrt(-d * F.expm1(-2.0 * q * q / d))
        return total + point["w"] * F.exp(-2.0 * start * y - y * y) * slow

    integral = width * F.aggregate(points, F.lit(0.0), add)
    tail = F.least(2.0 * _gamma_step(d / 2.0) / F.sqrt(d * math.pi) * F.exp(-square) * integral, F.lit(1.0))
    known = (df_within > 0) & statistic.isNotNull()
    return F.when(known, F.when(statistic == float("inf"), 0.0).otherwise(tail))


def _gamma_step(a: Column) -> Column:
    """Gamma(a + 1/2) / Gamma(a): its asymptotic series, 20 steps further up."""
    steps = F.aggregate(
        F.sequence(F.lit(0), F.lit(19)), F.lit(1.0), lambda product, k: product * (a + k) / (a + k + 0.5)
    )
    far = a + 20.0
    # The coefficients of the series in 1 / a.
    series = F.lit(0.0)
    for coefficient in (869 / 4194304, -399 / 262144, -21 / 32768, 5 / 1024, 1 / 128, -1 / 8, 1.0):
        series = series / far + coefficient
    return steps * F.sqrt(far) * series


# Up to this many degrees of freedom the chi-square tail is a finite sum, above it an integral.
MOST_SUMMED = 128


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """P(X > statistic) for a chi-square X of any freedom, in a fixed number of steps. 1 without freedom.

    Up to MOST_SUMMED degrees a sum of dof / 2 positive terms, for odd dof after erfc; above, `_gamma_tail`.
    """
    x, known = statistic / 2.0, dof.cast("double")
    tail = F.when(dof <= MOST_SUMMED, _chi_square_sum(x, dof)).otherwise(_gamma_tail(known / 2.0, x))
    return F.when((dof < 1) | (statistic <= 0.0), 1.0).when(statistic == float("inf"), 0.0).otherwise(F.least(tail, F.lit(1.0)))


def _chi_square_sum(x: Column, dof: Column) -> Column:
    odd = dof % 2 == 1
    shift = F.when(odd, 0.5).otherwise(0.0)
    # log of x^(j + shift) e^-x / Gamma(j + shift + 1) for j = 0, then one factor x / (j + shift) a step.
    first = -x + F.when(odd, F.log(x) / 2.0 - math.log(math.sqrt(math.pi) / 2.0)).otherwise(0.0)
    terms = F.floor(F.least(dof, F.lit(MOST_SUMMED)) / 2).cast("int")
    total = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("log"), F.lit(0.0).alias("total")),
        lambda acc, j: F.struct(
            (acc["log"] + F.when(j > 0, F.log(x / (j + shift))).otherwise(0.0)).alias("log"),
            (acc["total"] + F.exp(acc["log"] + F.when(j > 0, F.log(x / (j + shift))).otherwise(0.0))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    return total + F.when(odd, erfc(F.sqrt(x))).otherwise(0.0)


def _gamma_tail(a: Column, x: Column) -> Column:
    """Q(a, x), the upper regularised incomplete gamma function, for a from 64 on.

    With t = a e^s the integrand of Gamma(a) is a^a e^-a exp(-a (e^s - 1 - s)). From s0 = log(x / a) on, y = s - s0 is
    integrated: there the exponent has grown by a (d y + (1 + d)(e^y - 1 - y)), d = x / a - 1, without a
    difference of near numbers, and 64 Gauss-Legendre points reach to where it has grown by 40. Below the mean the
    lower tail is integrated the same way. The relative error stays below 1e-9 for tails down to 1e-300.
    """
    d = x / a - 1.0
    upper = d >= 0.0
    start = F.exp(-a * (d - F.log1p(d)))
    # y^2 / 2 is below e^y - 1 - y, and y^2 / 3 below e^-y - 1 + y up to 1.
    bend = F.when(upper, 80.0).otherwise(160.0 / 3.0)
    width = 80.0 / a / (F.abs(d) + F.sqrt(d * d + bend * (1.0 + d) / a))
    points = _gauss_points()

    def add(total: Column, point: Column) -> Column:
        y = width * point["x"]
        signed = F.when(upper, y).otherwise(-y)
        # e^s - 1 - s: by its series where the difference would lose digits.
        series = signed * signed / 2.0 * (1.0 + signed / 3.0 * (1.0 + signed / 4.0 * (1.0 + signed / 5.0 * (1.0 + signed / 6.0 * (1.0 + signed / 7.0)))))
        curved = F.when(y < 0.01, series).otherwise(F.expm1(signed) - signed)
        return total + point["w"] * F.exp(-a * (F.abs(d) * y + (1.0 + d) * curved))

    integral = width * F.aggregate(points, F.lit(0.0), add)
    # Gamma(a) over its first approximation, by Stirling's series.
    step = 1.0 / (a * a)
    correction = (1.0 / 12.0 - step * (1.0 / 360.0 - step * (1.0 / 1260.0 - step / 1680.0))) / a
    part = F.sqrt(a / (2.0 * math.pi)) * F.exp(-correction) * start * integral
    return F.when(upper, part).otherwise(F.when(d <= -1.0, 1.0).otherwise(1.0 - part))


def _gauss_points() -> Column:
    """64 Gauss-Legendre points x of [0, 1] with their weights w."""
    nodes, weights = np.polynomial.legendre.leggauss(64)
    return F.array(*[
        F.struct(F.lit(float((x + 1) / 2)).alias("x"), F.lit(float(w / 2)).alias("w"))
        for x, w in zip(nodes, weights, strict=True)
    ])


def kolmogorov_tail(distance: Column, n_left: Column, n_right: Column) -> Column:
    """p-value of a two-sample Kolmogorov-Smirnov distance for large samples.

    Limit series 2 * sum (-1)^(k-1) exp(-2 k^2 t^2), with Vrbik's (2018)
    correction of t for finite n, at the effective size n1 n2 / (n1 + n2).
    Below t = 0.2 the true value is 1 within 1e-12 and the cut series is not.
    """
    size = F.greatest(F.round(n_left * 1.0 * n_right / (n_left + n_right)), F.lit(1.0))
    x = F.sqrt(size) * distance
    t = x + 1.0 / (6.0 * F.sqrt(size)) + (x - 1.0) / (4.0 * size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * t * t),
    )
    # `greatest` passes over NULL, so a side without rows needs its own condition.
    bounded = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    return F.when(t < 0.2, 1.0).when(t >= 0.2, bounded)
