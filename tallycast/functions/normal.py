"""The normal distribution function as plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation of the normal tail (Hart 1968, as given by West 2005),
# highest power first, and the point where the continued fraction takes over.
NUMERATOR = [
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
]
DENOMINATOR = [
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
]
SWITCH = 7.07106781186547
ROOT_TWO_PI = 2.506628274631


def _polynomial(coefficients: list[float], x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def normal_cdf(z: Column) -> Column:
    """Phi(z); largest error about 2e-16."""
    a = F.abs(z)
    bell = F.exp(-a * a / 2)
    near = bell * _polynomial(NUMERATOR, a) / _polynomial(DENOMINATOR, a)
    fraction = a + F.lit(0.65)
    for k in (4, 3, 2, 1):
        fraction = a + F.lit(float(k)) / fraction
    far = bell / fraction / F.lit(ROOT_TWO_PI)
    tail = F.when(a > 37, F.lit(0.0)).when(a < SWITCH, near).otherwise(far)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def normal_pdf(z: Column) -> Column:
    return F.exp(-z * z / 2) / F.lit(math.sqrt(2 * math.pi))
