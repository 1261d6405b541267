"""p-values for small tables of test statistics. Each runs on one row per test, never on data rows."""

import math

import pandas as pd
from pyspark.sql import Column, functions as F


def p_normal(z: Column) -> Column:
    """Two-sided p-value of a standard normal statistic."""
    @F.pandas_udf("double")
    def two_sided(z: pd.Series) -> pd.Series:
        return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)))
    return two_sided(z)


def normal_cdf(z: Column) -> Column:
    @F.pandas_udf("double")
    def below(z: pd.Series) -> pd.Series:
        return z.map(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))
    return below(z)


def p_chi_squared(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-squared distribution with whole degrees of freedom (finite sums for odd and even)."""
    @F.pandas_udf("double")
    def tail(x: pd.Series, k: pd.Series) -> pd.Series:
        def one(x, k):
            half, odd = x / 2, k % 2
            total = math.erfc(math.sqrt(half)) if odd else 0.0
            for i in range(k // 2):
                s = i + 0.5 * odd
                total += math.exp(s * math.log(half) - half - math.lgamma(s + 1)) if half > 0 else float(s == 0)
            return min(1.0, total)
        return pd.Series([one(float(a), int(b)) for a, b in zip(x, k)])
    return tail(statistic, dof)


def p_student(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t: Simpson's rule over the density after x = tan(u) sqrt(dof)."""
    @F.pandas_udf("double")
    def two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
        def one(t, v):
            # P(|T| > t) is proportional to the integral of cos(u)^(v-1) from atan(t/sqrt(v)) to pi/2
            start, steps = math.atan(abs(t) / math.sqrt(v)), 4000
            scale = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(math.pi)
            width = min(math.pi / 2 - start, 40 / math.sqrt(max(v, 1.0)))
            h = width / steps
            weight = lambda i: 1 if i in (0, steps) else 4 if i % 2 else 2
            area = sum(weight(i) * max(math.cos(start + i * h), 0.0) ** (v - 1) for i in range(steps + 1))
            return min(1.0, 2 * scale * area * h / 3)
        return pd.Series([one(float(a), float(b)) if a == a and b > 0 else None for a, b in zip(t, dof)])
    return two_sided(t, dof)
