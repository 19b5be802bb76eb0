"""Tail functions of test statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(first: Column, last: Column, term) -> Column:
    """Sum of ``term(i)`` for whole numbers from first to last; 0 where there are none."""
    return F.aggregate(F.when(last >= first, F.transform(F.sequence(first, F.greatest(last, first)), term)).otherwise(F.array().cast("array<double>")), F.lit(0.0), lambda s, x: s + x)


def kolmogorov_tail(x: Column) -> Column:
    """Probability that the limit of the scaled Kolmogorov-Smirnov distance exceeds x.

    Two series of the same function: one converges at once for large values,
    the other for small ones.
    """
    one, few = F.lit(1), F.lit(8)
    far = 2.0 * _total(one, few, lambda j: F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * x * x))
    near = 1.0 - math.sqrt(2 * math.pi) / x * _total(one, few, lambda j: F.exp(-F.pow(2.0 * j - 1.0, F.lit(2)) * math.pi**2 / (8.0 * x * x)))
    return F.when(x <= 0.05, 1.0).when(x < 1.0, near).otherwise(F.greatest(far, F.lit(0.0)))


def _erfc(z: Column) -> Column:
    """Complementary error function for z >= 0: a series of positive terms, and nothing where it falls below rounding."""
    step = lambda s, n: F.struct((s["sum"] + s["term"]).alias("sum"), (s["term"] * 2.0 * z * z / (2.0 * n + 1.0)).alias("term"))
    start = F.struct(F.lit(0.0).alias("sum"), (z * F.exp(-z * z)).alias("term"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(120)), start, step, lambda s: s["sum"])
    return F.when(z > 6.0, 0.0).otherwise(F.greatest(1.0 - 2.0 / math.sqrt(math.pi) * series, F.lit(0.0)))


def chi_square_tail(x: Column, freedom: Column) -> Column:
    """Probability that a chi-square value with so many (whole) degrees of freedom exceeds x.

    The finite sums for even and odd degrees, term by term as logarithms, so
    that many degrees of freedom neither overflow nor vanish.
    """
    half, log_half, terms = x / 2.0, F.ln(x / 2.0), F.floor(freedom / 2).cast("int")
    even = freedom % 2 == 0
    # Logarithm of the first term, and what each further one adds: for even degrees i runs over 0, 1, ..., for odd ones over 1/2, 3/2, ...
    first = F.when(even, -half).otherwise(0.5 * log_half - half - math.log(math.sqrt(math.pi) / 2))
    shift = F.when(even, 0.0).otherwise(0.5)
    step = lambda s, i: F.struct((s["sum"] + F.exp(s["log"])).alias("sum"), (s["log"] + log_half - F.ln(i + shift)).alias("log"))
    start = F.struct(F.lit(0.0).alias("sum"), first.alias("log"))
    rest = F.when(terms >= 1, F.aggregate(F.sequence(F.lit(1), F.greatest(terms, F.lit(1))), start, step, lambda s: s["sum"])).otherwise(0.0)
    tail = F.when(even, rest).otherwise(_erfc(F.sqrt(half)) + rest)
    return F.when((freedom <= 0) | (x <= 0), 1.0).when(x == float("inf"), 0.0).otherwise(F.least(tail, F.lit(1.0)))
