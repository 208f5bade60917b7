"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"(\p{L}+)"

# Coefficients of formula 7.1.26 in Abramowitz & Stegun.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def sunday_week(day: Column) -> Column:
    """First day of the week a date falls in, weeks starting on Sunday."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def day_index(day: Column, step_days: int = 1) -> Column:
    """Number of whole steps since 1970-01-04, which was a Sunday."""
    return (F.datediff(day, F.lit("1970-01-04").cast("date")) / F.lit(step_days)).cast("double")


def hash_bucket(n: int, *cols: Column) -> Column:
    """Pseudo-random bucket 0..n-1, stable across runs and partitions."""
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def md5_bucket(n: int, text: Column) -> Column:
    """Bucket 0..n-1 from the first 32 bits of MD5, reproducible in other engines."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1))


def explode_once(values: Column) -> Column:
    """``explode`` for an expensive array; filter out the NULL an empty array leaves.

    A plain explode makes the optimizer add a filter on the array's size, which
    computes the array a second time, often below a repartition.
    """
    return F.explode_outer(values)


def number_list_text(values: Column) -> Column:
    """``[1,2,3]`` for an array of numbers."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ","), F.lit("]"))


def total(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for column in columns[1:]:
        out = out + column
    return out


def erf_abs(x: Column) -> Column:
    """erf(|x|) by a rational approximation with absolute error below 1.5e-7."""
    x = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + F.lit(a)) * t
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - poly * F.exp(-x * x)))


def two_sided_probability(z: Column) -> Column:
    """P(|N(0,1)| <= |z|)."""
    return erf_abs(z / F.lit(math.sqrt(2.0)))


def normal_half_width(probability: float) -> float:
    """z with P(|N(0,1)| <= z) = probability."""
    return NormalDist().inv_cdf(0.5 + probability / 2.0)
