"""Guards and scalings for doubles. NULL is the only missing value: NaN is turned into NULL on entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Denominators and spreads below this count as zero: fixed value.
TINY = 1e-8
INF = float("inf")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite_or_zero(c: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == INF), F.lit(0.0)).otherwise(c)


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < INF), c)


def clamp_denominator(c: Column) -> Column:
    """Near-zero denominators become +1e-8, whatever their sign."""
    return F.when(F.abs(c) < TINY, F.lit(TINY)).otherwise(c)


def pct_change(now: Column, before: Column) -> Column:
    """``now / before - 1``; x/0 is a signed infinity and 0/0 is NULL, never an error."""
    ratio = now / F.when(before != 0, before) - 1
    at_zero = F.when(now > 0, F.lit(INF)).when(now < 0, F.lit(-INF))
    return F.when(before == 0, at_zero).otherwise(ratio)


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """Standard score with a population spread; a spread below 1e-8 counts as 1."""
    return (x - mean) / F.when(std < TINY, F.lit(1.0)).otherwise(std)


def zscore_inverse(z: Column, mean: Column, std: Column) -> Column:
    return z * F.when(std < TINY, F.lit(1.0)).otherwise(std) + mean


def is_minimised(metric_name: Column) -> Column:
    """Metrics named after an error are better when small."""
    return F.lower(metric_name).rlike("rmse|mae|mape|loss|error")


def metric_ok(value: Column, bound: float, at_most: bool) -> Column:
    """Gate test that a NaN or NULL fails (NaN sorts above every number in Spark)."""
    holds = (value <= bound) if at_most else (value >= bound)
    return F.coalesce(~F.isnan(value) & holds, F.lit(False))
