"""Features of a price history held as one array per row, oldest value first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricecast.functions.numeric import TINY, pct_change


def tail(h: Column, n: int) -> Column:
    """Last n values; NULL when the array is shorter."""
    return F.when(F.size(h) >= n, F.slice(h, -n, n))


def kth_from_end(h: Column, k: int) -> Column:
    return F.when(F.size(h) >= k, F.element_at(h, -k))


def array_mean(h: Column) -> Column:
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"))
    return F.aggregate(
        h, start,
        lambda a, x: F.struct((a["total"] + x).alias("total"), (a["n"] + 1).alias("n")),
        lambda a: a["total"] / F.when(a["n"] > 0, a["n"]),
    )


def array_std(h: Column) -> Column:
    """Sample standard deviation (n - 1) by running mean and squared distance, in one pass."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(a: Column, x: Column) -> Column:
        mean = a["mean"] + (x - a["mean"]) / (a["n"] + 1)
        return F.struct(
            (a["n"] + 1).alias("n"), mean.alias("mean"), (a["m2"] + (x - a["mean"]) * (x - mean)).alias("m2")
        )

    return F.aggregate(h, start, step, lambda a: F.sqrt(a["m2"] / F.when(a["n"] > 1, a["n"] - 1)))


def array_ema(h: Column, span: int) -> Column:
    """Exponential mean seeded with the first value."""
    b = 2.0 / (span + 1)
    rest = F.slice(h, F.lit(2), F.greatest(F.size(h) - 1, F.lit(0)))
    return F.aggregate(rest, F.element_at(h, 1), lambda a, x: (1 - b) * a + b * x)


def array_returns(h: Column) -> Column:
    """One-step relative changes, one value shorter than the input."""
    steps = F.size(h) - 1
    return F.zip_with(F.slice(h, F.lit(2), steps), F.slice(h, F.lit(1), steps), pct_change)


def clamped_return(h: Column, back: int) -> Column:
    """Relative change of the last value against the one ``back`` places before it."""
    base = kth_from_end(h, back + 1)
    denominator = F.when(F.abs(base) > TINY, base).otherwise(F.lit(TINY))
    return (kth_from_end(h, 1) - base) / denominator


def has_bad_value(h: Column) -> Column:
    """Whether a value is missing, not a number or infinite."""
    return F.exists(h, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
