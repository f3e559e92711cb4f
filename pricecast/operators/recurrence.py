"""Linear recurrences ``y_t = a * y_(t-1) + x_t`` as windows.

Within a block of B rows, ``local_t = a^p * sum(x_i * a^-i)`` is a running sum, p being the place in the
block. A block hands ``last + a^B * (what it was handed)`` to the next one; B is chosen so that ``a^B`` is
below rounding error, which leaves two terms, while ``a^-B`` stays finite. Nothing loops over rows in
Python and no series is collected into an array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.session import materialise


def block_rows(a: float) -> int:
    """Smallest block with ``a^B`` below about 2e-16."""
    if not 0.0 < a < 1.0:
        raise ValueError("the decay must lie between 0 and 1")
    return max(16, math.ceil(36 / -math.log(a)))


def _locals(df: DataFrame, a: float, x: Column, size: int) -> DataFrame:
    place = (F.col("_rn") - 1) % size
    df = df.withColumn("_scan", F.floor((F.col("_rn") - 1) / size)).withColumn("_place", place.cast("double"))
    w = Window.partitionBy("series_id", "_scan").orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0)
    local = F.pow(F.lit(a), F.col("_place")) * F.sum(x * F.pow(F.lit(a), -F.col("_place"))).over(w)
    return df.withColumn("_local", local)


def scan_series(df: DataFrame, a: float, x: Column, out: str) -> DataFrame:
    """The recurrence on a panel in series layout; ``df`` carries ``_rn``. All windows share the series exchange."""
    size = block_rows(a)
    df = _locals(df, a, x, size)
    earlier = Window.partitionBy("series_id").orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
    at_end = F.col("_place") == size - 1
    df = df.withColumn("_last", F.last(F.when(at_end, F.col("_local")), ignorenulls=True).over(earlier))
    whole = F.col("_local") + (a**size) * F.coalesce("_last", F.lit(0.0))
    df = df.withColumn("_carry", F.last(F.when(at_end, whole), ignorenulls=True).over(earlier))
    y = F.col("_local") + F.pow(F.lit(a), F.col("_place") + 1) * F.coalesce("_carry", F.lit(0.0))
    return df.withColumn(out, y).drop("_scan", "_place", "_local", "_last", "_carry")


def scan_blocks(df: DataFrame, a: float, x: Column, out: str) -> DataFrame:
    """The recurrence on a panel of unbounded series; ``df`` carries ``_rn``.

    A block needs only the ends of the two blocks before it: every end is sent to the two blocks after it,
    summed with its weight, and joined by block number, so a series is spread over all its blocks. Rows with
    their running sums are written to the shared folder once, as both sides of the join read them.
    """
    size = block_rows(a)
    df = materialise(_locals(df, a, x, size), "scan")
    ends = df.where(F.col("_place") == size - 1)
    targets = F.array(
        *[F.struct((F.col("_scan") + k).alias("_scan"), (F.col("_local") * a ** (size * (k - 1))).alias("part")) for k in (1, 2)]
    )
    sent = ends.select("series_id", F.explode(targets).alias("t")).select("series_id", "t.*")
    carry = sent.groupBy("series_id", "_scan").agg(F.sum("part").alias("_carry"))
    y = F.col("_local") + F.pow(F.lit(a), F.col("_place") + 1) * F.coalesce("_carry", F.lit(0.0))
    return (
        df.join(carry, ["series_id", "_scan"], "left")
        .withColumn(out, y)
        .drop("_scan", "_place", "_local", "_carry")
    )


def ema(df: DataFrame, c: str, span: int, out: str, scan=scan_series) -> DataFrame:
    """Exponential mean of weight 2/(span+1), seeded with the first value of the series."""
    b = 2.0 / (span + 1)
    return scan(df, 1 - b, F.when(F.col("_rn") == 1, F.col(c)).otherwise(b * F.col(c)), out)


def ewma_variance(df: DataFrame, squared: str, seed: str, lam: float, out: str, scan=scan_series) -> DataFrame:
    """``v_t = lam * v_(t-1) + (1 - lam) * squared_t`` with ``v_0 = seed`` before the first row."""
    step = (1 - lam) * F.col(squared)
    return scan(df, lam, F.when(F.col("_rn") == 1, step + lam * F.col(seed)).otherwise(step), out)
