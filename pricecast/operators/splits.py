"""Hold-out, walk-forward and validation splits by position, and parameter draws."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.operators.layout import SERIES

def _whole():
    return Window.partitionBy("series_id")


def from_end() -> Column:
    """1 for the last row of a series, 2 for the one before, and so on."""
    return F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("date").desc()))


def holdout(df: DataFrame, test_size: int) -> DataFrame:
    """Label the last ``test_size`` rows of every series ``test`` and the rest ``train``."""
    return df.withColumn("split", F.when(from_end() <= test_size, "test").otherwise("train"))


def guard_length(df: DataFrame, more_than: int) -> tuple[DataFrame, DataFrame]:
    """Rows of series with more than the given number of rows, and a table of the rejected series."""
    sized = df.withColumn("_n", F.count("*").over(_whole()))
    kept = sized.where(F.col("_n") > more_than).drop("_n")
    rejected = df.groupBy("series_id").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") <= more_than)
    return kept, rejected.withColumn("required_more_than", F.lit(more_than).cast("long"))


def require_any(kept: DataFrame, more_than: int) -> DataFrame:
    """Fail when no series is long enough; looks at one row only."""
    if kept.isEmpty():
        raise ValueError(f"Not enough data: every series has at most {more_than} rows")
    return kept


def with_fold_bounds(df: DataFrame, k: int) -> DataFrame:
    """Add ``_pos`` (0-based), ``_n`` and ``_ts``, the test length ``n div (k+1)``."""
    return df.withColumns(
        {"_pos": F.row_number().over(SERIES.window()) - 1, "_n": F.count("*").over(_whole())}
    ).withColumn("_ts", F.floor(F.col("_n") / (k + 1)))


def fold_chunk(df: DataFrame, k: int) -> DataFrame:
    """Cut each series into k+1 chunks: fold i trains on chunks 0..i and tests chunk i+1.

    Walk-forward training sets are prefixes, so additive statistics are needed once per chunk and never
    once per fold.
    """
    df = with_fold_bounds(df, k)
    start = F.col("_n") - k * F.col("_ts")
    chunk = F.when(F.col("_pos") < start, F.lit(0)).otherwise(F.floor((F.col("_pos") - start) / F.col("_ts")) + 1)
    return df.withColumn("chunk", chunk.cast("int")).drop("_pos", "_n", "_ts")


def walk_forward(df: DataFrame, k: int) -> DataFrame:
    """Every row once per fold that uses it, with ``fold`` and ``role`` (train before the test rows)."""
    chunked = fold_chunk(df, k)
    folds = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i + 1 >= F.col("chunk"))
    return (
        chunked.withColumn("fold", F.explode(folds))
        .withColumn("role", F.when(F.col("chunk") == F.col("fold") + 1, "test").otherwise("train"))
        .drop("chunk")
    )


def validation_rows(n: Column, ratio: float) -> Column:
    """Length of the validation tail: the ratio, at least 1; a fifth when fewer than 8 rows would be left."""
    count = F.greatest(F.lit(1), F.floor(n * ratio))
    return F.when(n - count < 8, F.greatest(F.lit(1), F.floor(n / 5))).otherwise(count)


def tail_validation(df: DataFrame, ratio: float) -> DataFrame:
    """Add ``is_validation`` for the tail of every series."""
    n = F.count("*").over(_whole())
    return df.withColumn("is_validation", from_end() <= validation_rows(n, ratio))


def weight_window(n: Column) -> Column:
    """Length of the window that sets hybrid weights: a fifth of the training rows, between 40 and 200."""
    return F.greatest(F.lit(40), F.least(F.lit(200), F.floor(n / 5)))


def draw_params(space: dict[str, list], n_iter: int, seed: int) -> list[dict]:
    """``n_iter`` different points of a grid, in drawn order; the whole grid when it is smaller."""
    sizes = [len(v) for v in space.values()]
    total = 1
    for s in sizes:
        total *= s
    picks = random.Random(seed).sample(range(total), min(n_iter, total))
    out = []
    for p in picks:
        point = {}
        for name, values in space.items():
            p, i = divmod(p, len(values))
            point[name] = values[i]
        out.append(point)
    return out
