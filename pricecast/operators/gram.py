"""Ridge regression from sums of products.

A fit needs only ``Z'Z`` of ``Z = [1, features, target]``. Tasks multiply their own rows with numpy and emit
one small matrix per key and Arrow batch; Spark adds the matrices up. Data is read once, whatever the number
of series, folds and penalties, and a series of any length may be spread over any number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricecast.operators.splits import fold_chunk


def gram(df: DataFrame, features: list[str] | str, target: str, keys: list[str]) -> DataFrame:
    """``(keys, g, shift)`` with ``g`` the flattened ``Z'Z`` of every key; rows with missing values are left out.

    ``features`` is a list of columns or the name of one array column. ``Z`` holds differences to ``shift``, the first
    row of the series, so the products of large or constant columns keep their digits; all keys of a series share it.
    """
    x = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    row = F.concat(x, F.array(F.col(target).cast("double")))
    narrow = df.select(*keys, *[c for c in ("date",) if c not in keys], row.alias("_z"))
    narrow = narrow.where(F.forall("_z", lambda v: v.isNotNull()))
    # One row a series, found by an aggregate that combines in the tasks: the rows themselves are not sorted by series.
    first = narrow.groupBy("series_id").agg(F.min_by("_z", "date").alias("_shift"))
    narrow = narrow.drop(*[c for c in ("date",) if c not in keys]).join(first, "series_id")

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, rows in pdf.groupby(keys, sort=False, dropna=False):
                shift = np.asarray(rows["_shift"].iloc[0], float)
                z = np.column_stack([np.ones(len(rows)), np.stack(rows["_z"].to_numpy()) - shift])
                out.append((*key, (z.T @ z).ravel(), shift))
            if out:
                yield pd.DataFrame(out, columns=[*keys, "g", "shift"])

    types = dict(narrow.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", g array<double>, shift array<double>"
    parts = narrow.mapInPandas(multiply, schema)
    added = Summarizer.metrics("sum").summary(array_to_vector("g")).getField("sum")
    return parts.groupBy(*keys).agg(vector_to_array(added).alias("g"), F.first("shift").alias("shift"))


def solve_ridge(g: np.ndarray, alpha: float, standardise: bool = True) -> np.ndarray:
    """``[intercept, coefficients]`` minimising squared error plus ``alpha`` times squared (scaled) coefficients.

    Columns are scaled by their population deviation. A constant column has the coefficient 0. NaN when there are no
    rows. The solution is in the terms of ``g``, which may be shifted.
    """
    p = g.shape[0] - 2
    n = g[0, 0]
    if n == 0:
        return np.full(p + 1, np.nan)
    mean = g[0, 1:] / n
    centred = g[1:, 1:] - n * np.outer(mean, mean)
    spread = np.maximum(np.diag(centred)[:p], 0.0)
    live = np.flatnonzero(spread > 1e-12 * np.diag(g)[1 : p + 1])
    xx, xy = centred[np.ix_(live, live)], centred[live, p]
    scale = np.sqrt(spread[live] / n) if standardise else np.ones(len(live))
    lhs = xx / np.outer(scale, scale) + alpha * np.eye(len(live))
    try:
        solved = np.linalg.solve(lhs, xy / scale)
    except np.linalg.LinAlgError:
        solved = np.linalg.lstsq(lhs, xy / scale, rcond=None)[0]
    beta = np.zeros(p)
    beta[live] = solved / scale
    return np.concatenate([[mean[p] - beta @ mean[:p]], beta])


def unshifted(solution: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The same plane in the terms of the data: only the intercept moves."""
    beta = solution[1:]
    return np.concatenate([[solution[0] + shift[-1] - beta @ shift[:-1]], beta])


def squared_error(g: np.ndarray, solution: np.ndarray) -> float:
    """Sum of squared errors of a solution on the rows behind ``g``."""
    v = np.concatenate([solution, [-1.0]])
    return float(max(v @ g @ v, 0.0))


def _square(flat) -> np.ndarray:
    size = int(round(len(flat) ** 0.5))
    return np.asarray(flat, float).reshape(size, size)


def ridge_fit(df: DataFrame, features: list[str] | str, alpha: float | DataFrame, target: str = "price", standardise: bool = True) -> DataFrame:
    """``(series_id, beta)`` with the intercept first, one row per series.

    ``alpha`` is one penalty or a table ``(series_id, alpha)``; a series that the table lacks gets no row.
    """

    @F.pandas_udf("array<double>")
    def solve(g: pd.Series, shift: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([unshifted(solve_ridge(_square(x), y, standardise), np.asarray(s, float)) for x, s, y in zip(g, shift, a)])

    sums = gram(df, features, target, ["series_id"])
    sums = sums.join(alpha, "series_id") if isinstance(alpha, DataFrame) else sums.withColumn("alpha", F.lit(float(alpha)))
    return sums.select("series_id", solve("g", "shift", F.col("alpha").cast("double")).alias("beta"))


def linear_prediction(beta: Column, features: list[str] | str) -> Column:
    """Intercept plus products, in the JVM."""
    if isinstance(features, str):
        products = F.zip_with(F.slice(beta, F.lit(2), F.size(beta) - 1), F.col(features), lambda b, x: b * x)
        return F.aggregate(products, F.element_at(beta, 1), lambda a, x: a + x)
    terms = [F.col(f).cast("double") * F.element_at(beta, i + 2) for i, f in enumerate(features)]
    total = F.element_at(beta, 1)
    for t in terms:
        total = total + t
    return total


def ridge_predict(df: DataFrame, fitted: DataFrame, features: list[str] | str, out: str = "predicted") -> DataFrame:
    """Predictions by series, NULL where a series has no fit; Spark picks the join from the table's size."""
    joined = df.join(fitted, "series_id", "left")
    return joined.withColumn(out, linear_prediction(F.col("beta"), features)).drop("beta")


def ridge_cv(df: DataFrame, features: list[str], alphas: list[float], k: int, target: str = "price") -> DataFrame:
    """Walk-forward RMSE ``(series_id, alpha_no, alpha, fold, rmse)`` of all penalties from one pass.

    Products are summed per fold chunk; training sets are prefixes of chunks, and the error on a test chunk
    follows from its own products.
    """
    size = len(features) + 2
    sums = gram(fold_chunk(df, k), features, target, ["series_id", "chunk"])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        mats = {c: _square(g) for c, g in zip(pdf["chunk"], pdf["g"])}
        rows = []
        train = np.zeros((size, size))
        for fold in range(k):
            train = train + mats.get(fold, 0.0)
            test = mats.get(fold + 1)
            if test is None or train[0, 0] == 0:
                continue
            for no, a in enumerate(alphas):
                sse = squared_error(test, solve_ridge(train, a))
                rows.append((pdf["series_id"].iloc[0], no, a, fold, float(np.sqrt(sse / test[0, 0]))))
        return pd.DataFrame(rows, columns=["series_id", "alpha_no", "alpha", "fold", "rmse"])

    schema = "series_id string, alpha_no int, alpha double, fold int, rmse double"
    # A group holds k + 1 small matrices, never rows of the panel.
    return sums.groupBy("series_id").applyInPandas(score, schema)


def fold_means(scores: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Mean fold RMSE of every candidate."""
    return scores.groupBy(*keys).agg(F.avg("rmse").alias("cv_rmse"))


def best_alpha(scores: DataFrame) -> DataFrame:
    """Penalty of lowest mean fold RMSE per series, the earlier one on ties."""
    means = fold_means(scores, ("series_id", "alpha_no", "alpha"))
    best = F.min_by(F.struct("alpha", "cv_rmse"), F.struct("cv_rmse", "alpha_no")).alias("b")
    return means.groupBy("series_id").agg(best).select("series_id", "b.alpha", "b.cv_rmse")
