"""Support-vector regression: the insensitive loss by reweighted sums of products.

``max(0, |r| - eps)`` is ``(|r - eps| + |r + eps|) / 2 - eps``, and a parabola through the present residual lies above each
absolute value. So every pass solves a ridge problem with two weighted targets a row, ``y - eps`` and ``y + eps``, and the
objective never rises. A pass is one join with the small table of coefficients and one grouped sum of product matrices;
rows stay where they are, whatever the length of a series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecast.session import materialise

SHARPNESS = 0.1  # residuals nearer to the edge of the tube than this share of its width weigh no more


def _products(p: int, epsilon: float, dull: float):
    """(series_id, x, y, beta) to (series_id, v): weighted product matrices of [1, x, target], and the summed loss last.

    A NULL ``beta`` weighs all rows alike with ``y`` itself as the target: plain least squares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("series_id").to_pylist()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            betas = batch.column("beta")
            order: dict[str, list[int]] = {}
            for i, name in enumerate(names):
                order.setdefault(name, []).append(i)
            out = []
            for name, rows in order.items():
                z = np.column_stack([np.ones(len(rows)), x[rows]])
                target, weight, loss = y[rows], np.ones(len(rows)), 0.0
                beta = betas[rows[0]].as_py()
                if beta is not None:
                    r = target - z @ np.asarray(beta)
                    low, high = 1 / np.maximum(np.abs(r - epsilon), dull), 1 / np.maximum(np.abs(r + epsilon), dull)
                    weight = low + high
                    target = target + epsilon * (high - low) / weight
                    loss = np.maximum(0.0, np.abs(r) - epsilon).sum()
                both = np.column_stack([z, target]) * np.sqrt(weight)[:, None]
                out.append(np.append((both.T @ both).ravel(), loss))
            if out:
                flat = np.concatenate(out)
                offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * len(out[0]))
                yield pa.RecordBatch.from_arrays([pa.array(list(order)), pa.ListArray.from_arrays(offsets, pa.array(flat))], names=["series_id", "v"])

    return run


def fit_insensitive(rows: DataFrame, p: int, c: float, epsilon: float, passes: int = 60, tolerance: float = 1e-4) -> DataFrame:
    """``(series_id, beta, objective)`` with the intercept first: ``|w|^2 / 2 + c * sum(max(0, |y - f(x)| - epsilon))``.

    ``rows`` holds ``(series_id, x array<double> of p entries, y)``. Series are fitted side by side; passes end when no
    objective falls by more than ``tolerance`` of itself. ``objective`` is that of the solution before the last pass,
    an upper bound. The intercept is not penalised.
    """
    rows = materialise(rows.select("series_id", "x", F.col("y").cast("double").alias("y")), "svr_rows")
    width = p + 2

    def solve(first: bool):
        @F.pandas_udf("beta array<double>, objective double")
        def run(v: pd.Series, before: pd.Series) -> pd.DataFrame:
            out = []
            for flat, old in zip(v, before):
                flat = np.asarray(flat, float)
                g = flat[:-1].reshape(width, width)
                penalty = np.eye(p + 1) * (1.0 / c if first else 2.0 / c)
                penalty[0, 0] = 0.0
                beta = np.linalg.lstsq(g[:-1, :-1] + penalty, g[:-1, -1], rcond=None)[0]
                value = np.inf if old is None else 0.5 * float(np.square(np.asarray(old)[1:]).sum()) + c * flat[-1]
                out.append((beta.tolist(), value))
            return pd.DataFrame(out, columns=["beta", "objective"])

        return run

    fitted = rows.select("series_id").distinct().select("series_id", F.lit(None).cast("array<double>").alias("beta"), F.lit(float("inf")).alias("objective"))
    for number in range(passes):
        joined = rows.join(fitted, "series_id").select("series_id", "x", "y", "beta")
        sums = joined.mapInArrow(_products(p, epsilon, SHARPNESS * epsilon), "series_id string, v array<double>")
        added = vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("v")).getField("sum"))
        sums = sums.groupBy("series_id").agg(added.alias("v")).join(fitted.withColumnRenamed("objective", "was"), "series_id")
        step = materialise(sums.select("series_id", "was", solve(number == 0)("v", "beta").alias("s")).select("series_id", "was", "s.*"), "svr_pass")
        fitted = step.select("series_id", "beta", "objective")
        if number > 1 and step.agg(F.max((F.col("was") - F.col("objective")) / F.greatest("objective", F.lit(1e-12)))).first()[0] < tolerance:
            break
    return fitted
