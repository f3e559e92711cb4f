"""One-step forecasters on the test rows of split panels, as long prediction tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.config import ResearchConfig
from pricecast.functions.numeric import finite_or_zero, zscore, zscore_inverse
from pricecast.operators.boost import BoostedTrees, BoostParams, fit_boosting
from pricecast.operators.evaluate import err
from pricecast.operators.layout import SERIES
from pricecast.operators.regress import BOOSTING_PARAMS, scaled_lags, tree_forecast
from pricecast.operators.splits import from_end, tail_validation, weight_window
from pricecast.operators.windows import sequence_windows
from pricecast.session import materialise

LONG = ("series_id", "date", "model", "actual", "predicted")


def _is_train() -> Column:
    return F.col("split") == "train"


def last_train_price(df: DataFrame) -> DataFrame:
    """Add ``last_train``: what every forecaster falls back to."""
    last = F.max_by(F.when(_is_train(), F.col("price")), F.when(_is_train(), F.col("date")))
    return df.withColumn("last_train", last.over(Window.partitionBy("series_id")))


# Autoregression on first differences.


def with_differences(df: DataFrame, p: int) -> DataFrame:
    """Add ``price_before``, the difference ``d`` and its lags ``d_1`` .. ``d_p``."""
    w = SERIES.window()
    df = df.withColumn("price_before", F.lag("price").over(w)).withColumn("d", F.col("price") - F.col("price_before"))
    return df.withColumns({f"d_{k}": F.lag("d", k).over(w) for k in range(1, p + 1)})


def least_squares(rows: DataFrame, names: list[str], target: str) -> DataFrame:
    """``(series_id, beta)`` without a constant, from one grouped sum of products of complete rows.

    A series whose system has no solution gets a NULL ``beta``; one without complete rows gets no row.
    """
    p = len(names)
    upper = np.triu_indices(p)
    products = [F.col(names[i]) * F.col(names[j]) for i, j in zip(*upper)] + [F.col(c) * F.col(target) for c in names]

    @F.pandas_udf("array<double>")
    def solve(sums: pd.Series) -> pd.Series:
        def one(s):
            s = np.asarray(s, float)
            m = np.zeros((p, p))
            m[upper] = s[: len(upper[0])]
            m = m + m.T - np.diag(np.diag(m))
            try:
                beta = np.linalg.solve(m, s[len(upper[0]) :])
            except np.linalg.LinAlgError:
                return None
            return beta if np.isfinite(beta).all() else None

        return sums.map(one)

    complete = rows.dropna(subset=[target, *names]).select("series_id", array_to_vector(F.array(*products)).alias("_v"))
    added = Summarizer.metrics("sum").summary(F.col("_v")).getField("sum")
    sums = complete.groupBy("series_id").agg(vector_to_array(added).alias("s"))
    return sums.select("series_id", solve("s").alias("beta"))


def ar_fit(lagged: DataFrame, p: int) -> DataFrame:
    """``(series_id, phi)`` by conditional least squares without a constant; NULL where there is no solution."""
    names = [f"d_{k}" for k in range(1, p + 1)]
    return least_squares(lagged.where(_is_train()), names, "d").withColumnRenamed("beta", "phi")


def ar_predict(lagged: DataFrame, fitted: DataFrame, p: int) -> DataFrame:
    """Add ``ar``: the previous price plus weighted past differences, all from true history."""
    df = lagged.join(fitted, "series_id", "left")
    total = F.col("price_before")
    for k in range(1, p + 1):
        total = total + F.element_at("phi", k) * F.col(f"d_{k}")
    return df.withColumn("ar", total)


def _forecast_rows(df: DataFrame, predicted: Column, model_name: str) -> DataFrame:
    """Test rows in long form, with ``fallback`` where the last train price had to stand in."""
    return df.where(F.col("split") == "test").select(
        "series_id", "date", F.lit(model_name).alias("model"), F.col("price").alias("actual"),
        F.coalesce(predicted, "last_train").alias("predicted"), predicted.isNull().alias("fallback"),
    )


def ar_forecast(split: DataFrame, p: int = 5, model_name: str = "arima") -> DataFrame:
    """Fit once on train rows, forecast each test row from the rows before it. No fit: the last train price, marked ``fallback``."""
    lagged = with_differences(last_train_price(split), p)
    return _forecast_rows(ar_predict(lagged, ar_fit(lagged, p), p), F.col("ar"), model_name)


def impulse_response(theta: Column, length: int) -> Column:
    """Array ``h`` of what a shock of 1 leaves in the residuals after 0, 1, .. rows: ``h_k = -sum(theta_j h_(k-j))``."""
    def longer(h, k):
        terms = F.transform(theta, lambda t, j: F.when(j < k, t * F.element_at(h, F.greatest(k - j, F.lit(1)).cast("int"))).otherwise(0.0))
        return F.concat(h, F.array(-F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(length - 1)), F.array(F.lit(1.0)), longer)


def _blocks(rows: DataFrame, first: int, size: int, keep: dict[str, str]) -> DataFrame:
    """Rows from position ``first`` on as ``(series_id, block, v)``: at most ``size`` rows a block, in order.

    ``v`` holds structs of the position ``_rn`` and the expressions of ``keep``.
    """
    block = F.floor((F.col("_rn") - first) / size).alias("block")
    entry = F.struct("_rn", *[F.expr(e).alias(c) for c, e in keep.items()])
    return rows.where(F.col("_rn") >= first).groupBy("series_id", block).agg(F.sort_array(F.collect_list(entry)).alias("v"))


BLOCK = 256  # rows of a block of the moving-average recurrence


def moving_average_residuals(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """``(series_id, date, price, split, last_train, e)`` with ``e_t = a_t - sum(theta_k e_(t-k))``, 0 before the first row.

    ``rows`` carries ``_rn`` from 1 on, ``a`` and ``theta``. The recurrence is an affine scan over blocks: the residuals
    of a block are the convolution of its ``a`` with the impulse response, plus what the last q residuals of the block
    before leave. The ends of a series' blocks are the only thing handed from block to block.
    """
    theta = rows.groupBy("series_id").agg(F.first("theta").alias("theta"))
    theta = theta.withColumn("q", F.size("theta")).withColumn("h", impulse_response(F.col("theta"), size))
    blocks = _blocks(rows, 1, size, {c: c for c in ("date", "price", "split", "last_train", "a")}).join(theta, "series_id")

    @F.pandas_udf("array<double>")
    def convolved(a: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([np.convolve(x, y)[: len(x)] for x, y in zip(a, h)])

    blocks = materialise(blocks.withColumn("own", convolved(F.col("v.a"), "h")), "ma_blocks")

    def left_over(theta: np.ndarray, h: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
        """Effect of the residuals before a block, the nearest first, on its n rows."""
        q = len(theta)
        force = np.array([-(theta[s:] * before[: q - s]).sum() for s in range(q)])
        return np.convolve(force, h)[:n]

    @F.pandas_udf("array<array<double>>")
    def carried(ends: pd.Series, theta: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for blocks_, t, r in zip(ends, theta, h):
            before, all_ = np.zeros(len(t)), []
            for tail in blocks_:  # whole blocks but for the last
                all_.append(before)
                full = np.asarray(tail, float) + left_over(t, r, before, size)[size - len(t) :][: len(tail)]
                before = np.pad(full[::-1], (0, len(t) - len(full)))
            out.append([list(x) for x in all_])
        return pd.Series(out)

    tails = F.expr("slice(own, greatest(1, size(own) - q + 1), q)")
    ends = blocks.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("block", tails.alias("tail")))).alias("t"))
    ends = ends.join(theta, "series_id").select("series_id", F.posexplode(carried(F.col("t.tail"), "theta", "h")).alias("block", "before"))

    @F.pandas_udf("array<double>")
    def added(own: pd.Series, theta: pd.Series, h: pd.Series, before: pd.Series) -> pd.Series:
        return pd.Series([x + left_over(t, r, b, len(x)) for x, t, r, b in zip(own, theta, h, before)])

    whole = blocks.join(ends, ["series_id", "block"]).withColumn("e", added("own", "theta", "h", "before"))
    out = whole.select("series_id", F.explode(F.arrays_zip("v", "e")).alias("z"))
    return out.select("series_id", *[F.col(f"z.v.{c}").alias(c) for c in ("date", "price", "split", "last_train")], "z.e")


LONG_ORDER = 20  # of the autoregression whose residuals stand in for the shocks


def arima_forecast(split: DataFrame, order: tuple[int, int, int], model_name: str = "arima", long_order: int = LONG_ORDER) -> DataFrame:
    """One-step forecasts of any (p, d, q), with ``fallback`` where a series has no fit and the last train price stands in.

    With a moving-average part the coefficients come from two least-squares steps by grouped sums: the residuals of an
    autoregression of ``long_order`` stand in for the shocks, whatever the length of the series. Then the residuals run
    over all rows, and the error of the differenced series is the error of the level.
    """
    p, d, q = order
    if d == 1 and q == 0 and p > 0:
        return ar_forecast(split, p, model_name)
    if p + q == 0:
        raise ValueError("an order needs p or q")
    w = SERIES.window()
    df = last_train_price(split.select("series_id", "date", "price", "split"))
    if d:
        df = df.withColumn("w", F.col("price"))
        for _ in range(d):
            df = df.withColumn("w", F.col("w") - F.lag("w").over(w))
    else:
        mean = F.avg(F.when(_is_train(), F.col("price"))).over(Window.partitionBy("series_id"))
        df = df.withColumn("w", F.col("price") - mean)
    df = df.withColumns({f"w_{k}": F.lag("w", k).over(w) for k in range(1, max(p, long_order if q else 0) + 1)})
    names = [f"w_{k}" for k in range(1, p + 1)]
    if q:
        long = [f"w_{k}" for k in range(1, long_order + 1)]
        fit = least_squares(df.where(_is_train()), long, "w").withColumnRenamed("beta", "_long")
        df = materialise(df.join(fit, "series_id", "left"), "ma_shocks")
        shock = F.col("w")
        for k, c in enumerate(long):
            shock = shock - F.element_at("_long", k + 1) * F.col(c)
        df = df.withColumn("_shock", shock)
        df = df.withColumns({f"_shock_{k}": F.lag("_shock", k).over(w) for k in range(1, q + 1)})
        names = names + [f"_shock_{k}" for k in range(1, q + 1)]
    fit = least_squares(df.where(_is_train()), names, "w")
    df = df.join(fit, "series_id", "left").withColumn("_rn", F.row_number().over(w) - F.lit(d))
    a = F.col("w")
    for k in range(1, p + 1):
        a = a - F.element_at("beta", k) * F.coalesce(f"w_{k}", F.lit(0.0))
    if not q:
        return _forecast_rows(df, F.col("price") - a, model_name)
    fitted = df.where(F.col("beta").isNotNull()).withColumns({"a": a, "theta": F.slice("beta", p + 1, q)})
    predicted = _forecast_rows(moving_average_residuals(fitted), F.col("price") - F.col("e"), model_name)
    return predicted.unionByName(_forecast_rows(df.where(F.col("beta").isNull()), F.lit(None).cast("double"), model_name))


# Damped-trend exponential smoothing.

COARSE = (8, 6, 4)  # alphas, betas, phis of the first grid
FINE = (5, 5, 3)  # points around the best of it, less than a step apart
DAMPING = (0.8, 0.98)
TREND_BLOCK = 64  # rows of a block of the smoothing recurrence


def damped_grid(alphas: int = COARSE[0], betas: int = COARSE[1], phis: int = COARSE[2]) -> list[tuple[float, float, float]]:
    """Even grid of smoothing weights in (0, 1) and damping in [0.8, 0.98]."""
    return [
        ((i + 0.5) / alphas, (j + 0.5) / betas, DAMPING[0] + (DAMPING[1] - DAMPING[0]) * m / max(phis - 1, 1))
        for i in range(alphas) for j in range(betas) for m in range(phis)
    ]


def finer_grid(best: np.ndarray) -> np.ndarray:
    """Points between the neighbours of a point of the coarse grid, the damping kept in its range."""
    steps = (1 / COARSE[0], 1 / COARSE[1], (DAMPING[1] - DAMPING[0]) / (COARSE[2] - 1))
    axes = [b + s * (np.arange(n) - n // 2) / n for b, s, n in zip(best, steps, FINE)]
    axes[2] = np.clip(axes[2], *DAMPING)
    return np.stack(np.meshgrid(*axes, indexing="ij"), axis=-1).reshape(-1, 3)


class _Smoother:
    """The smoothing recurrence of many parameters over blocks, as products with powers of its 2x2 matrices.

    With the state (level, trend), ``s_t = A s_(t-1) + g y_t`` and the forecast is ``(1, phi) s_(t-1)``.
    """

    def __init__(self, flat: np.ndarray, size: int = TREND_BLOCK):
        alpha, beta, phi = flat.reshape(-1, 3).T
        a = np.empty((len(alpha), 2, 2))
        a[:, 0, 0], a[:, 0, 1] = 1 - alpha, (1 - alpha) * phi
        a[:, 1, 0], a[:, 1, 1] = -alpha * beta, phi * (1 - alpha * beta)
        g = np.stack([alpha, alpha * beta], axis=1)
        look = np.stack([np.ones_like(phi), phi], axis=1)
        powers = [np.broadcast_to(np.eye(2), a.shape)]
        for _ in range(size):
            powers.append(powers[-1] @ a)
        self.powers = np.stack(powers, axis=1)  # parameter, exponent, 2, 2
        self.gains = np.einsum("gkij,gj->gki", self.powers, g)  # what y leaves in the state k rows later
        self.ahead = np.einsum("gi,gkij->gkj", look, self.powers)  # forecast from a state k rows before
        kernel = np.einsum("gi,gki->gk", look, self.gains)
        i, j = np.indices((size, size))
        self.toeplitz = np.where(i < j, kernel[:, np.clip(j - i - 1, 0, None)], 0.0)  # forecast at j from y at i < j

    def local(self, y: np.ndarray) -> np.ndarray:
        """State after a block that starts from nothing, by parameter."""
        return np.einsum("n,gni->gi", y, self.gains[:, : len(y)][:, ::-1])

    def forecasts(self, y: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Forecasts of the rows of a block, by parameter, from the state before it."""
        n = len(y)
        return np.einsum("gki,gi->gk", self.ahead[:, :n], before) + np.einsum("n,gnm->gm", y, self.toeplitz[:, :n, :n])


_smoothers: dict[bytes, _Smoother] = {}


def _smoother(params) -> _Smoother:
    flat = np.asarray(params, float)
    key = flat.tobytes()
    if key not in _smoothers:
        _smoothers.clear()  # blocks of a series follow each other in a task
        _smoothers[key] = _Smoother(flat)
    return _smoothers[key]


def _trend_blocks(split: DataFrame) -> DataFrame:
    """Blocks of the rows from the second on, and the state after the first: its price and the first difference."""
    w = SERIES.window()
    rows = split.select("series_id", "date", "price", "split").withColumn("_rn", F.row_number().over(w))
    start = F.array(F.first("price").over(w), F.lead("price").over(w) - F.col("price"))
    starts = rows.withColumn("start", start).where("_rn = 1").select("series_id", "start")
    blocks = _blocks(rows, 2, TREND_BLOCK, {c: c for c in ("date", "price", "split")})
    return materialise(blocks.join(starts, "series_id"), "trend_blocks")


def _with_states(blocks: DataFrame) -> DataFrame:
    """Adds ``before``, the states of all parameters before each block, flat; a series hands over block ends only."""

    @F.pandas_udf("array<double>")
    def local(y: pd.Series, params: pd.Series) -> pd.Series:
        return pd.Series([_smoother(p).local(np.asarray(v, float)).ravel() for v, p in zip(y, params)])

    @F.pandas_udf("array<array<double>>")
    def carried(ends: pd.Series, start: pd.Series, params: pd.Series) -> pd.Series:
        out = []
        for tails, first, p in zip(ends, start, params):
            s = _smoother(p)
            state, states = np.tile(np.asarray(first, float), (len(s.powers), 1)), []
            for tail in tails:  # whole blocks but for the last
                states.append(state.ravel())
                state = np.einsum("gij,gj->gi", s.powers[:, TREND_BLOCK], state) + np.asarray(tail, float).reshape(-1, 2)
            out.append([list(x) for x in states])
        return pd.Series(out)

    blocks = materialise(blocks.withColumn("own", local(F.col("v.price"), "params")), "trend_ends")
    ends = blocks.groupBy("series_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "own"))).alias("t"), F.first("start").alias("start"), F.first("params").alias("params")
    )
    states = ends.select("series_id", F.posexplode(carried(F.col("t.own"), "start", "params")).alias("block", "before"))
    return materialise(blocks.drop("own").join(states, ["series_id", "block"]), "trend_states")


def _squared_errors(blocks: DataFrame, train_only: bool) -> DataFrame:
    """Adds ``sse``: the squared error of every parameter over a block, of its train rows alone if asked."""

    @F.pandas_udf("array<double>")
    def errors(y: pd.Series, split: pd.Series, before: pd.Series, params: pd.Series) -> pd.Series:
        out = []
        for v, part, b, p in zip(y, split, before, params):
            v = np.asarray(v, float)
            e = (v - _smoother(p).forecasts(v, np.asarray(b, float).reshape(-1, 2))) ** 2
            out.append(e[:, np.asarray(part) == "train"].sum(axis=1) if train_only else e.sum(axis=1))
        return pd.Series(out)

    return blocks.withColumn("sse", errors(F.col("v.price"), F.col("v.split"), "before", "params"))


def _by_least_error(blocks: DataFrame, model_name: str) -> DataFrame:
    """Forecasts of test rows by the parameters with the least squared error over all rows before each."""
    blocks = materialise(_squared_errors(blocks, False), "trend_errors")

    @F.pandas_udf("array<array<double>>")
    def running(sums: pd.Series) -> pd.Series:
        def before(s):
            own = np.stack([np.asarray(v, float) for v in s])
            return [list(x) for x in np.cumsum(own, axis=0) - own]

        return sums.map(before)

    totals = blocks.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("block", "sse"))).alias("t"))
    totals = totals.select("series_id", F.posexplode(running(F.col("t.sse"))).alias("block", "so_far"))

    @F.pandas_udf("array<double>")
    def chosen(y: pd.Series, before: pd.Series, so_far: pd.Series, params: pd.Series) -> pd.Series:
        out = []
        for v, b, z, p in zip(y, before, so_far, params):
            v = np.asarray(v, float)
            ahead = _smoother(p).forecasts(v, np.asarray(b, float).reshape(-1, 2))
            e = (v - ahead) ** 2
            error = np.asarray(z, float)[:, None] + np.cumsum(e, axis=1) - e
            out.append(ahead[error.argmin(axis=0), np.arange(len(v))])
        return pd.Series(out)

    tested = blocks.drop("sse").where(F.exists("v", lambda r: r["split"] == "test")).join(totals, ["series_id", "block"])
    rows = tested.select("series_id", F.explode(F.arrays_zip("v", chosen(F.col("v.price"), "before", "so_far", "params").alias("predicted"))).alias("z"))
    rows = rows.where(F.col("z.v.split") == "test")
    return rows.select("series_id", F.col("z.v.date").alias("date"), F.lit(model_name).alias("model"), F.col("z.v.price").alias("actual"), "z.predicted")


def damped_trend_forecast(split: DataFrame, grid: list[tuple[float, float, float]] | None = None, model_name: str = "holt_winters") -> DataFrame:
    """At every test row, the forecast of the parameters with the least squared error so far.

    Uses what a refit at every step would use, in a few passes. Level and trend start from the first two values. All
    parameters run over blocks of rows as matrix products; from block to block a series hands on states and summed
    errors only. Without a grid, a coarse one is run first, and the point with the least error on the train rows of a
    series gets finer points around it; all of them then compete. A series of one row has no forecast.
    """
    blocks = _trend_blocks(split)
    flat = [float(v) for point in (grid or damped_grid()) for v in point]
    params = F.array(*[F.lit(v) for v in flat])
    if grid:
        return _by_least_error(_with_states(blocks.withColumn("params", params)), model_name)

    @F.pandas_udf("array<double>")
    def refined(errors: pd.Series) -> pd.Series:
        coarse = np.array(flat).reshape(-1, 3)
        return pd.Series([np.concatenate([coarse, finer_grid(coarse[int(np.argmin(np.sum([np.asarray(v, float) for v in e], axis=0)))])]).ravel() for e in errors])

    tried = _squared_errors(_with_states(blocks.withColumn("params", params)), True)
    # A series brings one array of errors for each of its blocks.
    best = tried.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("block", "sse"))).alias("t"))
    best = best.select("series_id", refined(F.col("t.sse")).alias("params"))
    return _by_least_error(_with_states(blocks.join(best, "series_id")), model_name)


# Combinations.


def inverse_rmse_weights(validation: DataFrame) -> DataFrame:
    """``(series_id, model, weight)``: weights in inverse proportion to the RMSE on validation rows."""
    inverse = validation.groupBy("series_id", "model").agg(
        (1.0 / F.greatest(F.sqrt(F.avg(err() * err())), F.lit(1e-8))).alias("inverse")
    )
    total = F.sum("inverse").over(Window.partitionBy("series_id"))
    return inverse.select("series_id", "model", (F.col("inverse") / total).alias("weight"))


def combine(predictions: DataFrame, weights: DataFrame, model_name: str) -> DataFrame:
    """Weighted sum of the predictions of each day."""
    return (
        predictions.join(weights, ["series_id", "model"])
        .groupBy("series_id", "date", "actual")
        .agg(F.sum(F.col("weight") * F.col("predicted")).alias("predicted"))
        .select("series_id", "date", F.lit(model_name).alias("model"), "actual", "predicted")
    )


def validation_split(split: DataFrame) -> DataFrame:
    """Train rows alone, their tail relabelled ``test``: the window that sets hybrid weights."""
    core = split.where(_is_train())
    n = F.count("*").over(Window.partitionBy("series_id"))
    return core.withColumn("split", F.when(from_end() <= weight_window(n), "test").otherwise("train"))


def hybrid_inverse_rmse(split: DataFrame, lags, p: int = 5, params: dict | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Autoregression and boosting weighted by their validation errors: (predictions, weights)."""
    params = params or BOOSTING_PARAMS

    def both(rows: DataFrame) -> DataFrame:
        return ar_forecast(rows, p).select(*LONG).unionByName(
            tree_forecast(scaled_lags(rows, lags), lags, "gradient_boosting", params, "gradient_boosting", seed)
        )

    weights = materialise(inverse_rmse_weights(both(validation_split(split))), "weights")
    return combine(both(split), weights, "hybrid_arima_gradient_boosting"), weights


# Residual correction: a sequence learner on what the autoregression leaves over.


def residual_panel(split: DataFrame, p: int = 5, length: int = 30) -> DataFrame:
    """Rows with ``ar``, the scaled residual, the ``length`` scaled residuals before it, and the scaling.

    The first p + 1 residuals of a series do not exist and are dropped. A series whose autoregression has no solution
    stays, corrected from its last training price. Scaling uses train rows only.
    """
    lagged = with_differences(last_train_price(split), p)
    df = ar_predict(lagged, ar_fit(lagged, p), p).where(F.col(f"d_{p}").isNotNull())
    df = df.withColumn("ar", F.coalesce("ar", "last_train"))
    df = df.withColumn("residual", finite_or_zero(F.col("price") - F.col("ar")))
    whole = Window.partitionBy("series_id")
    of_train = F.when(_is_train(), F.col("residual"))
    df = df.withColumns({"r_mean": F.avg(of_train).over(whole), "r_std": F.stddev_pop(of_train).over(whole)})
    df = df.withColumn("z", zscore(F.col("residual"), F.col("r_mean"), F.col("r_std")))
    df = sequence_windows(df, "z", length)
    return df.select("series_id", "date", "split", "price", "ar", "residual", "r_mean", "r_std", "z", "sequence")


def fit_residual_learner(panel: DataFrame, cfg: ResearchConfig = ResearchConfig(), params: dict | None = None, seed: int = 42) -> BoostedTrees:
    """Boosted trees on sequences; the error on the tail of the train rows sets the best round, with ``cfg.patience``.

    Rounds, patience and validation share are those of the configuration unless ``params`` names others.
    """
    p = {"n_estimators": cfg.epochs, "patience": cfg.patience, "max_depth": 3, "learning_rate": 0.1, **(params or {})}
    train = tail_validation(panel.where(_is_train()), cfg.validation_ratio)
    return fit_boosting(train, "sequence", "z", BoostParams(**p), seed, "is_validation", cfg.sequence_length)


def hybrid_residual(split: DataFrame, cfg: ResearchConfig = ResearchConfig(), params: dict | None = None, seed: int = 42, model_name: str = "hybrid_arima_lstm"):
    """Autoregression plus predicted residual: (predictions with both parts, model, panel, loss history)."""
    panel = materialise(residual_panel(split, cfg.ar_order[0], cfg.sequence_length), "residuals")
    model = fit_residual_learner(panel, cfg, params, seed)
    scored = model.transform(panel.where(F.col("split") == "test")).withColumn("residual_predicted", zscore_inverse(F.col("prediction"), F.col("r_mean"), F.col("r_std")))
    out = scored.select(
        "series_id", "date", F.lit(model_name).alias("model"), F.col("price").alias("actual"),
        (F.col("ar") + F.col("residual_predicted")).alias("predicted"), F.col("ar").alias("ar_predicted"), "residual_predicted",
    )
    return out, model, panel, model.loss_history(split.sparkSession)


def residual_steps(model: BoostedTrees, rows: DataFrame, horizon: int) -> DataFrame:
    """``(series_id, date, step, residual_predicted)``: each step feeds its prediction back into the sequence."""
    df = rows.select("series_id", "date", "r_mean", "r_std", F.col("sequence").alias("_w"))
    for step in range(1, horizon + 1):
        df = model.transform(df, "_w").withColumnRenamed("prediction", f"_z{step}")
        df = df.withColumn("_w", F.concat(F.slice("_w", F.lit(2), F.size("_w") - 1), F.array(F.col(f"_z{step}"))))
    steps = F.array(
        *[
            F.struct(F.lit(s).alias("step"), zscore_inverse(F.col(f"_z{s}"), F.col("r_mean"), F.col("r_std")).alias("residual_predicted"))
            for s in range(1, horizon + 1)
        ]
    )
    return df.select("series_id", "date", F.explode(steps).alias("s")).select("series_id", "date", "s.*")
