"""The moving-average and damped-trend recurrences against plain loops over the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricecast.operators import forecast as fc
from pricecast.operators import splits

N = 60


@pytest.fixture(scope="module")
def split(panel):
    return splits.holdout(panel, N).cache()


def prices_of(prices, name):
    return prices[prices.series_id == name].price.to_numpy()


def by_series(df, name, c="predicted"):
    return df.where(F.col("series_id") == name).orderBy("date").toPandas()[c].to_numpy()


def arma_loop(y, order, long_order):
    """Two least-squares steps and the residuals row by row."""
    p, d, q = order
    n = len(y) - N
    w = np.concatenate([np.full(d, np.nan), np.diff(y, n=d)]) if d else y - y[:n].mean()
    past = lambda v, t, k: np.array([v[t - j] if t - j >= 0 else np.nan for j in range(1, k + 1)])
    shocks = np.full(len(y), np.nan)
    if q:
        rows = [t for t in range(n) if np.isfinite(past(w, t, long_order)).all() and np.isfinite(w[t])]
        phi = np.linalg.lstsq(np.array([past(w, t, long_order) for t in rows]), w[rows], rcond=None)[0]
        for t in range(len(y)):
            shocks[t] = w[t] - phi @ past(w, t, long_order)
    x = lambda t: np.concatenate([past(w, t, p), past(shocks, t, q)])
    rows = [t for t in range(n) if np.isfinite(x(t)).all() and np.isfinite(w[t])]
    beta = np.linalg.lstsq(np.array([x(t) for t in rows]), w[rows], rcond=None)[0]
    e = np.zeros(len(y))
    for t in range(d, len(y)):
        before = [w[t - k] if t - k >= d else 0.0 for k in range(1, p + 1)] + [e[t - k] if t - k >= d else 0.0 for k in range(1, q + 1)]
        e[t] = w[t] - beta @ before
    return (y - e)[-N:]


@pytest.mark.parametrize("order", [(1, 1, 1), (2, 1, 3), (0, 1, 2), (1, 0, 1), (2, 2, 1), (3, 2, 0), (2, 0, 0)])
def test_arima_equals_the_loop(split, prices, order, monkeypatch):
    out = fc.arima_forecast(split, order, long_order=8)
    for name in ("a", "b"):
        np.testing.assert_allclose(by_series(out, name), arma_loop(prices_of(prices, name), order, 8), rtol=1e-7)
    assert out.where("fallback").count() == 0 and out.count() == 2 * N


@pytest.mark.parametrize("size", [3, 7, 64, 1000])
def test_residuals_do_not_depend_on_the_block(spark, size):
    r = np.random.default_rng(0)
    a = r.normal(size=(2, 130))
    theta = {"u": [0.5, -0.3, 0.2], "v": [-0.9]}
    rows = [(s, i + 1, float(i), float(v), theta[s]) for s, x in zip("uv", a) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "series_id string, _rn long, price double, a double, theta array<double>")
    df = df.withColumns({"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("_rn").cast("int")), "split": F.lit("train"), "last_train": F.lit(0.0)})
    out = fc.moving_average_residuals(df, size)
    for s, x in zip("uv", a):
        t, e = theta[s], np.zeros(130)
        for i in range(130):
            e[i] = x[i] - sum(t[k] * e[i - 1 - k] for k in range(len(t)) if i - 1 - k >= 0)
        np.testing.assert_allclose(by_series(out, s, "e"), e, rtol=1e-9, atol=1e-12)


def test_short_and_flat_series_are_marked(spark):
    rows = [("flat", i, 5.0, "train" if i < 40 else "test") for i in range(50)] + [("short", i, float(i * i), "train" if i < 6 else "test") for i in range(9)]
    df = spark.createDataFrame(rows, "series_id string, i int, price double, split string")
    df = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i"))).drop("i")
    for order in ((1, 1, 1), (5, 1, 0)):
        got = {(r.series_id, r.predicted, r.fallback) for r in fc.arima_forecast(df, order).collect()}
        assert got == {("flat", 5.0, True), ("short", 25.0, True)}
    with pytest.raises(ValueError):
        fc.arima_forecast(df, (0, 1, 0))


def smooth(y, points):
    """(forecast, squared error of the rows before) by row and parameter, row by row."""
    ahead, error = np.full((len(y), len(points)), np.nan), np.zeros((len(y), len(points)))
    for i, (al, be, ph) in enumerate(points):
        level, trend, sse = y[0], y[1] - y[0], 0.0
        for t in range(1, len(y)):
            ahead[t, i], error[t, i] = level + ph * trend, sse
            sse += (y[t] - ahead[t, i]) ** 2
            new = al * y[t] + (1 - al) * ahead[t, i]
            trend = be * (new - level) + (1 - be) * ph * trend
            level = new
    return ahead, error


@pytest.mark.parametrize("block", [5, 64])
def test_damped_trend_equals_the_loop(split, prices, monkeypatch, block):
    """The coarse points, then finer ones around the best of the train rows; at each row the least error so far."""
    monkeypatch.setattr(fc, "TREND_BLOCK", block)
    coarse = np.array(fc.damped_grid(3, 2, 2))
    out = fc.damped_trend_forecast(split) if block == 64 else fc.damped_trend_forecast(split, [tuple(p) for p in coarse])
    for name in ("a", "b"):
        y = prices_of(prices, name)
        points = coarse
        if block == 64:
            points = np.array(fc.damped_grid())
            _, error = smooth(y, points)
            points = np.concatenate([points, fc.finer_grid(points[error[len(y) - N].argmin()])])
        ahead, error = smooth(y, points)
        want = ahead[np.arange(len(y)), error.argmin(axis=1)][-N:]
        np.testing.assert_allclose(by_series(out, name).astype(float), want, rtol=1e-9)


def test_one_row_has_no_trend(spark):
    df = spark.createDataFrame([("x", 1.0, "test")], "series_id string, price double, split string").withColumn("date", F.lit("2020-01-01").cast("date"))
    assert fc.damped_trend_forecast(df, [(0.5, 0.1, 0.9)]).count() == 0
