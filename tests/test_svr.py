import numpy as np
import pytest

from pricecast.operators.svr import fit_insensitive


def lower_bound(x, y, c, epsilon, sweeps=600):
    """Value of the dual problem, solved by pairs of coordinates: no primal objective is below it."""
    n = len(y)
    k = x @ x.T
    a = np.zeros(n)
    g = -y.copy()  # gradient of the smooth part
    r = np.random.default_rng(0)
    for _ in range(sweeps):
        for i in r.permutation(n):
            j = r.integers(n)
            if i == j:
                continue
            eta = k[i, i] + k[j, j] - 2 * k[i, j] + 1e-12
            lo, hi = max(-c - a[i], a[j] - c), min(c - a[i], a[j] + c)
            at = [lo, hi, *[t for t in (-a[i], a[j]) if lo < t < hi]]
            for s1 in (-1, 1):
                for s2 in (-1, 1):
                    t = -(g[i] - g[j] + epsilon * (s1 - s2)) / eta
                    at.append(min(max(t, lo), hi))
            cost = [0.5 * eta * t * t + (g[i] - g[j]) * t + epsilon * (abs(a[i] + t) + abs(a[j] - t)) for t in at]
            t = at[int(np.argmin(cost))]
            a[i] += t
            a[j] -= t
            g += t * (k[:, i] - k[:, j])
    return y @ a - 0.5 * a @ k @ a - epsilon * np.abs(a).sum()


@pytest.mark.parametrize("c,epsilon", [(10.0, 0.01), (1.0, 0.3)])
def test_objective_is_that_of_an_exact_solver(spark, c, epsilon):
    r = np.random.default_rng(4)
    rows, want = [], {}
    for name in ("p", "q"):
        x = r.normal(size=(60, 4))
        y = x @ [1.0, -2.0, 0.5, 0.0] + 7 + r.standard_t(2, 60) * 0.5
        want[name] = (x, y, lower_bound(x, y, c, epsilon))
        rows += [(name, a.tolist(), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "series_id string, x array<double>, y double").repartition(3)
    for f in fit_insensitive(df, 4, c, epsilon).collect():
        x, y, best = want[f.series_id]
        beta = np.array(f.beta)
        got = 0.5 * beta[1:] @ beta[1:] + c * np.maximum(0, np.abs(y - x @ beta[1:] - beta[0]) - epsilon).sum()
        assert best * (1 - 1e-9) <= got <= best * 1.01
        assert got <= f.objective * 1.0001


def test_errors_inside_the_tube_cost_nothing(spark):
    """Data on a band narrower than the tube: no loss is counted, and the slope shrinks although least squares fits exactly."""
    x = np.linspace(-1, 1, 41)
    y = 5 + 0.05 * x
    df = spark.createDataFrame([("s", [float(a)], float(b)) for a, b in zip(x, y)], "series_id string, x array<double>, y double")
    few, more = (fit_insensitive(df, 1, 0.1, 0.2, passes=n, tolerance=0.0).first() for n in (4, 12))
    assert 0 < more.beta[1] < few.beta[1] < 0.05
    for f in (few, more):
        assert np.abs(y - f.beta[0] - f.beta[1] * x).max() < 0.2
        assert 0.5 * f.beta[1] ** 2 <= f.objective < 0.5 * 0.05**2
