import numpy as np
import pytest
from pricecast.llm import mixing
from pyspark.sql import functions as F

WEIGHTS = {"en": 0.5, "de": 0.3, "fr": 0.2}


def test_rates_meet_targets_and_match_numpy(spark):
    r = np.random.default_rng(0)
    p = r.dirichlet([0.5] * 3, 200)
    n = r.integers(1, 500, 200).astype(float)
    docs = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(n, p)], "_n double, _p array<double>")
    steps, targets, reached, converged = mixing.fit_rates(docs, WEIGHTS)
    assert reached == pytest.approx(targets, rel=1e-6) and converged
    w, start = np.ones(200), (n[:, None] * p).sum(0)
    for g in steps:
        w = np.maximum(0, w - p @ np.array(g))
    rates = np.array([x.rate for x in docs.withColumn("rate", mixing.rate_column(steps)).collect()])
    assert np.allclose(rates, w) and (rates >= 0).all()
    assert (np.array(targets) >= start - 1e-6).all()
    _, targets, reached, converged = mixing.fit_rates(docs, WEIGHTS, total=float(n.sum()) / 2)
    assert reached == pytest.approx(targets, rel=1e-5) and converged


def test_mix_on_odd_rows(odd, none):
    labels = odd.select("doc_id")
    out = mixing.mix(odd, labels, WEIGHTS)
    rows = out.collect()
    assert out.select("row.*").columns == odd.columns and len(rows) == odd.count()
    assert all(r.rate >= 0 and abs(sum(r.share) - 1) < 1e-9 for r in rows)
    assert {r.n_tokens for r in rows if not (r.row.text or "").strip()} == {0}
    assert mixing.mix(none, labels, WEIGHTS).count() == 0
    assert mixing.mix(odd, none.select("doc_id"), WEIGHTS).count() == odd.count()


def test_copies_follow_rates(spark):
    got = spark.range(4000).select(mixing.copies(F.lit(1.25), F.col("id")).alias("k")).agg(F.avg("k"), F.min("k"), F.max("k")).first()
    assert abs(got[0] - 1.25) < 0.03 and got[1:] == (1, 2)


def least_miss(n, p, targets):
    """Nonnegative least squares by many plain projected gradient steps from 1."""
    a = n[:, None] * p
    scale = a.sum(0) ** 0.5
    w, z = np.ones(len(n)), a / scale
    rate = 1 / np.linalg.norm(z, 2) ** 2
    for _ in range(60_000):
        w = np.maximum(0, w - rate * z @ (w @ z - targets / scale))
    return w @ a


@pytest.mark.parametrize("low,high,share,possible", [(0.4, 0.6, 0.55, True), (0.4, 0.6, 0.59, True), (0.4, 0.6, 0.8, False), (0.0, 1.0, 0.95, True), (0.0, 1.0, 0.99, False)])
def test_soft_posteriors_reach_what_can_be_reached(spark, low, high, share, possible):
    """Documents that belong to both domains alike: targets that a mix of them can give are met, others are reported."""
    r = np.random.default_rng(3)
    first = r.uniform(low, high, 50)
    p, n = np.column_stack([first, 1 - first]), r.integers(50, 150, 50).astype(float)
    docs = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(n, p)], "_n double, _p array<double>")
    fit = mixing.fit_rates(docs, {"x": share, "y": 1 - share}, total=float(n.sum()))
    assert fit.converged == possible
    if possible:
        assert fit.reached == pytest.approx(fit.targets, rel=1e-5)
    else:
        best = least_miss(n, p, np.array(fit.targets))
        start = (n[:, None] * p).sum(0)
        error = lambda v: (np.square(np.array(v) - fit.targets) / start).sum()
        assert error(fit.reached) <= 1.001 * error(best)


def test_a_domain_without_tokens_is_reported(spark):
    docs = spark.createDataFrame([(10.0, [1.0, 0.0])], "_n double, _p array<double>")
    fit = mixing.fit_rates(docs, {"x": 0.5, "y": 0.5})
    assert not fit.converged and fit.reached[1] == 0.0
    assert mixing.fit_rates(docs.filter("1 = 0"), {"x": 1.0}).converged
