import numpy as np
import pytest
from pyspark.sql import functions as F

from pricecast.operators import boost
from pricecast.operators.boost import BoostParams, cuts_of, fit_boosting


def table(spark, n=500, seed=0):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=n), r.integers(0, 5, n).astype(float), r.normal(size=n)])
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] + r.normal(0, 0.3, n)
    held = r.random(n) < 0.25
    rows = [(i, *map(float, a), float(b), bool(v)) for i, (a, b, v) in enumerate(zip(x, y, held))]
    return spark.createDataFrame(rows, "i long, a double, b double, c double, y double, held boolean").repartition(3), x, y, held


def brute(x, y, held, cuts, params):
    """Boosting row by row: all cuts of all features tried in every node."""
    base = y[~held].mean()
    f = np.full(len(y), base)
    history, forecasts = [], [f.copy()]
    for _ in range(params.n_estimators):
        r = y - f
        step = np.zeros(len(y))

        def split(rows, depth):
            own = rows[~held[rows]]
            step[rows] = r[own].mean()
            if depth == params.max_depth or len(own) < max(2, params.min_samples_split):
                return
            best = (1e-12, None, None)
            for j, bounds in enumerate(cuts):
                for c in bounds:
                    left = own[x[own, j] <= c]
                    right = own[x[own, j] > c]
                    if min(len(left), len(right)) < params.min_samples_leaf:
                        continue
                    gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[own].sum() ** 2 / len(own)
                    if gain > best[0] + 1e-9:
                        best = (gain, j, c)
            if best[1] is None:
                return
            split(rows[x[rows, best[1]] <= best[2]], depth + 1)
            split(rows[x[rows, best[1]] > best[2]], depth + 1)

        split(np.arange(len(y)), 0)
        f = f + params.learning_rate * step
        forecasts.append(f.copy())
        history.append((((y - f)[~held] ** 2).mean(), ((y - f)[held] ** 2).mean()))
    return history, forecasts


@pytest.mark.parametrize("few,rows", [(16, 50_000), (0, 100)])
def test_equals_row_by_row_boosting(spark, monkeypatch, few, rows):
    """Sums of few tasks are added by the driver, those of many by Spark."""
    monkeypatch.setattr(boost, "REWRITE", 4)
    monkeypatch.setattr(boost, "FEW_TASKS", few)
    monkeypatch.setattr(boost, "ROWS_A_TASK", rows)
    df, x, y, held = table(spark)
    params = BoostParams(n_estimators=10, learning_rate=0.3, max_depth=3, min_samples_leaf=4, max_bins=16)
    model = fit_boosting(df, ["a", "b", "c"], "y", params, validation="held")
    prepared = df.where("NOT held").select(F.array("a", "b", "c").alias("x"))
    history, forecasts = brute(x, y, held, cuts_of(prepared, 3, 16), params)
    np.testing.assert_allclose([h[1:] for h in model.history], history, rtol=1e-9)
    got = [r.prediction for r in model.transform(df).orderBy("i").collect()]
    np.testing.assert_allclose(got, forecasts[model.best_round], rtol=1e-9)


def test_patience_keeps_the_rounds_after_the_best(spark):
    df, x, y, held = table(spark, 160)
    noise = df.withColumn("y", F.when(F.col("held"), F.col("y")).otherwise(F.col("y") + 3 * F.sin(F.col("i") * 12.9)))
    params = BoostParams(n_estimators=40, learning_rate=0.8, max_depth=4, patience=3)
    model = fit_boosting(noise, ["a", "b", "c"], "y", params, validation="held")
    losses = [h[2] for h in model.history]
    assert len(model.history) == model.best_round + 3 < 40 and len(model.trees) == model.best_round
    assert losses[model.best_round - 1] == min(losses)
    rows = model.loss_history(spark).orderBy("epoch").collect()
    assert [r.epoch for r in rows] == list(range(1, len(losses) + 1)) and [r.epoch for r in rows if r.is_best] == [model.best_round]
    error = model.transform(noise).where("held").agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert abs(error - min(losses)) < 1e-9


def test_edges(spark):
    df, *_ = table(spark, 60)
    rounds = fit_boosting(df, ["a", "b"], "y", BoostParams(n_estimators=5, subsample=0.5))
    assert len(rounds.trees) == len(rounds.history) == 5 and rounds.history[-1][1] < rounds.history[0][1]
    flat = fit_boosting(df.withColumn("y", F.lit(2.0)), ["a"], "y", BoostParams(n_estimators=2))
    assert {r.prediction for r in flat.transform(df).collect()} == {2.0}
    hole = df.withColumn("a", F.when(F.col("i") != 1, F.col("a")))
    assert fit_boosting(hole, ["a"], "y", BoostParams(n_estimators=1)).transform(hole).where("prediction IS NULL").count() == 1
    with pytest.raises(ValueError):
        fit_boosting(df.limit(0), ["a"], "y", BoostParams())
