import numpy as np
from pyspark.sql import functions as F

from pricecast.config import SEARCH_SPACES, feature_names
from pricecast.operators import boost, regress
from pricecast.operators.splits import draw_params
from pricecast.plans import model_queries, registry


def test_model_comparison_searches_whole_spaces(spark, monkeypatch):
    """It searched 9 of 37 features, two draws, two folds and ensembles of ten trees at most."""
    asked = {}

    def fixed(table, features, family, fixed_params=None, n_iter=30, k=5, seed=42, space=None, **rest):
        asked[family] = (features, n_iter, k, space)
        return None, table.select(F.lit(1.0).alias("test_rmse"), F.create_map(F.lit("a"), F.lit("b")).alias("best_params")), None

    monkeypatch.setattr(regress, "train_model", fixed)
    monkeypatch.setattr(model_queries, "_feature_split", lambda spark, folder: spark.range(1))
    assert registry.QUERIES["model_comparison"](spark, "").count() == 4
    assert asked == {f: (feature_names(), 10, 3, SEARCH_SPACES[f]) for f in ("ridge", "random_forest", "gradient_boosting", "extra_trees")}


def test_compared_families_take_every_searched_parameter(spark, panel, monkeypatch):
    seen = []
    monkeypatch.setattr(regress, "fit_boosting", lambda train, features, label, params, seed: seen.append(params))
    for drawn in draw_params(SEARCH_SPACES["gradient_boosting"], 3, 42):
        regress.fit_compared(panel, ["open"], "gradient_boosting", drawn)
        assert {k: getattr(seen[-1], k) for k in drawn} == drawn
    _, error = regress.search_trees(panel.withColumn("split", F.lit("train")), ["open", "vol"], "extra_trees", 1, 2, space={"n_estimators": [3]}, fit=regress.fit_compared)
    assert error > 0


def test_rounds_in_a_task_equal_rounds_of_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    rows = [(*map(float, v), float(v[0] * 2 - v[1] ** 2 + e), i % 6 == 0) for i, (v, e) in enumerate(zip(x, rng.normal(0, 0.1, 600)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, held boolean").coalesce(1)
    params = boost.BoostParams(n_estimators=7, max_depth=3, subsample=0.7, min_samples_split=9, patience=3)
    own = boost.fit_boosting(df, ["a", "b", "c"], "y", params, validation="held")
    monkeypatch.setattr(boost, "ROWS_A_TASK", 300)  # two partitions: the driver adds their sums
    spread = boost.fit_boosting(df, ["a", "b", "c"], "y", params, validation="held")
    assert own.best_round == spread.best_round and len(own.trees) == len(spread.trees) > 2
    assert np.allclose([h[1:] for h in own.history], [h[1:] for h in spread.history])
    for s, t in zip(own.trees, spread.trees):
        assert (s.feature == t.feature).all() and np.allclose(s.cut, t.cut) and np.allclose(s.value, t.value)
