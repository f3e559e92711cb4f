import numpy as np
import pytest
from pyspark.sql import functions as F

from pricecast.config import SEARCH_SPACES, ResearchConfig, SelectionConfig, feature_names
from pricecast.operators import evaluate as ev
from pricecast.operators import forecast as fc
from pricecast.operators import gram, ranking, regress, splits
from pricecast.operators.features import feature_table

N = 60  # test rows


@pytest.fixture(scope="module")
def split(panel):
    return splits.holdout(panel, N).cache()


@pytest.fixture(scope="module")
def table(panel):
    return splits.holdout(feature_table(panel), N).cache()


def arrays(prices, name="a"):
    return prices[prices.series_id == name].price.to_numpy()


def by_series(df, name="a", c="predicted"):
    pdf = df.where(F.col("series_id") == name).orderBy("date").toPandas()
    return pdf[c].to_numpy(float)


def test_folds_are_ordered_and_disjoint(split):
    rows = splits.walk_forward(split.where("split = 'train'"), 5).groupBy("series_id", "fold", "role").agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("*").alias("n")
    ).collect()
    at = {(r.series_id, r.fold, r.role): r for r in rows}
    for f in range(5):
        assert at["a", f, "train"].hi < at["a", f, "test"].lo
        assert at["a", f, "test"].n == 360 // 6
        assert f == 0 or at["a", f, "test"].lo > at["a", f - 1, "test"].hi


def test_draws():
    draws = splits.draw_params(SEARCH_SPACES["random_forest"], 10, 42)
    assert len({str(d) for d in draws}) == 10
    assert len(splits.draw_params({"x": [1, 2]}, 10, 1)) == 2
    assert abs(SEARCH_SPACES["ridge"]["alpha"][-1] - 1000.0) < 1e-9


def closed_form(x, y, alpha):
    mean, std = x.mean(0), x.std(0)
    z = (x - mean) / np.where(std == 0, 1, std)
    b = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return lambda q: y.mean() + ((q - mean) / np.where(std == 0, 1, std)) @ b


def test_ridge_equals_closed_form_and_mllib(table):
    names = ["price_lag_1", "price_roll_mean_7", "price_return_1", "open"]
    alpha = 0.2196385372416547
    both, report, final = regress.train_model(table, names, "ridge", {"alpha": alpha})
    pdf = table.where("series_id = 'a'").orderBy("date").toPandas()
    tr, te = pdf[pdf.split == "train"], pdf[pdf.split == "test"]
    want = closed_form(tr[names].to_numpy(float), tr.price.to_numpy(), alpha)(te[names].to_numpy(float))
    np.testing.assert_allclose(by_series(both.where("split = 'test'")), want, rtol=1e-8)
    one = table.where("series_id = 'a' AND split = 'train'")
    model = regress.ridge_pipeline(names, alpha, len(tr), float(tr.price.std(ddof=0))).fit(one)
    got = by_series(model.transform(table.where("split = 'test'")), c="prediction")
    np.testing.assert_allclose(got, want, rtol=1e-7)
    row = report.first()
    assert row.selection_mode == "fixed_params" and row.test_rows == N and row.test_r2 > 0.9
    assert final.count() == 2


def test_constant_columns_have_no_weight(table):
    columns = {"c1": F.lit(0.1), "c2": F.lit(2023.0), "c3": F.lit(987654.3)}
    fitted = gram.ridge_fit(table.where("split = 'train'").withColumns(columns), ["price_lag_1", *columns], 0.2196)
    plain = {r.series_id: r.beta for r in gram.ridge_fit(table.where("split = 'train'"), ["price_lag_1"], 0.2196).collect()}
    for r in fitted.collect():
        assert r.beta[2:] == [0.0, 0.0, 0.0]
        np.testing.assert_allclose(r.beta[:2], plain[r.series_id], rtol=1e-9)


def test_penalty_and_report_are_per_series(table):
    both, report, _ = regress.train_model(table, ["price_lag_1", "vol"], "ridge", None, n_iter=8, k=3)
    rows = {r.series_id: r for r in report.collect()}
    scores = gram.ridge_cv(table.where("split = 'train'"), ["price_lag_1", "vol"], [d["alpha"] for d in splits.draw_params(SEARCH_SPACES["ridge"], 8, 42)], 3)
    for r in gram.best_alpha(scores).collect():
        assert float(rows[r.series_id].best_params["alpha"]) == r.alpha
    pdf = both.where("split = 'test' AND series_id = 'b'").toPandas()
    assert abs(rows["b"].test_rmse - np.sqrt(((pdf.actual - pdf.predicted) ** 2).mean())) < 1e-9


def test_ridge_search(table):
    names = ["price_lag_1", "price_roll_mean_7"]
    train = table.where("split = 'train'")
    scores = gram.ridge_cv(train, names, [0.01, 10.0], 3).where("series_id = 'a'").toPandas()
    pdf = train.where("series_id = 'a'").orderBy("date").toPandas()
    n, ts = len(pdf), len(pdf) // 4
    for _, s in scores.iterrows():
        start = n - (3 - int(s.fold)) * ts
        a, b = pdf.iloc[:start], pdf.iloc[start : start + ts]
        p = closed_form(a[names].to_numpy(float), a.price.to_numpy(), s.alpha)(b[names].to_numpy(float))
        assert abs(np.sqrt(((b.price - p) ** 2).mean()) - s.rmse) < 1e-6
    assert gram.best_alpha(gram.ridge_cv(train, names, [0.01, 10.0], 3)).count() == 2
    _, report, _ = regress.train_model(table, names, "ridge", None, n_iter=5, k=3)
    assert report.first().selection_mode == "random_search"


def test_autoregression(split, prices):
    y = arrays(prices)
    d, n, p = np.diff(y), len(y) - N, 5
    x = np.column_stack([d[p - k : len(d) - k] for k in range(1, p + 1)])
    phi = np.linalg.lstsq(x[: n - 1 - p], d[p : n - 1], rcond=None)[0]
    want = y[n - 1 : -1] + np.array([phi @ d[i - 2 : i - 2 - p : -1] for i in range(n, len(y))])
    np.testing.assert_allclose(by_series(fc.ar_forecast(split, 5)), want, rtol=1e-10)
    alone = fc.ar_forecast(split.where("series_id = 'a'"), 5)
    np.testing.assert_allclose(by_series(alone), want, rtol=1e-10)
    general = fc.arima_forecast(split, (5, 2, 0)), fc.arima_forecast(split, (1, 1, 1)), fc.arima_forecast(split, (2, 0, 0))
    for g in general:
        assert g.count() == 2 * N and ev.metrics(g).where("rmse < 30").count() == 2


def test_flat_series_falls_back(spark):
    rows = [("f", i, 5.0, "train" if i < 40 else "test") for i in range(50)]
    df = spark.createDataFrame(rows, "series_id string, i int, price double, split string")
    df = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i"))).drop("i")
    assert {r.predicted for r in fc.ar_forecast(df, 2).collect()} == {5.0}


def test_flat_series_stays_in_the_residual_panel(spark):
    rows = [("f", i, 5.0, "train" if i < 40 else "test") for i in range(50)]
    df = spark.createDataFrame(rows, "series_id string, i int, price double, split string")
    df = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i"))).drop("i")
    panel = fc.residual_panel(df, 2, 5)
    assert panel.where("split = 'test'").count() == 10 and {r.ar for r in panel.collect()} == {5.0}


def test_damped_trend(split, prices):
    y = arrays(prices)
    grid = fc.damped_grid(4, 3, 2)
    sse, states, want = np.zeros(len(grid)), [(y[0], y[1] - y[0])] * len(grid), []
    for t in range(1, len(y)):
        ahead = [l + p * b for (l, b), (_, _, p) in zip(states, grid)]
        want.append(ahead[int(np.argmin(sse))])
        new = []
        for i, ((l, b), (al, be, ph)) in enumerate(zip(states, grid)):
            sse[i] += (y[t] - ahead[i]) ** 2
            level = al * y[t] + (1 - al) * ahead[i]
            new.append((level, be * (level - l) + (1 - be) * ph * b))
        states = new
    np.testing.assert_allclose(by_series(fc.damped_trend_forecast(split, grid)), want[-N:], rtol=1e-10)


def test_trees_kernel_and_hybrids(split):
    lags = (1, 2, 3)
    matrix = regress.scaled_lags(split, lags)
    naive_like = 3 * split.agg(F.stddev("price")).first()[0]
    small = {"n_estimators": 5, "max_depth": 3}
    for family in ("random_forest", "gradient_boosting", "extra_trees"):
        m = ev.metrics(regress.tree_forecast(matrix, lags, family, small, family)).collect()
        assert len(m) == 2 and all(r.rmse < naive_like for r in m)
    with pytest.raises(ValueError):
        regress.learner("unknown")
    assert ev.metrics(regress.kernel_forecast(split, lags, components=50)).where("r2 > 0").count() >= 1
    out, weights = fc.hybrid_inverse_rmse(split, lags, 2, small)
    assert out.count() == 2 * N
    assert all(abs(r[0] - 1) < 1e-9 for r in weights.groupBy("series_id").agg(F.sum("weight")).select("sum(weight)").collect())


def test_residual_hybrid(split):
    cfg = ResearchConfig(ar_order=(2, 1, 0), sequence_length=10)
    out, model, panel, history = fc.hybrid_residual(split, cfg, {"n_estimators": 4, "max_depth": 2})
    rows = out.collect()
    assert len(rows) == 2 * N
    assert all(abs(r.predicted - r.ar_predicted - r.residual_predicted) < 1e-9 for r in rows)
    h = history.collect()
    assert sum(r.is_best for r in h) == 1 and min(r.val_loss for r in h) == [r.val_loss for r in h if r.is_best][0]
    steps = fc.residual_steps(model, panel.where("split = 'test'"), 3)
    assert steps.count() == 2 * N * 3
    first = steps.where("step = 1").withColumnRenamed("residual_predicted", "again").join(out, ["series_id", "date"])
    assert first.agg(F.max(F.abs(F.col("again") - F.col("residual_predicted")))).first()[0] < 1e-9


def test_ranking(table):
    train = table.where("split = 'train'")
    names = ["price_lag_1", "open", "vol", "day_of_week"]
    ranked = ranking.rank_features(train, names, SelectionConfig(method="f_regression")).where("series_id = 'a'").orderBy("rank").collect()
    assert ranked[0].feature == "open" and ranked[0].score >= 1e10
    assert [r.score for r in ranked if r.feature == "vol"] == [0.0]  # constant
    cfg = SelectionConfig(method="f_regression", top_k=1, mandatory_features=("vol", "open"))
    chosen = ranking.select_features(ranking.rank_features(train, names, cfg), cfg).where("series_id = 'a'").orderBy("selected_position")
    assert [r.feature for r in chosen.collect()] == ["open", "vol"]
    none = ranking.rank_features(train, names, SelectionConfig(method="none")).where("series_id = 'a'").orderBy("rank")
    assert [r.feature for r in none.collect()] == names
    with pytest.raises(ValueError):
        ranking.rank_features(train, names, SelectionConfig(method="other"))
    forest = ranking.forest_importance(train, names, cfg=SelectionConfig(n_estimators=5), max_depth=4)
    assert abs(forest.agg(F.sum("score")).first()[0] - 1) < 1e-9
    assert len(feature_names()) == 37


def test_metric_rules(spark):
    rows = [("s", "m", 2.0, 2.5), ("s", "m", 2.0, 1.5), ("z", "m", 0.0, 1.0)]
    long = spark.createDataFrame(rows, "series_id string, model string, actual double, predicted double")
    train = {r.series_id: r for r in ev.metrics(long).collect()}
    gate = {r.series_id: r for r in ev.metrics(long, constant_is_perfect=True).collect()}
    assert train["s"].r2 == 0.0 and gate["s"].r2 == 1.0
    assert abs(train["z"].mape - 1e8) < 1
    d = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.5, 1.0)], "a double, b double")
    assert [r[0] for r in d.select(ev.drift_pct(F.col("a"), F.col("b"))).collect()] == [0.0, float("inf"), 50.0]


def test_short_series_are_rejected(panel, spark):
    short = panel.where("series_id = 'a' OR date < '2020-02-01'")
    kept, rejected = splits.guard_length(short, 100)
    assert kept.select("series_id").distinct().count() == 1 and [r.series_id for r in rejected.collect()] == ["b"]
    with pytest.raises(ValueError):
        splits.require_any(splits.guard_length(panel, 10_000)[0], 10_000)


def test_deployed_trees_score_in_prices(spark, table, tmp_path):
    from pricecast.operators import score as sc
    from pricecast.sources import files

    names = ["price_lag_1", "price_roll_mean_7"]
    both, report, final = regress.train_model(table, names, "random_forest", {"n_estimators": 5, "max_depth": 4})
    assert {r.series_id for r in report.collect()} == {"a", "b"}
    positions = spark.createDataFrame(list(enumerate(names)), "position int, feature string")
    files.save_bundle(final, str(tmp_path), positions)
    bundle = files.load_bundle(spark, str(tmp_path))
    asked = table.where("split = 'test'").select("series_id", "date", *names)
    asked = asked.unionByName(asked.limit(1).withColumn("series_id", F.lit("z")))
    rows = sc.score_with_bundle(asked, bundle)
    assert rows.where("series_id = 'z' AND prediction IS NULL AND reason IS NOT NULL").count() == 1
    near = rows.join(table.select("series_id", "date", "price"), ["series_id", "date"])
    assert near.count() == 2 * N
    level = {r.series_id: r.e / r.p for r in near.groupBy("series_id").agg(F.avg(F.abs(F.col("prediction") - F.col("price"))).alias("e"), F.avg("price").alias("p")).collect()}
    assert all(v < 0.25 for v in level.values())


def test_one_bad_series_blocks_production(spark):
    from pricecast.operators import governance as gov

    rows = [("ridge", "a", 0.1, 0.001, 0.999, 0.1, 0.001, 0.999), ("ridge", "b", 0.1, 0.5, -0.03, 0.1, 0.5, -0.03)]
    names = "family string, series_id string, test_rmse double, test_mape double, test_r2 double, staging_rmse double, staging_mape double, staging_r2 double"
    df = spark.createDataFrame(rows, names).withColumn("test_mae", F.lit(0.1))
    judged = gov.staging_gate(gov.testing_gate(gov.with_metric_defaults(df)))
    one = gov.lifecycle(gov.over_series(judged, ["family"])).first()
    assert one.n_series == 2 and not one.testing_passed and one.final_state == "testing" and one.test_r2 == -0.03


def test_ridge_sums_need_no_window(table):
    """Rows reach the sums of products without being sorted by series."""
    plan = gram.gram(table, ["open", "price_lag_1"], "price", ["series_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_shift" in plan and not any("Window" in line and "_z" in line for line in plan.splitlines())
