"""Queries on splits, feature ranking, regressors and forecasters, at the library's sizes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricecast.config import SEARCH_SPACES, ExperimentConfig, ResearchConfig, SelectionConfig, feature_names
from pricecast.functions.numeric import zscore
from pricecast.operators import forecast as fc
from pricecast.operators import governance as gov
from pricecast.operators import gram, ranking, regress, splits
from pricecast.plans import frames
from pricecast.plans.catalog import query, r, rounded
from pricecast.plans.oracle import CTES, RECURSIVE, add_differences, add_least_squares, add_ridge, add_ridge_search, add_smoothing, sql
from pricecast.session import materialise

LAGS = ResearchConfig().lags
SEARCH_FOLDS, SEARCH_DRAWS = ExperimentConfig().cv_splits, ExperimentConfig().n_iter_per_model

# fold i of k tests rows [n - (k-i)*ts, +ts) and trains on all rows before.
FOLDS = """SELECT c.*, f.fold, CASE WHEN pos >= cn - (5 - f.fold) * (cn // 6) THEN 'test' ELSE 'train' END AS role FROM
(SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS cn
FROM complete WHERE split = 'train') c CROSS JOIN range(5) f(fold) WHERE pos < cn - (5 - f.fold) * (cn // 6) + (cn // 6)"""


def _train(spark, folder):
    return frames.complete_rows(spark, folder).where(F.col("split") == "train")


@query(
    "walk_forward_folds",
    sql(
        f"SELECT series_id, fold, role, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date FROM ({FOLDS}) GROUP BY ALL",
        "complete",
    ),
)
def _walk_forward_folds(spark, folder):
    df = splits.walk_forward(_train(spark, folder), 5).groupBy("series_id", F.col("fold").cast("long").alias("fold"), "role")
    return df.agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query(
    "fold_mean_metric",
    sql(
        f"""SELECT series_id, model, round(avg(rmse), 4) + 0.0 AS cv_rmse FROM (SELECT series_id, fold, model,
        sqrt(avg((price - p) * (price - p))) AS rmse FROM (SELECT series_id, fold, price, price_lag_1, price_roll_mean_7 FROM ({FOLDS})
        WHERE role = 'test') UNPIVOT (p FOR model IN (price_lag_1, price_roll_mean_7)) GROUP BY ALL) GROUP BY ALL""",
        "complete",
    ),
)
def _fold_mean_metric(spark, folder):
    from pricecast.operators.evaluate import metrics, to_long

    test = splits.walk_forward(_train(spark, folder), 5).where(F.col("role") == "test")
    keyed = test.withColumn("series_id", F.struct("series_id", "fold"))
    long = to_long(keyed, {"price_lag_1": "price_lag_1", "price_roll_mean_7": "price_roll_mean_7"})
    folds = metrics(long).select(F.col("series_id.series_id").alias("series_id"), "model", "rmse")
    return rounded(gram.fold_means(folds, ("series_id", "model")))


@query(
    "tail_validation",
    sql(
        """SELECT series_id, vn - pos <= CASE WHEN vn - greatest(1, floor(vn * 0.15)) < 8 THEN greatest(1, vn // 5)
        ELSE greatest(1, floor(vn * 0.15)) END AS is_validation, count(*) AS n_rows FROM (SELECT series_id,
        row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS vn
        FROM complete WHERE split = 'train') GROUP BY ALL""",
        "complete",
    ),
)
def _tail_validation(spark, folder):
    df = splits.tail_validation(_train(spark, folder), 0.15)
    return df.groupBy("series_id", "is_validation").agg(F.count("*").alias("n_rows"))


@query(
    "weight_window",
    sql(
        """SELECT series_id, split, count(*) AS n_rows FROM (SELECT series_id, CASE WHEN vn - pos <= greatest(40, least(200, vn // 5))
        THEN 'test' ELSE 'train' END AS split FROM (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS pos,
        count(*) OVER (PARTITION BY series_id) AS vn FROM rets WHERE split = 'train')) GROUP BY ALL""",
        "rets",
    ),
)
def _weight_window(spark, folder):
    df = fc.validation_split(frames.split_bars(spark, folder))
    return df.groupBy("series_id", "split").agg(F.count("*").alias("n_rows"))


@query(
    "zscore_train",
    sql(
        """SELECT series_id, date, split, round((price - m) / CASE WHEN s < 1e-8 THEN 1.0 ELSE s END, 8) + 0.0 AS z FROM rets
        JOIN (SELECT series_id, avg(price) AS m, stddev_pop(price) AS s FROM rets WHERE split = 'train' GROUP BY series_id) USING (series_id)""",
        "rets",
    ),
)
def _zscore_train(spark, folder):
    df = frames.split_bars(spark, folder)
    of_train = F.when(F.col("split") == "train", F.col("price"))
    whole = Window.partitionBy("series_id")
    z = zscore(F.col("price"), F.avg(of_train).over(whole), F.stddev_pop(of_train).over(whole))
    return rounded(df.select("series_id", "date", "split", z.alias("z")), 8)


@query(
    "train_test_union",
    sql(
        """SELECT series_id, date, round(price / lag(price) OVER (PARTITION BY series_id ORDER BY date) - 1, 8) + 0.0 AS ret
        FROM rets WHERE n - rn <= 252""",
        "rets",
    ),
)
def _train_test_union(spark, folder):
    """The last train row put in front of the test rows, so the first test return exists."""
    from pricecast.operators.windows import pct_change_column

    df = frames.split_bars(spark, folder)
    last = df.where(F.col("split") == "train").groupBy("series_id").agg(F.max("date").alias("date"), F.max_by("price", "date").alias("price"))
    bridge = last.unionByName(df.where(F.col("split") == "test").select("series_id", "date", "price"))
    return rounded(bridge.select("series_id", "date", pct_change_column("price", 1).alias("ret")), 8)


def _scores_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT series_id, CAST({i} AS BIGINT) AS position, '{f}' AS feature,
        CASE WHEN corr({f}, price) IS NULL OR isnan(corr({f}, price)) THEN 0.0
        ELSE pow(corr({f}, price), 2) / (1 - pow(corr({f}, price), 2)) * (count(*) - 2) END AS score
        FROM feature_rows WHERE split = 'train' GROUP BY series_id"""
        for i, f in enumerate(feature_names())
    )


@query("f_regression_rank", sql(f"SELECT series_id, position, feature, round(score, 4) + 0.0 AS score FROM ({_scores_sql()})", "feature_rows"))
def _f_regression_rank(spark, folder):
    return rounded(ranking.f_regression(_feature_split(spark, folder).where(F.col("split") == "train"), feature_names()))


@query(
    "select_features",
    sql(
        f""", s AS ({_scores_sql()}), k AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY round(score, 6) DESC, position) AS rank,
        list_position(['open', 'high', 'low', 'vol', 'change_pct'], feature) AS place FROM s)
        SELECT series_id, feature, row_number() OVER (PARTITION BY series_id ORDER BY CASE WHEN rank <= 12 THEN 0 ELSE 1 END,
        CASE WHEN rank <= 12 THEN rank ELSE place END) AS selected_position FROM k WHERE rank <= 12 OR place IS NOT NULL""",
        "feature_rows",
    ),
)
def _select_features(spark, folder):
    cfg = SelectionConfig(method="f_regression")
    chosen = ranking.select_features(ranking.rank_features(_feature_split(spark, folder).where(F.col("split") == "train"), feature_names(), cfg), cfg)
    return chosen.select("series_id", "feature", F.col("selected_position").cast("long").alias("selected_position"))


@query(
    "top_ranked",
    sql(
        f"""SELECT series_id, feature, row_number() OVER (PARTITION BY series_id ORDER BY round(score, 6) DESC, position) AS rank
        FROM ({_scores_sql()}) QUALIFY rank <= 20""",
        "feature_rows",
    ),
)
def _top_ranked(spark, folder):
    ranked = ranking.rank_features(_feature_split(spark, folder).where(F.col("split") == "train"), feature_names(), SelectionConfig(method="f_regression"))
    return ranked.where(F.col("rank") <= 20).select("series_id", "feature", F.col("rank").cast("long").alias("rank"))


@query("forest_importance")
def _forest_importance(spark, folder):
    table = frames.split_features(spark, folder)
    names = feature_names()
    train = F.col("split") == "train"
    scaled = regress.scale_by_series(table, ["price", *names], train).where(train)
    scores = ranking.forest_importance(materialise(scaled, "importance"), names)
    return ranking.select_features(ranking.rank(scores, ()), keys=())


ONE = ["price_lag_1"]
ALPHA = 0.2196385372416547


@query(
    "ridge_one_feature",
    sql(
        f""", m AS (SELECT series_id, avg(price_lag_1) AS mx, avg(price) AS my, stddev_pop(price_lag_1) AS sx,
        covar_pop(price, price_lag_1) AS c, count(*) AS k FROM complete WHERE split = 'train' GROUP BY series_id)
        SELECT series_id, date, price AS actual, round(my + (price_lag_1 - mx) / sx * (k * c / sx / (k + {ALPHA})), 4) + 0.0 AS predicted
        FROM complete JOIN m USING (series_id) WHERE split = 'test'""",
        "complete",
    ),
)
def _ridge_one_feature(spark, folder):
    df = frames.complete_rows(spark, folder)
    fitted = gram.ridge_fit(df.where(F.col("split") == "train"), ONE, ALPHA)
    out = gram.ridge_predict(df.where(F.col("split") == "test"), fitted, ONE)
    return rounded(out.select("series_id", "date", F.col("price").alias("actual"), "predicted"))


@query(
    "alpha_grid",
    sql(
        f""", f AS ({FOLDS}), m AS (SELECT series_id, fold, avg(price_lag_1) AS mx, avg(price) AS my, stddev_pop(price_lag_1) AS sx,
        covar_pop(price, price_lag_1) AS c, count(*) AS k FROM f WHERE role = 'train' GROUP BY series_id, fold),
        a AS (SELECT CAST(i AS BIGINT) AS alpha_no, pow(CAST(10 AS DOUBLE), -4 + CAST(7 AS DOUBLE) * i / 199) AS alpha FROM range(200) t(i)),
        e AS (SELECT f.series_id, f.fold, a.alpha_no, sqrt(avg(pow(price - my - (price_lag_1 - mx) / sx * (k * c / sx / (k + alpha)), 2))) AS rmse
        FROM f JOIN m ON m.series_id = f.series_id AND m.fold = f.fold CROSS JOIN a WHERE f.role = 'test' GROUP BY ALL)
        SELECT series_id, alpha_no, round(avg(rmse), 3) + 0.0 AS cv_rmse FROM e GROUP BY series_id, alpha_no""",
        "complete",
    ),
)
def _alpha_grid(spark, folder):
    scores = gram.ridge_cv(_train(spark, folder), ONE, SEARCH_SPACES["ridge"]["alpha"], 5)
    return rounded(gram.fold_means(scores, ("series_id", "alpha_no")), 3)


def _feature_split(spark, folder):
    return frames.split_features(spark, folder)


add_ridge("ridge_all", "feature_rows", feature_names(), ALPHA)
ALL = f"[{', '.join(f'CAST({f} AS DOUBLE)' for f in feature_names())}]"


@query(
    "ridge_forecast",
    sql(
        f"""SELECT series_id, date, 'ridge' AS model, price AS actual, round(b0 + list_dot_product(b, {ALL}), 2) + 0.0 AS predicted
        FROM feature_rows JOIN ridge_all USING (series_id) WHERE split = 'test'""",
        "feature_rows", "ridge_all",
    ),
)
def _ridge_forecast(spark, folder):
    """All 37 features with the selected penalty; test predictions."""
    both, _, _ = regress.train_model(_feature_split(spark, folder), feature_names(), "ridge", {"alpha": ALPHA})
    return rounded(both.where(F.col("split") == "test").drop("split"), 2)


@query("forest_forecast")
def _forest_forecast(spark, folder):
    matrix = regress.scaled_lags(frames.split_bars(spark, folder), LAGS)
    return rounded(regress.tree_forecast(matrix, LAGS, "random_forest", regress.FOREST_PARAMS, "random_forest"))


@query("gbt_forecast")
def _gbt_forecast(spark, folder):
    matrix = regress.scaled_lags(frames.split_bars(spark, folder), LAGS)
    return rounded(regress.tree_forecast(matrix, LAGS, "gradient_boosting", regress.BOOSTING_PARAMS, "gradient_boosting"))


@query("randomised_trees_forecast")
def _randomised_trees_forecast(spark, folder):
    matrix = regress.scaled_lags(frames.split_bars(spark, folder), LAGS)
    return rounded(regress.tree_forecast(matrix, LAGS, "extra_trees", {**regress.FOREST_PARAMS, "max_features": "sqrt"}, "extra_trees"))


@query("rff_kernel_forecast")
def _rff_kernel_forecast(spark, folder):
    return rounded(regress.kernel_forecast(frames.split_bars(spark, folder), LAGS))


@query("model_comparison")
def _model_comparison(spark, folder):
    """Every family searches its whole space on all features, with the draws and folds of the experiments."""
    table = _feature_split(spark, folder)
    board = regress.compare_models(table, feature_names(), ExperimentConfig().models, SEARCH_DRAWS, SEARCH_FOLDS, ExperimentConfig().random_state)
    return rounded(board.withColumn("best_params", F.to_json("best_params")).orderBy("test_rmse"))


PENALTIES = [d["alpha"] for d in splits.draw_params(SEARCH_SPACES["ridge"], SEARCH_DRAWS, ExperimentConfig().random_state)]
add_ridge_search("ridge_search", "feature_rows", feature_names(), PENALTIES, SEARCH_FOLDS)


@query(
    "search_to_config",
    sql(
        f"""SELECT series_id AS key, CAST(2 AS BIGINT) AS run_ts, 'ridge' AS model_name, round(arg_min(alpha, (cv_rmse, alpha_no)), 10) + 0.0 AS alpha,
        CAST({ALPHA} AS DOUBLE) AS old_alpha, round(min(cv_rmse), 3) + 0.0 AS cv_rmse, arg_min(alpha, (cv_rmse, alpha_no)) <> {ALPHA!r}::DOUBLE AS changed
        FROM ridge_search GROUP BY series_id""",
        "ridge_search",
    ),
)
def _search_to_config(spark, folder):
    """Drawn penalties searched on all features; the winner of each series joins the table of settings and changes the current ones."""
    train = _feature_split(spark, folder).where(F.col("split") == "train")
    best = gram.best_alpha(gram.ridge_cv(train, feature_names(), PENALTIES, SEARCH_FOLDS))
    params = lambda c: F.create_map(F.lit("alpha"), c.cast("string"))
    found = best.select(F.col("series_id").alias("key"), F.lit("ridge").alias("model_name"), params(F.col("alpha")).alias("params"), "cv_rmse")
    found = materialise(gov.config_rows(found, F.lit(2).cast("long")), "found")
    before = found.select("key", "model_name", params(F.lit(ALPHA)).alias("params"), F.lit(None).cast("double").alias("cv_rmse"))
    configs = gov.config_rows(before, F.lit(1).cast("long")).unionByName(found)
    current = gov.best_config(configs).join(found.select("key", "cv_rmse"), "key")
    alpha = lambda c: F.from_json(c, "map<string,string>")["alpha"].cast("double")
    return rounded(current.select("key", "run_ts", "model_name", F.round(alpha("params_json"), 10).alias("alpha"), alpha("old_params").alias("old_alpha"), "cv_rmse", "changed"), 10, cv_rmse=3, old_alpha=18)


@query(
    "ar1_diff_forecast",
    sql(
        """, d AS (SELECT series_id, date, price, split, rn, lag(price) OVER w AS before, price - lag(price) OVER w AS d FROM rets
        WINDOW w AS (PARTITION BY series_id ORDER BY date)),
        l AS (SELECT *, lag(d) OVER (PARTITION BY series_id ORDER BY date) AS d1 FROM d),
        m AS (SELECT series_id, sum(d * d1) / sum(d1 * d1) AS phi FROM l WHERE split = 'train' AND d1 IS NOT NULL GROUP BY series_id)
        SELECT series_id, date, 'arima' AS model, price AS actual, round(before + phi * d1, 4) + 0.0 AS predicted
        FROM l JOIN m USING (series_id) WHERE split = 'test'""",
        "rets",
    ),
)
def _ar1_diff_forecast(spark, folder):
    return rounded(fc.ar_forecast(frames.split_bars(spark, folder), 1).select(*fc.LONG))


add_differences("diffs", fc.LONG_ORDER)
add_least_squares("ar5", "diffs", [f"d_{k}" for k in range(1, 6)], "d")


@query(
    "ar5_diff_forecast",
    sql(
        """SELECT series_id, date, 'arima' AS model, price AS actual,
        round(before + list_dot_product(b, [d_1, d_2, d_3, d_4, d_5]), 4) + 0.0 AS predicted, false AS fallback
        FROM diffs JOIN ar5 USING (series_id) WHERE split = 'test'""",
        "diffs", "ar5",
    ),
)
def _ar5_diff_forecast(spark, folder):
    return rounded(fc.ar_forecast(frames.split_bars(spark, folder), 5))


_LONG = [f"d_{k}" for k in range(1, fc.LONG_ORDER + 1)]
add_least_squares("long_ar", "diffs", _LONG, "d")
CTES["shocks"] = (
    ("diffs", "long_ar"),
    f"""SELECT *, lag(shock) OVER (PARTITION BY series_id ORDER BY date) AS shock_1 FROM (SELECT d.*,
    CASE WHEN d_{fc.LONG_ORDER} IS NOT NULL THEN d - list_dot_product(b, [{', '.join(_LONG)}]) END AS shock FROM diffs d JOIN long_ar USING (series_id))""",
)
add_least_squares("arma", "shocks", ["d_1", "shock_1"], "d")
CTES["arma_run"] = (
    ("diffs", "arma"),
    """SELECT d.series_id, d.rn, d.date, d.split, d.price, d.d, d.d AS e FROM diffs d JOIN arma USING (series_id) WHERE rn = 2
    UNION ALL SELECT x.series_id, x.rn, x.date, x.split, x.price, x.d, x.d - m.b[1] * p.d - m.b[2] * p.e
    FROM arma_run p JOIN diffs x ON x.series_id = p.series_id AND x.rn = p.rn + 1 JOIN arma m ON m.series_id = p.series_id""",
)
RECURSIVE.add("arma_run")


@query(
    "arima_moving_average",
    sql(
        """SELECT series_id, date, 'arima' AS model, price AS actual, round(price - e, 4) + 0.0 AS predicted, false AS fallback
        FROM arma_run WHERE split = 'test'""",
        "arma_run",
    ),
)
def _arima_moving_average(spark, folder):
    return rounded(fc.arima_forecast(frames.split_bars(spark, folder), (1, 1, 1)))


@query(
    "damped_trend_fixed",
    sql(
        """, h AS (SELECT b.series_id, b.rn, b.date, b.price, a.price AS level, b.price - a.price AS trend, CAST(NULL AS DOUBLE) AS ahead
        FROM rets a JOIN rets b ON b.series_id = a.series_id AND b.rn = a.rn + 1 WHERE a.rn = 1
        UNION ALL SELECT x.series_id, x.rn, x.date, x.price, CAST(0.5 AS DOUBLE) * p.price + CAST(0.5 AS DOUBLE) * (p.level + CAST(0.9 AS DOUBLE) * p.trend),
        CAST(0.1 AS DOUBLE) * (CAST(0.5 AS DOUBLE) * p.price + CAST(0.5 AS DOUBLE) * (p.level + CAST(0.9 AS DOUBLE) * p.trend) - p.level)
        + CAST(0.9 AS DOUBLE) * CAST(0.9 AS DOUBLE) * p.trend,
        CAST(0.5 AS DOUBLE) * p.price + CAST(0.5 AS DOUBLE) * (p.level + CAST(0.9 AS DOUBLE) * p.trend)
        + CAST(0.9 AS DOUBLE) * (CAST(0.1 AS DOUBLE) * (CAST(0.5 AS DOUBLE) * p.price + CAST(0.5 AS DOUBLE) * (p.level + CAST(0.9 AS DOUBLE) * p.trend) - p.level)
        + CAST(0.9 AS DOUBLE) * CAST(0.9 AS DOUBLE) * p.trend)
        FROM h p JOIN rets x ON x.series_id = p.series_id AND x.rn = p.rn + 1)
        SELECT h.series_id, h.date, 'holt_winters' AS model, h.price AS actual, round(h.ahead, 4) + 0.0 AS predicted
        FROM h JOIN rets r ON r.series_id = h.series_id AND r.rn = h.rn WHERE r.split = 'test'""",
        "rets",
    ),
)
def _damped_trend_fixed(spark, folder):
    return rounded(fc.damped_trend_forecast(frames.split_bars(spark, folder), [(0.5, 0.1, 0.9)]))


_A, _B, _P = fc.COARSE
_LOW, _HIGH = fc.DAMPING
CTES["coarse"] = (
    ("rets",),
    f"""SELECT series_id, CAST((i * {_B} + j) * {_P} + m AS BIGINT) AS no, (CAST(i AS DOUBLE) + 0.5) / {_A} AS alpha, (CAST(j AS DOUBLE) + 0.5) / {_B} AS beta,
    CAST({_LOW} AS DOUBLE) + CAST({_HIGH - _LOW} AS DOUBLE) * m / {_P - 1} AS phi
    FROM (SELECT DISTINCT series_id FROM rets) CROSS JOIN range({_A}) a(i) CROSS JOIN range({_B}) b(j) CROSS JOIN range({_P}) c(m)""",
)
add_smoothing("coarse_run", "coarse")
_FA, _FB, _FP = fc.FINE
CTES["fine"] = (
    ("coarse_run",),
    f"""SELECT series_id, {_A * _B * _P} + CAST((i * {_FB} + j) * {_FP} + m AS BIGINT) AS no,
    alpha + CAST(1 AS DOUBLE) / {_A} * (i - {_FA // 2}) / {_FA} AS alpha, beta + CAST(1 AS DOUBLE) / {_B} * (j - {_FB // 2}) / {_FB} AS beta,
    least({_HIGH}::DOUBLE, greatest({_LOW}::DOUBLE, phi + CAST({(_HIGH - _LOW) / (_P - 1)!r} AS DOUBLE) * (m - {_FP // 2}) / {_FP})) AS phi
    FROM (SELECT * FROM coarse_run QUALIFY split = 'test' AND row_number() OVER (PARTITION BY series_id ORDER BY split = 'train', rn, sse, no) = 1)
    CROSS JOIN range({_FA}) a(i) CROSS JOIN range({_FB}) b(j) CROSS JOIN range({_FP}) c(m)""",
)
add_smoothing("fine_run", "fine")


@query(
    "damped_trend_grid",
    sql(
        """SELECT series_id, date, 'holt_winters' AS model, price AS actual, round(ahead, 4) + 0.0 AS predicted
        FROM (SELECT * FROM coarse_run UNION ALL SELECT * FROM fine_run) WHERE split = 'test'
        QUALIFY row_number() OVER (PARTITION BY series_id, rn ORDER BY sse, no) = 1""",
        "coarse_run", "fine_run",
    ),
)
def _damped_trend_grid(spark, folder):
    return rounded(fc.damped_trend_forecast(frames.split_bars(spark, folder)))


@query(
    "inverse_rmse_blend",
    sql(
        """, w AS (SELECT series_id, model, (1.0 / greatest(rmse, 1e-8)) / sum(1.0 / greatest(rmse, 1e-8)) OVER (PARTITION BY series_id) AS weight
        FROM scored) SELECT l.series_id, l.date, 'blend' AS model, l.actual, round(sum(weight * predicted), 4) + 0.0 AS predicted
        FROM long l JOIN w ON w.series_id = l.series_id AND w.model = l.model GROUP BY l.series_id, l.date, l.actual""",
        "long", "scored",
    ),
)
def _inverse_rmse_blend(spark, folder):
    long = frames.simple_forecasts(spark, folder)
    return rounded(fc.combine(long, fc.inverse_rmse_weights(long), "blend"))


@query("hybrid_inverse_rmse")
def _hybrid_inverse_rmse(spark, folder):
    out, _ = fc.hybrid_inverse_rmse(frames.split_bars(spark, folder), LAGS)
    return rounded(out)


@query("hybrid_residual")
def _hybrid_residual(spark, folder):
    out, _, _, _ = fc.hybrid_residual(frames.split_bars(spark, folder))
    return rounded(out)


@query("loss_history")
def _loss_history(spark, folder):
    return fc.hybrid_residual(frames.split_bars(spark, folder))[3]


@query("residual_multi_step")
def _residual_multi_step(spark, folder):
    _, model, panel, _ = fc.hybrid_residual(frames.split_bars(spark, folder))
    return rounded(fc.residual_steps(model, panel.where(F.col("split") == "test"), 3))
