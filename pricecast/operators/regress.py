"""Regressors on lag matrices and feature tables.

Tree models are fitted once for all series of a panel on values standardised within each series by moments
of its training rows, so levels of different series are comparable; for one series this is the plain fit.
"""

from __future__ import annotations

import math
import random
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.config import SEARCH_SPACES
from pricecast.functions.numeric import clamp_denominator, zscore, zscore_inverse
from pricecast.operators.boost import BoostedTrees, BoostParams, fit_boosting
from pricecast.operators.evaluate import r2
from pricecast.operators.gram import best_alpha, ridge_cv, ridge_fit, ridge_predict
from pricecast.operators.layout import SERIES
from pricecast.operators.splits import draw_params, fold_chunk
from pricecast.operators.svr import fit_insensitive
from pricecast.operators.trees import Forest, ForestParams, grow_drawn_forest, grow_random_forest
from pricecast.session import materialise
from pricecast.sources.files import Bundle


def lag_matrix(df: DataFrame, lags, price: str = "price", keep: tuple[str, ...] = ()) -> DataFrame:
    """``y``, position ``t`` and one column per lag; rows without all lags are dropped."""
    w = SERIES.window()
    columns = [F.lag(price, k).over(w).alias(f"lag_{k}") for k in lags]
    t = (F.row_number().over(w) - 1).alias("t")
    matrix = df.select("series_id", "date", *keep, F.col(price).alias("y"), t, *columns)
    return matrix.dropna(subset=[f"lag_{k}" for k in lags])


def scale_by_series(df: DataFrame, columns: list[str], train: Column) -> DataFrame:
    """Standardise columns within each series by training moments, in place; ``<c>__mean`` and ``<c>__std`` are kept for the first."""
    whole = Window.partitionBy("series_id")
    moments = {}
    for c in columns:
        x = F.when(train, F.col(c).cast("double"))
        moments[f"{c}__mean"] = F.avg(x).over(whole)
        moments[f"{c}__std"] = F.stddev_pop(x).over(whole)
    df = df.withColumns(moments)
    df = df.withColumns({c: zscore(F.col(c), F.col(f"{c}__mean"), F.col(f"{c}__std")) for c in columns})
    spare = [f"{c}__{m}" for c in columns[1:] for m in ("mean", "std")]
    return df.drop(*spare)


def series_moments(df: DataFrame, columns: list[str], train: Column) -> DataFrame:
    """``(series_id, center, spread)``: the training moments that :func:`scale_by_series` uses, as arrays."""
    x = [F.when(train, F.col(c).cast("double")) for c in columns]
    return df.groupBy("series_id").agg(F.array(*map(F.avg, x)).alias("center"), F.array(*map(F.stddev_pop, x)).alias("spread"))


def unscale(prediction: Column, target: str) -> Column:
    return zscore_inverse(prediction, F.col(f"{target}__mean"), F.col(f"{target}__std"))


def learner(family: str, params: dict | None = None, seed: int = 42, label: str = "y"):
    """MLlib estimator of a family; ``min_samples_split`` has no counterpart there and is left aside."""
    p = dict(params or {})
    if family == "gradient_boosting":
        return GBTRegressor(
            featuresCol="features", labelCol=label, seed=seed, maxBins=256, maxMemoryInMB=512,
            maxIter=p.get("n_estimators", 100),
            stepSize=p.get("learning_rate", 0.1),
            maxDepth=p.get("max_depth", 3),
            subsamplingRate=p.get("subsample", 1.0),
            minInstancesPerNode=p.get("min_samples_leaf", 1),
        )
    raise ValueError(f"no learner is called {family!r}; there are ridge, random_forest, gradient_boosting and extra_trees")


def fit_trees(train: DataFrame, features: list[str], family: str, params: dict | None = None, seed: int = 42, label: str = "y") -> PipelineModel | Forest:
    """A model with a ``transform`` that adds ``prediction``. Extra trees draw their thresholds, the others search them."""
    if family in ("random_forest", "extra_trees"):
        grow = grow_random_forest if family == "random_forest" else grow_drawn_forest
        return grow(train, features, label, ForestParams(**(params or {})), seed)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[assembler, learner(family, params, seed, label)]).fit(train)


def fit_compared(train: DataFrame, features: list[str], family: str, params: dict | None = None, seed: int = 42, label: str = "y") -> BoostedTrees | Forest:
    """As :func:`fit_trees`; boosting keeps all searched parameters, ``min_samples_split`` too, and one task fits a small panel."""
    if family == "gradient_boosting":
        return fit_boosting(train, features, label, BoostParams(**{"max_bins": 256, **(params or {})}), seed)
    return fit_trees(train, features, family, params, seed, label)


def ridge_pipeline(features: list[str], alpha: float, n: int, target_std: float, label: str = "price") -> Pipeline:
    """The same penalty as ``alpha`` in MLlib's terms, for a single series or a pooled fit.

    ``n`` and ``target_std`` (population) are those of the training rows.
    """
    reg = LinearRegression(
        featuresCol="features", labelCol=label, elasticNetParam=0.0, solver="normal", standardization=True,
        regParam=alpha * target_std / n,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), reg])


def scaled_lags(split: DataFrame, lags) -> DataFrame:
    """Lag matrix of the standardised price with the true price beside it, written once for repeated reads."""
    df = split.withColumn("actual", F.col("price"))
    df = scale_by_series(df, ["price"], F.col("split") == "train")
    keep = ("split", "actual", "price__mean", "price__std")
    return materialise(lag_matrix(df, lags, keep=keep), "lags")


def tree_forecast(matrix: DataFrame, lags, family: str, params: dict, model_name: str, seed: int = 42) -> DataFrame:
    """Fit on train rows, one-step forecasts of test rows from true history, as a long prediction table."""
    names = [f"lag_{k}" for k in lags]
    model = fit_trees(matrix.where(F.col("split") == "train"), names, family, params, seed)
    return predictions_of(model, matrix.where(F.col("split") == "test"), model_name)


def predictions_of(model: PipelineModel | Forest | BoostedTrees, rows: DataFrame, model_name: str) -> DataFrame:
    return model.transform(rows).select(
        "series_id", "date", F.lit(model_name).alias("model"), "actual", unscale(F.col("prediction"), "price").alias("predicted")
    )


# Fixed parameters of the tree forecasters.
FOREST_PARAMS = {"n_estimators": 400, "min_samples_leaf": 2}
BOOSTING_PARAMS = {"n_estimators": 350, "learning_rate": 0.03, "max_depth": 4}


def kernel_features(x: Column, size: int, components: int, gamma: float, seed: int) -> Column:
    """Array of random cosine features of the array ``x``; their products approximate an RBF kernel of that gamma."""
    rng = random.Random(seed)
    waves = []
    for _ in range(components):
        phase = F.lit(rng.uniform(0, 2 * math.pi)).alias("phase")
        weights = F.array(*[F.lit(rng.gauss(0.0, math.sqrt(2 * gamma))) for _ in range(size)]).alias("weights")
        waves.append(F.struct(phase, weights))
    height = math.sqrt(2.0 / components)
    angle = lambda w: F.aggregate(F.zip_with(w["weights"], x, lambda a, b: a * b), w["phase"], lambda s, v: s + v)
    return F.transform(F.array(*waves), lambda w: F.lit(height) * F.cos(angle(w)))


def kernel_forecast(split: DataFrame, lags, c: float = 10.0, epsilon: float = 0.01, components: int = 100, seed: int = 42, model_name: str = "svr_rbf") -> DataFrame:
    """Support-vector regression on standardised lags, one fit per series.

    Errors up to ``epsilon``, in prices, cost nothing and larger ones ``c`` for each unit. Random features stand in for the
    RBF kernel, so nothing needs all pairs of rows; ``gamma`` is one over the number of lags.
    """
    lagged = lag_matrix(split, lags, keep=("split",)).withColumn("actual", F.col("y"))
    names = [f"lag_{k}" for k in lags]
    train = F.col("split") == "train"
    scaled = scale_by_series(lagged, names, train).withColumn("_x", F.array(*names))
    scaled = materialise(scaled.withColumn("waves", kernel_features(F.col("_x"), len(names), components, 1.0 / len(names), seed)), "waves")
    fitted = fit_insensitive(scaled.where(train).select("series_id", F.col("waves").alias("x"), "y"), components, c, epsilon)
    rows = ridge_predict(scaled.where(F.col("split") == "test"), fitted.select("series_id", "beta"), "waves", "predicted")
    return rows.select("series_id", "date", F.lit(model_name).alias("model"), "actual", "predicted")


def search_trees(train: DataFrame, features: list[str], family: str, n_iter: int, k: int, seed: int = 42, space: dict | None = None, parallelism: int = 4, fit=fit_trees) -> tuple[dict, float]:
    """Best drawn parameters and their mean walk-forward RMSE, on errors in units of each series' training deviation.

    ``train`` is unscaled: every fold is standardised by the moments of its own training rows, which are a prefix of
    chunks, so no fold sees later levels. Each fit is a Spark job over the whole panel; what returns to the driver is
    one number per draw and fold.
    """
    chunked = materialise(fold_chunk(train, k), "chunks")
    draws = draw_params(space or SEARCH_SPACES[family], n_iter, seed)
    parts = []
    for fold in range(k):
        part = chunked.where(F.col("chunk") <= fold + 1)
        scaled = scale_by_series(part, ["price", *features], F.col("chunk") <= fold)
        parts.append(materialise(scaled.drop("actual").withColumn("actual", F.col("price")), f"fold{fold}"))

    def run(task: tuple[int, int]) -> tuple[int, float]:
        no, fold = task
        model = fit(parts[fold].where(F.col("chunk") <= fold), features, family, draws[no], seed, "price")
        rows = model.transform(parts[fold].where(F.col("chunk") == fold + 1))
        return no, rows.agg(F.sqrt(F.avg((F.col("prediction") - F.col("actual")) ** 2))).first()[0]

    tasks = [(no, fold) for no in range(len(draws)) for fold in range(k)]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(run, tasks)
    mean = {no: sum(s for n, s in scores if n == no) / k for no in range(len(draws))}
    best = min(mean, key=lambda no: (mean[no], no))
    return draws[best], mean[best]


def train_model(table: DataFrame, features: list[str], family: str, fixed_params: dict | None = None, n_iter: int = 30, k: int = 5, seed: int = 42, space: dict | None = None, refit: bool = True, fit=fit_trees):
    """Search (or take fixed parameters), fit on train rows, score both parts, refit on all rows.

    ``table`` is a split feature table. Returns predictions of both parts, a report of parameters and metrics with
    a row per series (levels of different series would flatter a pooled R2), and the model refitted on everything:
    a coefficient table for ridge, for trees a pipeline with the moments of its series; None without ``refit``.
    ``fit`` grows the trees of the search and of the scores.
    """
    if family == "ridge":
        table = table.withColumn("actual", F.col("price"))
        return _train_ridge(table, features, fixed_params, n_iter, k, seed, space)
    table = table.withColumn("actual", F.col("price"))
    scaled = materialise(scale_by_series(table, ["price", *features], F.col("split") == "train"), "scaled")
    train = scaled.where(F.col("split") == "train")
    cv = None
    if fixed_params:
        params = fixed_params
    else:
        params, cv = search_trees(table.where(F.col("split") == "train"), features, family, n_iter, k, seed, space, fit=fit)
    model = fit(train, features, family, params, seed, "price")
    both = predictions_of(model, scaled, family).join(scaled.select("series_id", "date", "split"), ["series_id", "date"])
    final = None
    if refit:
        moments = series_moments(table, ["price", *features], F.col("split") == "train")
        final = Bundle(fit_trees(scaled, features, family, params, seed, "price"), features, moments)
    return both, _report(both, family, params, cv), final


def _train_ridge(table, features, fixed_params, n_iter, k, seed, space):
    """Every series gets the penalty of its own lowest mean fold RMSE, so a dear series does not choose for the others."""
    train = table.where(F.col("split") == "train")
    if fixed_params:
        alpha: float | DataFrame = float(fixed_params["alpha"])
        chosen = table.select("series_id").distinct().select("series_id", F.lit(alpha).alias("alpha"), F.lit(None).cast("double").alias("cv_rmse"))
    else:
        draws = [d["alpha"] for d in draw_params(space or SEARCH_SPACES["ridge"], n_iter, seed)]
        chosen = materialise(best_alpha(ridge_cv(train, features, draws, k)), "penalties")
        alpha = chosen.select("series_id", "alpha")
    fitted = ridge_fit(train, features, alpha)
    both = ridge_predict(table, fitted, features).select(
        "series_id", "date", F.lit("ridge").alias("model"), "actual", "predicted", "split"
    )
    final = ridge_fit(table, features, alpha)
    report = _report(both, "ridge", {}, None).drop("selection_mode", "best_cv_rmse", "best_params")
    picked = chosen.select(
        "series_id",
        F.lit("fixed_params" if fixed_params else "random_search").alias("selection_mode"),
        F.col("cv_rmse").alias("best_cv_rmse"),
        F.create_map(F.lit("alpha"), F.col("alpha").cast("string")).alias("best_params"),
    )
    return both, report.join(picked, "series_id", "left").select("series_id", "model_name", "selection_mode", "best_cv_rmse", "best_params", *[c for c in report.columns if c not in ("series_id", "model_name")]), final


def _report(both: DataFrame, family: str, params: dict, cv: float | None) -> DataFrame:
    """A row per series: parameters, mean fold RMSE, train and test metrics."""
    texts = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    columns = []
    for part in ("train", "test"):
        rows = F.col("split") == part
        actual, predicted = F.when(rows, F.col("actual")), F.when(rows, F.col("predicted"))
        e = actual - predicted
        mse = F.avg(e * e)
        columns += [
            F.sqrt(mse).alias(f"{part}_rmse"),
            F.avg(F.abs(e)).alias(f"{part}_mae"),
            F.avg(F.abs(e / clamp_denominator(actual))).alias(f"{part}_mape"),
            r2(mse, F.var_pop(actual), False).alias(f"{part}_r2"),
            F.count_if(rows).alias(f"{part}_rows"),
        ]
    return both.groupBy("series_id").agg(*columns).select(
        "series_id",
        F.lit(family).alias("model_name"),
        F.lit("fixed_params" if cv is None else "random_search").alias("selection_mode"),
        F.lit(cv).cast("double").alias("best_cv_rmse"),
        (F.create_map(*texts) if texts else F.create_map().cast("map<string,string>")).alias("best_params"),
        *[f"{p}_{m}" for p in ("train", "test") for m in ("rmse", "mae", "mape", "r2", "rows")],
    )


def compare_models(table: DataFrame, features: list[str], families, n_iter: int, k: int, seed: int = 42, spaces: dict | None = None) -> DataFrame:
    """A report row per family and series."""
    out = None
    for family in families:
        _, report, _ = train_model(table, features, family, None, n_iter, k, seed, (spaces or SEARCH_SPACES)[family], refit=False, fit=fit_compared)
        out = report if out is None else out.unionByName(report)
    return out


