"""The two end-to-end flows: raw bars to a governed model, and the forecaster benchmark.

Stages meet at Parquet tables, so each can be rerun alone and a lost executor costs a re-read.
"""

from __future__ import annotations

import ast
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecast.config import CleaningConfig, ExperimentConfig, FeatureConfig, GateConfig, ResearchConfig, SelectionConfig, TrainingConfig, feature_names
from pricecast.operators import evaluate as ev
from pricecast.operators import forecast as fc
from pricecast.operators import governance as gov
from pricecast.operators import ranking, regress, splits
from pricecast.operators.clean import clean_bars, cleaning_report
from pricecast.operators.features import feature_table
from pricecast.session import materialise
from pricecast.sources import files


def build_model(
    spark: SparkSession, raw: DataFrame, out: str, model_name: str = "price_model",
    cleaning: CleaningConfig = CleaningConfig(), features: FeatureConfig = FeatureConfig(),
    selection: SelectionConfig = SelectionConfig(), training: TrainingConfig = TrainingConfig(), gates: GateConfig = GateConfig(),
    configs: str | None = None,
) -> DataFrame:
    """Clean, featurise, select, train, register, gate and, if both gates pass, deploy under ``out``.

    Gates are judged by series and all must pass. Returns the lifecycle decision of the new version. Series too short for a hold-out are listed in
    ``rejected``; it is an error when none is left. With ``configs``, a table of settings that :func:`run_experiments`
    wrote, family and parameters are its current ones for this model.
    """
    if configs:
        training = current_training(spark, configs, model_name, training)
    clean = _stage(spark, clean_bars(raw, cleaning), f"{out}/clean")
    files.write_report(cleaning_report(raw, clean), f"{out}/reports/cleaning")

    kept, rejected = splits.guard_length(feature_table(clean, features), training.test_size)
    rejected.write.mode("overwrite").parquet(f"{out}/rejected")
    table = splits.holdout(splits.require_any(kept, training.test_size), training.test_size)
    table = _stage(spark, table, f"{out}/features")

    train = regress.scale_by_series(table, ["price", *feature_names(features)], F.col("split") == "train")
    ranked = ranking.rank_features(train.where(F.col("split") == "train"), feature_names(features), selection, ())
    chosen = _stage(spark, ranking.select_features(ranked, selection, ()), f"{out}/selected")
    names = [r.feature for r in chosen.orderBy("selected_position").select("feature").collect()]  # at most all features

    both, report, final = regress.train_model(
        table, names, training.model_name, training.fixed_params, training.n_iter, training.cv_splits, training.random_state
    )
    both = _stage(spark, both, f"{out}/predictions")
    report = _stage(spark, report, f"{out}/reports/training")

    gate = ev.metrics(both.where(F.col("split") == "test"), ("series_id", "model"), constant_is_perfect=True)
    judged = gov.staging_gate(gov.testing_gate(gov.with_metric_defaults(_side_by_side(report, gate)), gates), gates)
    judged = _stage(spark, judged, f"{out}/reports/gates")
    run = gov.over_series(judged, ["family"]).withColumns(
        {"model_name": F.lit(model_name), "run_ts": F.current_timestamp(), "run_id": F.expr("uuid()")}
    )
    run = _stage(spark, run, f"{out}/run")
    history = f"{out}/registry/versions"
    versions = gov.register_versions(run, _existing(spark, history))
    versions.write.mode("append").parquet(history)
    ours = spark.read.parquet(history).select("run_id", "version")
    checked = run.join(ours, "run_id")
    decision = _stage(spark, gov.lifecycle(checked), f"{out}/decision")
    gov.alias_events(decision).write.mode("append").parquet(f"{out}/registry/aliases")
    files.write_report(gov.promotion_report(decision, gates), f"{out}/reports/promotion")
    if decision.first().final_state == "production":
        gov.deploy(decision, final, chosen.select(F.col("selected_position").alias("position"), "feature"), f"{out}/deploy")
    return decision


def run_experiments(spark: SparkSession, table: DataFrame, features: list[str], configs: str, model_name: str = "price_model", cfg: ExperimentConfig = ExperimentConfig(), spaces: dict | None = None) -> DataFrame:
    """Search every family on a split feature table and append the winner to the table of settings at ``configs``.

    The winner has the least mean walk-forward error in units of each series' training deviation, so families and series
    are comparable; no test row has a say. Returns the board: a row per family with its parameters and error.
    """
    report = regress.compare_models(table, features, cfg.models, cfg.n_iter_per_model, cfg.cv_splits, cfg.random_state, spaces)
    spread = table.where(F.col("split") == "train").groupBy("series_id").agg(F.stddev_pop("price").alias("_sd"))
    # Ridge reports prices for each series, the tree families one number in scaled units.
    scaled = F.when(F.col("model_name") == "ridge", F.col("best_cv_rmse") / F.when(F.col("_sd") > 0, F.col("_sd"))).otherwise(F.col("best_cv_rmse"))
    board = report.join(spread, "series_id").groupBy("model_name").agg(
        F.avg(scaled).alias("cv_rmse"), F.min_by("best_params", F.struct(scaled, "series_id")).alias("params")
    )
    board = materialise(board, "board")
    winner = board.orderBy("cv_rmse", "model_name").limit(1).withColumnRenamed("model_name", "family")
    rows = winner.select(F.lit(model_name).alias("key"), F.col("family").alias("model_name"), "params", "cv_rmse")
    gov.config_rows(rows, F.current_timestamp()).coalesce(1).write.mode("append").parquet(configs)
    return board


def current_training(spark: SparkSession, configs: str, model_name: str, training: TrainingConfig = TrainingConfig()) -> TrainingConfig:
    """Training settings of a model by the current row of the table of settings; those given where it has none."""
    row = gov.best_config(spark.read.parquet(configs)).where(F.col("key") == model_name).first()
    if row is None:
        return training
    return replace(training, model_name=row["model_name"], fixed_params={k: _value(v) for k, v in json.loads(row["params_json"]).items()})


def _value(text: str):
    """A parameter from its text: a number, None or a word."""
    try:
        return ast.literal_eval(text)
    except ValueError:
        return text


def _side_by_side(report: DataFrame, gate: DataFrame) -> DataFrame:
    """Training report and recomputed test metrics of each series."""
    renamed = gate.select("series_id", *[F.col(m).alias(f"staging_{m}") for m in ("rmse", "mae", "mape", "r2")])
    return report.join(renamed, "series_id").withColumnRenamed("model_name", "family")


def _stage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    files.write_stage(df, path)
    return files.read_stage(spark, path)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).select("model_name", "version")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def benchmark(spark: SparkSession, clean: DataFrame, out: str, cfg: ResearchConfig = ResearchConfig(), forest: dict | None = None, boosting: dict | None = None, residual: dict | None = None, seed: int = 42) -> DataFrame:
    """All seven forecasters on the hold-out of every series: writes predictions, leaderboard and summary under ``out``.

    Forecasts go to one long table and are scored by one aggregation. Returns the leaderboard, best first.
    """
    need = cfg.test_size + max(cfg.lags)
    kept, _ = splits.guard_length(clean, need)
    split = _stage(spark, splits.holdout(splits.require_any(kept, need), cfg.test_size), f"{out}/split")
    matrix = regress.scaled_lags(split, cfg.lags)
    boosting = boosting or regress.BOOSTING_PARAMS
    weighted, weights = fc.hybrid_inverse_rmse(split, cfg.lags, cfg.ar_order[0], boosting, seed)
    corrected, _, _, history = fc.hybrid_residual(split, cfg, residual, seed)
    parts = [
        fc.arima_forecast(split, cfg.ar_order).select(*fc.LONG),
        fc.damped_trend_forecast(split),
        regress.kernel_forecast(split, cfg.lags, seed=seed),
        regress.tree_forecast(matrix, cfg.lags, "random_forest", forest or regress.FOREST_PARAMS, "random_forest", seed),
        regress.tree_forecast(matrix, cfg.lags, "gradient_boosting", boosting, "gradient_boosting", seed),
        weighted,
        corrected.select(*fc.LONG),
    ]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    long = _stage(spark, long, f"{out}/predictions")
    regime = ev.volatility_regime(split, cfg)
    board = _stage(spark, ev.leaderboard(long, regime, cfg), f"{out}/leaderboard")
    summary = ev.run_summary(split, board, regime, ev.ewma_rmse(ev.ewma_forecast(split, cfg)), cfg)
    files.write_report(summary, f"{out}/summary")
    files.write_report(history, f"{out}/loss_history")
    files.write_report(weights, f"{out}/hybrid_weights")
    return ev.sort_by_metric(board, "rmse", "series_id", "model")
