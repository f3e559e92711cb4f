import pytest
from pyspark.sql import functions as F

from pricecast.config import ExperimentConfig, GateConfig, ResearchConfig, SelectionConfig, TrainingConfig
from pricecast.operators import splits
from pricecast.operators.features import feature_table
from pricecast.plans.workflow import benchmark, build_model, current_training, run_experiments


@pytest.fixture(scope="module")
def raw(panel):
    text = lambda c: F.format_string("%.6f", c)
    return panel.select(
        "series_id", F.date_format("date", "yyyyMMdd").cast("int").alias("_seq"), F.date_format("date", "yyyy-MM-dd").alias("Date"),
        text("price").alias("Price"), text("open").alias("Open"), text("high").alias("High"), text("low").alias("Low"),
        F.lit("1K").alias("Vol."), F.concat(text("change_pct"), F.lit("%")).alias("Change %"),
    )


def test_build_model(spark, raw, tmp_path):
    settings = dict(selection=SelectionConfig(method="f_regression", top_k=3), training=TrainingConfig(test_size=60))
    first = build_model(spark, raw, str(tmp_path), **settings).first()
    assert first.version == 1 and first.final_state == "production"  # same-day bars give the price away
    assert spark.read.parquet(f"{tmp_path}/deploy/model").count() == 2
    strict = build_model(spark, raw, str(tmp_path), gates=GateConfig(max_test_rmse=0.0), **settings).first()
    assert strict.version == 2 and strict.reason == "failed_testing_gate"
    with pytest.raises(ValueError):
        build_model(spark, raw, str(tmp_path / "short"), training=TrainingConfig(test_size=9999))


def test_benchmark(spark, panel, tmp_path):
    cfg = ResearchConfig(test_size=60, lags=(1, 2, 5), ar_order=(2, 1, 0), sequence_length=10)
    small = {"n_estimators": 3, "max_depth": 3}
    board = benchmark(spark, panel, str(tmp_path), cfg, small, small, small).collect()
    assert len(board) == 2 * 7
    assert [r.rmse for r in board] == sorted(r.rmse for r in board)
    assert spark.read.json(f"{tmp_path}/summary").count() == 2


def test_experiments_choose_what_is_trained(spark, panel, raw, tmp_path):
    """Search, table of settings, training: the winner by walk-forward error is what the next model is built with."""
    table = splits.holdout(feature_table(panel), 60).cache()
    spaces = {"ridge": {"alpha": [0.001, 0.1, 50.0]}, "extra_trees": {"n_estimators": [3], "max_depth": [2], "max_features": ["sqrt"]}}
    cfg = ExperimentConfig(models=("ridge", "extra_trees"), n_iter_per_model=3, cv_splits=2)
    configs = str(tmp_path / "configs")
    board = {r.model_name: r for r in run_experiments(spark, table, ["price_lag_1", "open", "price_roll_mean_7"], configs, "m", cfg, spaces).collect()}
    assert set(board) == {"ridge", "extra_trees"} and board["ridge"].cv_rmse < board["extra_trees"].cv_rmse
    chosen = current_training(spark, configs, "m")
    assert chosen.model_name == "ridge" and chosen.fixed_params["alpha"] in spaces["ridge"]["alpha"]
    assert current_training(spark, configs, "another", TrainingConfig(test_size=7)) == TrainingConfig(test_size=7)
    settings = dict(selection=SelectionConfig(method="f_regression", top_k=3), training=TrainingConfig(model_name="random_forest", test_size=60), configs=configs)
    build_model(spark, raw, str(tmp_path), "m", **settings)
    report = spark.read.parquet(f"{tmp_path}/reports/training").collect()
    assert {r.model_name for r in report} == {"ridge"} and {r.selection_mode for r in report} == {"fixed_params"}
