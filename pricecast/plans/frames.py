"""Frames several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecast.config import TrainingConfig
from pricecast.operators.clean import clean_bars
from pricecast.operators.evaluate import to_long
from pricecast.operators.features import feature_table, lag_roll_features
from pricecast.operators.splits import holdout
from pricecast.operators.windows import pct_change_column, rolling_std
from pricecast.session import materialise
from pricecast.sources.bars import daily_bars
from pricecast.sources.tables import raw_bar_text, trades

TEST_SIZE = TrainingConfig().test_size


def bars(spark: SparkSession, folder: str) -> DataFrame:
    return daily_bars(trades(spark, folder))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_bars(raw_bar_text(spark, folder))


def features(spark: SparkSession, folder: str) -> DataFrame:
    return feature_table(bars(spark, folder))


def split_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with their split, written once: forecasters read them many times, and the trades behind them must not follow."""
    return materialise(holdout(bars(spark, folder), TEST_SIZE), "split_bars")


def split_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table with its split, written once as :func:`split_bars` is."""
    return materialise(holdout(features(spark, folder), TEST_SIZE), "split_features")


def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with lags, rolling statistics, returns and volatility; incomplete rows dropped; split labelled."""
    df = lag_roll_features(bars(spark, folder))
    df = df.withColumns({"price_return_1": pct_change_column("price", 1), "price_return_7": pct_change_column("price", 7)})
    df = df.withColumn("volatility_14", rolling_std(F.col("price_return_1"), 14, shifted=True)).dropna()
    return holdout(df, TEST_SIZE)


def simple_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """Long predictions of three simple models on the test rows.

    The previous price, the mean of the previous seven, and the last training price, which is also what a
    forecaster falls back to when its fit fails.
    """
    from pyspark.sql import Window

    df = complete_rows(spark, folder)
    whole = Window.partitionBy("series_id")
    last = F.max_by(F.when(F.col("split") == "train", F.col("price")), F.when(F.col("split") == "train", F.col("date")))
    df = df.withColumn("last_price", last.over(whole)).where(F.col("split") == "test")
    return to_long(df, {"naive": "price_lag_1", "mean_7": "price_roll_mean_7", "last_train": "last_price"})
