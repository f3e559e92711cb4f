"""Metrics of long prediction tables ``(series_id, date, model, actual, predicted)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.config import ResearchConfig
from pricecast.functions.numeric import clamp_denominator, is_minimised
from pricecast.operators.layout import SERIES
from pricecast.operators.recurrence import ewma_variance
from pricecast.operators.windows import pct_change_column, rolling_std

def err() -> Column:
    return F.col("actual") - F.col("predicted")


def to_long(df: DataFrame, models: dict[str, str], actual: str = "price") -> DataFrame:
    """One row per model from one column per model (``{model name: column}``)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("predicted")) for m, c in models.items()]))
    return df.select("series_id", "date", F.col(actual).alias("actual"), pairs.alias("p")).select(
        "series_id", "date", "p.model", "actual", "p.predicted"
    )


def to_wide(long: DataFrame, models: list[str]) -> DataFrame:
    """One ``pred_<model>`` column per model; the list of models is given, so no pass looks for it."""
    wide = long.groupBy("series_id", "date", "actual").pivot("model", models).agg(F.first("predicted"))
    return wide.select("series_id", "date", "actual", *[F.col(f"`{m}`").alias(f"pred_{m}") for m in models])


def align(actuals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Put actuals beside predictions by series and date."""
    return predictions.join(actuals, ["series_id", "date"]).select("series_id", "date", "model", "actual", "predicted")


def residuals(long: DataFrame) -> DataFrame:
    return long.withColumn("residual", err())


def r2(mse: Column, variance: Column, constant_is_perfect: bool) -> Column:
    """1 - mse/variance. For constant actuals: 1 always (gate rule), or only when there is no error."""
    flat = F.lit(1.0) if constant_is_perfect else F.when(mse == 0, 1.0).otherwise(0.0)
    return F.when(variance == 0, flat).otherwise(1 - mse / F.when(variance != 0, variance))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation of the rows that hold both values; NULL, not an error, when one side is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.when(spread != 0, spread)


def metric_columns(constant_is_perfect: bool = False) -> dict[str, Column]:
    mse = F.avg(err() * err())
    return {
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(err())),
        "mape": F.avg(F.abs(err() / clamp_denominator(F.col("actual")))),
        "r2": r2(mse, F.var_pop("actual"), constant_is_perfect),
    }


def metrics(long: DataFrame, keys=("series_id", "model"), constant_is_perfect: bool = False) -> DataFrame:
    """RMSE, MAE, MAPE and R2 in one aggregation that combines map-side."""
    return long.groupBy(*keys).agg(*[c.alias(n) for n, c in metric_columns(constant_is_perfect).items()])


def drift_pct(rmse: Column, baseline: Column) -> Column:
    """Growth of the RMSE over a baseline in percent; a zero baseline gives 0 or infinity."""
    growth = (rmse - baseline) / F.when(baseline > 1e-8, baseline) * 100.0
    return F.when(baseline <= 1e-8, F.when(rmse <= 1e-8, F.lit(0.0)).otherwise(F.lit(float("inf")))).otherwise(growth)


def mean_abs_prediction(long: DataFrame, keys=("series_id", "model")) -> DataFrame:
    return long.groupBy(*keys).agg(F.avg(F.abs("predicted")).alias("mean_abs_predicted"))


def volatility_regime(split: DataFrame, cfg: ResearchConfig = ResearchConfig()) -> DataFrame:
    """Test rows with their volatility, the train threshold and ``is_high``.

    The threshold is a quantile of train rows only. Test rows without a volatility are low; a series without
    train volatility gets the threshold 0.
    """
    df = split.withColumn("_ret", pct_change_column("price", 1))
    df = df.withColumn("volatility", rolling_std(F.col("_ret"), cfg.volatility_window))
    of_train = F.percentile(F.when(F.col("split") == "train", F.col("volatility")), F.lit(cfg.high_volatility_quantile))
    df = df.withColumn("threshold", F.coalesce(of_train.over(Window.partitionBy("series_id")), F.lit(0.0)))
    high = F.coalesce(F.col("volatility") >= F.col("threshold"), F.lit(False))
    return df.where(F.col("split") == "test").select("series_id", "date", "volatility", "threshold", high.alias("is_high"))


def masked_rmse(mask: Column) -> Column:
    """RMSE of the rows of a class, NULL when it is empty."""
    return F.sqrt(F.avg(F.when(mask, err() * err())))


def regime_rmse(long: DataFrame, regime: DataFrame) -> DataFrame:
    return (
        long.join(regime.select("series_id", "date", "is_high"), ["series_id", "date"])
        .groupBy("series_id", "model")
        .agg(
            masked_rmse(F.col("is_high")).alias("rmse_high_volatility"),
            masked_rmse(~F.col("is_high")).alias("rmse_low_volatility"),
        )
    )


def with_rolling_rmse(long: DataFrame, cfg: ResearchConfig = ResearchConfig()) -> DataFrame:
    """Add the RMSE of the last rows of the same model, NULL before the least number of rows is there."""
    size = max(cfg.rolling_window, cfg.rolling_min_periods)
    frame = Window.partitionBy("series_id", "model").orderBy("date").rowsBetween(-(size - 1), 0)
    enough = F.count(err()).over(frame) >= cfg.rolling_min_periods
    return long.withColumn("rolling_rmse", F.when(enough, F.sqrt(F.avg(err() * err()).over(frame))))


def rolling_columns() -> dict[str, Column]:
    """Mean and maximum of the rolling RMSE; the overall RMSE when no frame was long enough."""
    overall = F.sqrt(F.avg(err() * err()))
    return {
        "rolling_rmse_mean": F.coalesce(F.avg("rolling_rmse"), overall),
        "rolling_rmse_max": F.coalesce(F.max("rolling_rmse"), overall),
    }


def rolling_rmse_stats(long: DataFrame, cfg: ResearchConfig = ResearchConfig()) -> DataFrame:
    return (
        with_rolling_rmse(long, cfg)
        .groupBy("series_id", "model")
        .agg(*[c.alias(n) for n, c in rolling_columns().items()])
    )


def cost(tons: float) -> Column:
    """Absolute error times the volume bought per day."""
    return F.sum(F.abs(err())) * F.lit(tons)


def leaderboard(long: DataFrame, regime: DataFrame, cfg: ResearchConfig = ResearchConfig()) -> DataFrame:
    """All scores of every model of every series in one grouped aggregation."""
    rolled = with_rolling_rmse(long, cfg).join(regime.select("series_id", "date", "is_high"), ["series_id", "date"], "left")
    high = F.coalesce("is_high", F.lit(False))
    columns = {
        **metric_columns(),
        "rmse_high_volatility": masked_rmse(high),
        "rmse_low_volatility": masked_rmse(~high),
        **rolling_columns(),
        "procurement_abs_error_cost": cost(cfg.procurement_volume_tons),
    }
    return rolled.groupBy("series_id", "model").agg(*[c.alias(n) for n, c in columns.items()])


def sort_by_metric(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    """Best row first; the direction follows the metric's name and missing values go last."""
    lowest = any(w in metric.lower() for w in ("rmse", "mae", "mape", "loss", "error"))
    first = F.col(metric).asc_nulls_last() if lowest else F.col(metric).desc_nulls_last()
    return df.orderBy(first, *ties)


def best_by_metric(rows: DataFrame, keys=("series_id",)) -> DataFrame:
    """Best row of ``(keys, model, metric, value)`` per key and metric, whichever way the metric points."""
    score = F.when(is_minimised(F.col("metric")), F.col("value")).otherwise(-F.col("value"))
    best = F.min_by(F.struct("model", "value"), F.struct(score.alias("score"), F.col("model")))
    good = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return good.groupBy(*keys, "metric").agg(best.alias("best")).select(*keys, "metric", "best.model", "best.value")


def ewma_forecast(split: DataFrame, cfg: ResearchConfig = ResearchConfig()) -> DataFrame:
    """One-step variance forecasts of test rows, seeded with the train variance of returns."""
    whole = Window.partitionBy("series_id")
    df = split.withColumn("ret", pct_change_column("price", 1))
    df = df.withColumns(
        {
            "seed": F.var_pop(F.when(F.col("split") == "train", F.col("ret"))).over(whole),
            "_sq": F.pow(F.lag("ret").over(SERIES.window()), 2),
        }
    )
    test = df.where((F.col("split") == "test") & F.col("_sq").isNotNull())
    test = test.withColumn("_rn", F.row_number().over(SERIES.window()))
    test = ewma_variance(test, "_sq", "seed", cfg.ewma_lambda, "variance")
    return test.select("series_id", "date", (F.col("ret") * F.col("ret")).alias("squared_return"), "variance")


def ewma_rmse(forecast: DataFrame) -> DataFrame:
    d = F.col("squared_return") - F.col("variance")
    return forecast.groupBy("series_id").agg(F.sqrt(F.avg(d * d)).alias("ewma_variance_rmse"))


def run_summary(split: DataFrame, board: DataFrame, regime: DataFrame, ewma: DataFrame, cfg: ResearchConfig = ResearchConfig()) -> DataFrame:
    """One nested report row per series: sizes, best model, volatility diagnostics."""
    sizes = split.groupBy("series_id").agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.col("split") == "train").alias("rows_train"),
        F.count_if(F.col("split") == "test").alias("rows_test"),
    )
    best = board.groupBy("series_id").agg(
        F.min_by(
            F.struct("model", "rmse", F.col("procurement_abs_error_cost").alias("cost")), F.struct("rmse", "model")
        ).alias("best")
    )
    level = regime.groupBy("series_id").agg(F.max("threshold").alias("threshold"))
    return (
        sizes.join(best, "series_id")
        .join(level, "series_id", "left")
        .join(ewma, "series_id", "left")
        .select(
            "series_id", "rows_total", "rows_train", "rows_test",
            F.array(*[F.lit(k) for k in cfg.lags]).alias("lags"),
            F.array(*[F.lit(k) for k in cfg.ar_order]).alias("arima_order"),
            F.col("best.model").alias("best_model_by_rmse"),
            F.col("best.rmse").alias("best_rmse"),
            F.col("best.cost").alias("best_procurement_cost"),
            F.struct(
                F.lit(cfg.volatility_window).alias("window"),
                F.lit(cfg.high_volatility_quantile).alias("high_volatility_quantile"),
                F.col("threshold").alias("high_volatility_threshold"),
                F.col("ewma_variance_rmse").alias("ewma_variance_rmse"),
            ).alias("volatility"),
        )
    )
