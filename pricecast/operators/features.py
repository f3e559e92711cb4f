"""Calendar, lag, rolling and derived features of a clean panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecast.config import FeatureConfig, feature_names
from pricecast.functions.calendar import calendar_columns
from pricecast.operators.layout import SERIES
from pricecast.operators.recurrence import ema, scan_series
from pricecast.operators.windows import lag_columns, pct_change_column, rolling_columns, rolling_std


def lag_roll_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), layout=SERIES) -> DataFrame:
    """Lags and rolling statistics of the price, none of which reads the current row."""
    ready = layout.prepare(df, max(*cfg.lags, *cfg.rolling_windows))
    columns = {**lag_columns("price", cfg.lags, layout), **rolling_columns("price", cfg.rolling_windows, layout)}
    return layout.finish(ready.withColumns(columns))


def derived_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), scan=scan_series) -> DataFrame:
    """Returns over 1 and 7 rows, exponential mean and volatility; the last two end at the previous row."""
    w = SERIES.window()
    df = df.withColumns(
        {
            "price_return_1": pct_change_column("price", 1),
            "price_return_7": pct_change_column("price", 7),
            "_rn": F.row_number().over(w),
        }
    )
    df = ema(df, "price", cfg.ema_span, "_ema", scan)
    df = df.withColumns(
        {
            f"ema_{cfg.ema_span}": F.lag("_ema").over(w),
            f"volatility_{cfg.volatility_window}": rolling_std(
                F.col("price_return_1"), cfg.volatility_window, shifted=True
            ),
        }
    )
    if not cfg.leaky:
        df = df.withColumns({f"price_return_{n}": F.lag(f"price_return_{n}").over(w) for n in (1, 7)})
    return df.drop("_rn", "_ema")


def feature_table(clean: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Clean bars with all features; rows with any missing value are dropped (infinities stay)."""
    df = clean.withColumns(calendar_columns(F.col("date")))
    df = derived_features(lag_roll_features(df, cfg), cfg)
    return df.select("series_id", "date", "price", *feature_names(cfg)).dropna(how="any")


def feature_list(df: DataFrame) -> list[str]:
    """All columns but keys and target, in table order."""
    return [c for c in df.columns if c not in ("series_id", "date", "price", "split")]


def existing_features(df: DataFrame, names: list[str]) -> list[str]:
    kept = [c for c in names if c in df.columns]
    if not kept:
        raise ValueError("the table holds none of the known features")
    return kept
