"""Daily open/high/low/close bars from trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecast.functions.numeric import pct_change
from pricecast.operators.layout import SERIES


def daily_bars(trades: DataFrame, weekdays_only: bool = True) -> DataFrame:
    """One bar per series and day, plus the percent change of the close against the previous bar.

    Trades are reduced map-side before the shuffle, so a series or a day that holds a large share of all
    trades ships one partial row per task. Equal ``seq`` values carry equal prices.
    """
    if weekdays_only:
        trades = trades.where(F.weekday("date") < 5)
    bars = trades.groupBy("series_id", "date").agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("price"),
        F.sum("quantity").alias("vol"),
    )
    before = F.lag("price").over(SERIES.window())
    return bars.select(
        "series_id", "date", "price", "open", "high", "low", "vol",
        (100 * pct_change(F.col("price"), before)).alias("change_pct"),
    )
