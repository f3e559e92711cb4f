"""Lag, rolling and fill operators.

Functions that end in ``_columns`` return expressions over a layout; one ``select`` of many of them shares a
single exchange and sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.functions.numeric import finite_or_null, pct_change
from pricecast.operators.layout import SERIES
from pricecast.session import materialise


def lag_columns(c: str, lags, layout=SERIES, prefix: str | None = None) -> dict[str, Column]:
    w = layout.window()
    return {f"{prefix or c}_lag_{k}": F.lag(c, k).over(w) for k in lags}


def full_window(agg: Column, counted: Column, frame, need: int) -> Column:
    """A rolling aggregate that stays NULL until its frame holds ``need`` values."""
    return F.when(F.count(counted).over(frame) >= need, agg.over(frame))


def rolling_columns(c: str, windows, layout=SERIES, prefix: str | None = None) -> dict[str, Column]:
    """Mean, sample deviation, minimum and maximum of the previous w rows, the current row left out."""
    out: dict[str, Column] = {}
    x = F.col(c)
    for w in windows:
        frame = layout.rows(-w, -1)
        for stat, agg in (("mean", F.avg(x)), ("std", F.stddev_samp(x)), ("min", F.min(x)), ("max", F.max(x))):
            out[f"{prefix or c}_roll_{stat}_{w}"] = full_window(agg, x, frame, w)
    return out


def moving_average(c: str, n: int, layout=SERIES) -> Column:
    """Mean of the last n rows, current row included."""
    return full_window(F.avg(c), F.col(c), layout.rows(-(n - 1), 0), n)


def pct_change_column(c: str, n: int, layout=SERIES) -> Column:
    return pct_change(F.col(c), F.lag(c, n).over(layout.window()))


def rolling_std(c: Column, n: int, layout=SERIES, shifted: bool = False) -> Column:
    """Sample deviation of n values; infinities count as missing. ``shifted`` leaves the current row out."""
    frame = layout.rows(-n, -1) if shifted else layout.rows(-(n - 1), 0)
    x = finite_or_null(c)
    return full_window(F.stddev_samp(x), x, frame, n)


def first_difference(c: str, layout=SERIES) -> Column:
    return F.col(c) - F.lag(c, 1).over(layout.window())


def sequence_windows(df: DataFrame, c: str, length: int, layout=SERIES) -> DataFrame:
    """Each row with the array of the ``length`` values before it; rows with a shorter past are left out."""
    ready = layout.prepare(df, length)
    seq = F.collect_list(c).over(layout.rows(-length, -1))
    return layout.finish(ready.withColumn("sequence", seq)).where(F.size("sequence") == length)


def fill_forward_back(df: DataFrame, columns: list[str]) -> DataFrame:
    """Last value carried forward, then leading gaps take the first value. NaN must be NULL already."""
    past = SERIES.rows(Window.unboundedPreceding, 0)
    future = SERIES.rows(0, Window.unboundedFollowing)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(future)) for c in columns}
    return df.withColumns(filled)


def _carry(df: DataFrame, keys: list[str], index: str, c: str, size: int, levels: int, forward: bool) -> DataFrame:
    """Fill NULLs of ``c`` along ``index`` from the nearest earlier (or later) value, block by block."""
    order = F.col(index).asc() if forward else F.col(index).desc()
    if levels == 0:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(c, F.last(c, ignorenulls=True).over(w))
    block = f"_{c}_{levels}"
    df = df.withColumn(block, F.floor(F.col(index) / size))
    edge = F.max_by if forward else F.min_by
    # One row per block: the value the block hands on, NULL if it holds none.
    held = F.when(F.col(c).isNotNull(), F.col(index))
    blocks = df.groupBy(*keys, block).agg(edge(c, held).alias("_edge"))
    step = 1 if forward else -1
    handed = _carry(blocks, keys, block, "_edge", size, levels - 1, forward)
    handed = handed.select(*keys, (F.col(block) + step).alias(block), F.col("_edge").alias("_in"))
    w = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(handed, [*keys, block], "left")
        .withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(w), F.col("_in")))
        .drop(block, "_in")
    )


def fill_positions(df: DataFrame, c: str, size: int = 4096) -> DataFrame:
    """Forward then backward fill of one column of a frame with positions ``_rn``.

    Blocks hand their last value on through a table of blocks, which is itself cut into blocks, level upon level until
    one fits a block, so no task gets more than ``size`` rows of a series. The frame is read several times, so it is
    written to the shared folder first.
    """
    df = materialise(df, "gaps")
    longest, levels = df.agg(F.max("_rn")).first()[0] or 0, 0
    while longest > size:
        longest, levels = longest // size + 1, levels + 1
    first = df.where(F.col(c).isNotNull()).groupBy("series_id").agg(F.min_by(c, "_rn").alias("_first"))
    df = _carry(df, ["series_id"], "_rn", c, size, levels, forward=True)
    return df.join(first, "series_id", "left").withColumn(c, F.coalesce(c, "_first")).drop("_first")
