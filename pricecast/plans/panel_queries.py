"""Queries on bars, cleaning, features and row layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricecast.functions.calendar import calendar_columns, date_labels
from pricecast.operators import clean as cl
from pricecast.operators.features import feature_table, lag_roll_features
from pricecast.operators.layout import SERIES, BlockLayout, with_positions
from pricecast.operators.recurrence import ema, scan_blocks, scan_series
from pricecast.operators.splits import guard_length, holdout
from pricecast.operators.windows import (
    fill_positions,
    first_difference,
    lag_columns,
    moving_average,
    pct_change_column,
    rolling_columns,
    rolling_std,
    sequence_windows,
)
from pricecast.plans import frames
from pricecast.plans.catalog import query, r, rounded
from pricecast.plans.oracle import sql
from pricecast.sources.bars import daily_bars
from pricecast.sources.files import ingest_report
from pricecast.sources.tables import LINE_KEYS, brand_trades, raw_bar_text, ticks

LAGS = (1, 2, 3, 5, 7, 14, 21, 30)
ROLLS = [f"price_roll_{s}_{n}" for n in (7, 14, 30) for s in ("mean", "std", "min", "max")]


@query(
    "daily_bars",
    sql(f"SELECT series_id, date, price, open, high, low, vol, {r('change_pct', 6)} FROM bars", "bars"),
)
def _daily_bars(spark, folder):
    return rounded(frames.bars(spark, folder), 6)


@query(
    "brand_bars",
    """WITH t AS (SELECT p_brand AS series_id, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS p, l_quantity AS q,
    row_number() OVER (PARTITION BY p_brand, CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS up,
    row_number() OVER (PARTITION BY p_brand, CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS dn
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE isodow(l_shipdate) <= 5),
    b AS (SELECT series_id, date, max(CASE WHEN dn = 1 THEN p END) AS price, max(CASE WHEN up = 1 THEN p END) AS open,
    max(p) AS high, min(p) AS low, sum(q) AS vol FROM t GROUP BY series_id, date)
    SELECT series_id, date, price, open, high, low, vol,
    round(100 * (price / lag(price) OVER (PARTITION BY series_id ORDER BY date) - 1), 6) + 0.0 AS change_pct FROM b""",
)
def _brand_bars(spark, folder):
    return rounded(daily_bars(brand_trades(spark, folder)), 6)


@query(
    "features_lag_roll",
    sql(
        "SELECT series_id, date, price, "
        + ", ".join(f"price_lag_{k}" for k in LAGS)
        + ", "
        + ", ".join(r(c) for c in ROLLS)
        + " FROM lagroll",
        "lagroll",
    ),
)
def _features_lag_roll(spark, folder):
    df = lag_roll_features(frames.bars(spark, folder))
    return rounded(df.select("series_id", "date", "price", *[f"price_lag_{k}" for k in LAGS], *ROLLS))


@query(
    "holdout_split",
    sql(
        """SELECT series_id, split, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
        FROM complete GROUP BY series_id, split""",
        "complete",
    ),
)
def _holdout_split(spark, folder):
    return (
        frames.complete_rows(spark, folder)
        .groupBy("series_id", "split")
        .agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    )


@query("ingest_report", "SELECT count(*) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM lineitem")
def _ingest_report(spark, folder):
    return ingest_report(raw_bar_text(spark, folder))


KEYS = LINE_KEYS


def _parsed(spark, folder, *columns):
    return cl.parse_bars(raw_bar_text(spark, folder), keep=KEYS).select("series_id", *KEYS, *columns)


@query("clean_volume", sql(f"SELECT series_id, {', '.join(KEYS)}, {r('vol', 2)} FROM parsed", "parsed"))
def _clean_volume(spark, folder):
    return rounded(_parsed(spark, folder, "vol"), 2, vol=2).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


@query("clean_percent", sql(f"SELECT series_id, {', '.join(KEYS)}, change_pct FROM parsed", "parsed"))
def _clean_percent(spark, folder):
    return _parsed(spark, folder, "change_pct")


@query("coerce_prices", sql(f"SELECT series_id, {', '.join(KEYS)}, price, open, high, low FROM parsed", "parsed"))
def _coerce_prices(spark, folder):
    return _parsed(spark, folder, "price", "open", "high", "low")


@query("coerce_dates", sql(f"SELECT series_id, {', '.join(KEYS)}, date FROM parsed", "parsed"))
def _coerce_dates(spark, folder):
    return _parsed(spark, folder, "date")


@query("dedupe_last", sql("SELECT series_id, date, price, open, high, low, round(vol, 2) + 0.0 AS vol, change_pct FROM deduped", "deduped"))
def _dedupe_last(spark, folder):
    df = cl.keep_last(cl.drop_unusable(cl.parse_bars(raw_bar_text(spark, folder))))
    return rounded(df, 6, vol=2)


@query(
    "weekday_filter",
    sql("SELECT series_id, date, price FROM parsed WHERE date IS NOT NULL AND price IS NOT NULL AND isodow(date) <= 5", "parsed"),
)
def _weekday_filter(spark, folder):
    df = cl.weekdays(cl.drop_unusable(cl.parse_bars(raw_bar_text(spark, folder))))
    return df.select("series_id", "date", "price")


@query("fill_forward_back", sql("SELECT series_id, date, price, open, high, low, round(vol, 2) + 0.0 AS vol, change_pct FROM clean", "clean"))
def _fill_forward_back(spark, folder):
    return rounded(frames.clean(spark, folder), 6, vol=2)


@query(
    "cleaning_report",
    sql(
        """SELECT series_id, original_rows, cleaned_rows, original_rows - cleaned_rows AS dropped_rows, date_min, date_max
        FROM (SELECT series_id, count(*) AS original_rows FROM raw GROUP BY series_id)
        JOIN (SELECT series_id, count(*) AS cleaned_rows, min(date) AS date_min, max(date) AS date_max FROM clean
        GROUP BY series_id) USING (series_id)""",
        "raw", "clean",
    ),
)
def _cleaning_report(spark, folder):
    raw = raw_bar_text(spark, folder)
    return cl.cleaning_report(raw, cl.clean_bars(raw))


@query(
    "calendar_features",
    sql(
        """SELECT series_id, date, isodow(date) - 1 AS day_of_week, day(date) AS day_of_month, week(date) AS week_of_year,
        month(date) AS month, quarter(date) AS quarter, year(date) AS year,
        CAST(CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_month_start,
        CAST(CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS BIGINT) AS is_month_end,
        strftime(date, '%Y-%m-%d') AS iso_date, strftime(date, '%b') AS month_label, strftime(date, '%a') AS weekday_label
        FROM day_bars""",
        "day_bars",
    ),
)
def _calendar_features(spark, folder):
    day = F.col("date")
    df = frames.bars(spark, folder).select("series_id", "date")
    return rounded(df.withColumns({**calendar_columns(day), **date_labels(day)}))


@query(
    "complete_rows",
    sql("SELECT series_id, count(*) AS n_rows, min(date) AS first_date FROM complete GROUP BY series_id", "complete"),
)
def _complete_rows(spark, folder):
    df = frames.complete_rows(spark, folder)
    return df.groupBy("series_id").agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"))


@query("row_index", sql("SELECT series_id, date, rn FROM bars", "bars"))
def _row_index(spark, folder):
    df = frames.bars(spark, folder)
    return df.select("series_id", "date", F.row_number().over(SERIES.window()).cast("long").alias("rn"))


@query(
    "length_guard",
    """WITH d AS (SELECT DISTINCT p_brand AS series_id, CAST(l_shipdate AS DATE) AS date FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE isodow(l_shipdate) <= 5)
    SELECT series_id, count(*) AS n_rows, CAST(282 AS BIGINT) AS required_more_than FROM d GROUP BY series_id HAVING count(*) <= 282
    UNION ALL SELECT 'kept', count(*), CAST(282 AS BIGINT) FROM (SELECT series_id FROM d GROUP BY series_id HAVING count(*) > 282)""",
)
def _length_guard(spark, folder):
    kept, rejected = guard_length(daily_bars(brand_trades(spark, folder)), 252 + 30)
    n = kept.groupBy("series_id").agg(F.lit(1).alias("one")).agg(F.count("*").alias("n_rows"))
    return rejected.unionByName(n.select(F.lit("kept").alias("series_id"), "n_rows", F.lit(282).cast("long").alias("required_more_than")))


@query(
    "first_difference",
    sql("SELECT series_id, date, round(price - lag(price) OVER (PARTITION BY series_id ORDER BY date), 4) + 0.0 AS diff FROM bars", "bars"),
)
def _first_difference(spark, folder):
    return rounded(frames.bars(spark, folder).select("series_id", "date", first_difference("price").alias("diff")))


@query(
    "pct_change",
    sql(f"SELECT series_id, date, {r('price_return_1', 8)}, {r('price_return_7', 8)} FROM derived", "derived"),
)
def _pct_change(spark, folder):
    df = frames.bars(spark, folder)
    return rounded(
        df.select(
            "series_id", "date",
            pct_change_column("price", 1).alias("price_return_1"),
            pct_change_column("price", 7).alias("price_return_7"),
        ),
        8,
    )


@query("volatility_14", sql(f"SELECT series_id, date, {r('volatility_14', 8)} FROM derived", "derived"))
def _volatility_14(spark, folder):
    df = frames.bars(spark, folder).withColumn("ret", pct_change_column("price", 1))
    return rounded(df.select("series_id", "date", rolling_std(F.col("ret"), 14, shifted=True).alias("volatility_14")), 8)


@query("volatility_unshifted", sql(f"SELECT series_id, date, {r('vol14', 8, 'volatility')} FROM vols", "vols"))
def _volatility_unshifted(spark, folder):
    df = frames.bars(spark, folder).withColumn("ret", pct_change_column("price", 1))
    return rounded(df.select("series_id", "date", rolling_std(F.col("ret"), 14).alias("volatility")), 8)


@query("ema_14", sql(f"SELECT series_id, date, {r('e', 4, 'ema')} FROM emas", "emas"))
def _ema_14(spark, folder):
    df = frames.bars(spark, folder).withColumn("_rn", F.row_number().over(SERIES.window()))
    return rounded(ema(df, "price", 14, "ema", scan_series).select("series_id", "date", "ema"))


@query(
    "moving_average_30",
    sql(
        f"""SELECT series_id, date, {r('CASE WHEN count(price) OVER w >= 30 THEN avg(price) OVER w END', 4, 'ma_30')} FROM bars
        WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
        "bars",
    ),
)
def _moving_average_30(spark, folder):
    return rounded(frames.bars(spark, folder).select("series_id", "date", moving_average("price", 30).alias("ma_30")))


CALENDAR = ("day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year", "is_month_start", "is_month_end")


@query(
    "feature_table",
    sql(
        "SELECT series_id, date, price, open, high, low, vol, "
        + r("change_pct", 6)
        + ", "
        + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in CALENDAR)
        + ", "
        + ", ".join(f"price_lag_{k}" for k in LAGS)
        + ", "
        + ", ".join(r(c) for c in ROLLS)
        + f", {r('price_return_1', 8)}, {r('price_return_7', 8)}, {r('ema_14', 4)}, {r('volatility_14', 8)} FROM features",
        "features",
    ),
)
def _feature_table(spark, folder):
    return rounded(frames.features(spark, folder), 4, change_pct=6, price_return_1=8, price_return_7=8, volatility_14=8)


@query(
    "sequence_windows",
    sql(
        """SELECT series_id, date, price AS label, count(*) OVER w AS length, round(first_value(price) OVER w, 4) + 0.0 AS oldest,
        round(last_value(price) OVER w, 4) + 0.0 AS newest, round(sum(price) OVER w, 2) + 0.0 AS total FROM bars
        WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) QUALIFY rn > 30""",
        "bars",
    ),
)
def _sequence_windows(spark, folder):
    df = sequence_windows(frames.bars(spark, folder), "price", 30)
    s = F.col("sequence")
    return rounded(
        df.select(
            "series_id", "date", F.col("price").alias("label"), F.size(s).cast("long").alias("length"),
            F.element_at(s, 1).alias("oldest"), F.element_at(s, -1).alias("newest"),
            F.aggregate(s, F.lit(0.0), lambda a, x: a + x).alias("total"),
        ),
        4, total=2,
    )


@query(
    "head_preview",
    sql("SELECT series_id, date, price FROM bars WHERE rn <= 5", "bars"),
)
def _head_preview(spark, folder):
    df = frames.bars(spark, folder).withColumn("rn", F.row_number().over(SERIES.window()))
    return df.where(F.col("rn") <= 5).select("series_id", "date", "price")


@query("lag_matrix", sql("SELECT series_id, date, price AS y, rn - 1 AS t, " + ", ".join(f"price_lag_{k} AS lag_{k}" for k in LAGS) + " FROM lagroll WHERE price_lag_30 IS NOT NULL", "lagroll"))
def _lag_matrix(spark, folder):
    from pricecast.operators.regress import lag_matrix

    df = lag_matrix(frames.bars(spark, folder), LAGS)
    return df.select("series_id", "date", "y", F.col("t").cast("long").alias("t"), *[f"lag_{k}" for k in LAGS])


# Ticks: series of any length, so positions and halo blocks instead of one window per series.

TICKS = "SELECT event_type AS series_id, event_id, ts, value AS price, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"
BLOCK = BlockLayout(size=256)


def _tick_positions(spark, folder):
    return with_positions(ticks(spark, folder), ("ts", "event_id"))


@query("tick_positions", f"SELECT series_id, event_id, rn FROM ({TICKS})")
def _tick_row_index(spark, folder):
    return _tick_positions(spark, folder).select("series_id", "event_id", F.col("_rn").cast("long").alias("rn"))


@query(
    "tick_lag_roll",
    f"""SELECT series_id, event_id, lag(price, 1) OVER w AS price_lag_1, lag(price, 30) OVER w AS price_lag_30,
    round(CASE WHEN count(price) OVER f >= 30 THEN avg(price) OVER f END, 4) + 0.0 AS price_roll_mean_30,
    round(CASE WHEN count(price) OVER f >= 30 THEN stddev_samp(price) OVER f END, 6) + 0.0 AS price_roll_std_30,
    CASE WHEN count(price) OVER f >= 30 THEN min(price) OVER f END AS price_roll_min_30,
    CASE WHEN count(price) OVER f >= 30 THEN max(price) OVER f END AS price_roll_max_30 FROM ({TICKS})
    WINDOW w AS (PARTITION BY series_id ORDER BY rn),
    f AS (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
)
def _tick_lag_roll(spark, folder):
    ready = BLOCK.prepare(_tick_positions(spark, folder), 30)
    df = BLOCK.finish(ready.withColumns({**lag_columns("price", (1, 30), BLOCK), **rolling_columns("price", (30,), BLOCK)}))
    names = [f"price_roll_{s}_30" for s in ("mean", "std", "min", "max")]
    return rounded(df.select("series_id", "event_id", "price_lag_1", "price_lag_30", *names), 4, price_roll_std_30=6)


@query(
    "tick_ema",
    f"""WITH RECURSIVE t AS MATERIALIZED ({TICKS}),
    e AS (SELECT series_id, event_id, rn, CAST(price AS DOUBLE) AS ema FROM t WHERE rn = 1
    UNION ALL SELECT t.series_id, t.event_id, t.rn, CAST(13.0/15.0 AS DOUBLE) * e.ema + CAST(2.0/15.0 AS DOUBLE) * t.price
    FROM e JOIN t ON t.series_id = e.series_id AND t.rn = e.rn + 1) SELECT series_id, event_id, {r('ema', 6)} FROM e""",
)
def _tick_ema(spark, folder):
    return rounded(ema(_tick_positions(spark, folder), "price", 14, "ema", scan_blocks).select("series_id", "event_id", "ema"), 6)


@query(
    "tick_fill",
    f"""WITH t AS (SELECT series_id, event_id, rn, CASE WHEN price >= 5 THEN price END AS price FROM ({TICKS}))
    SELECT series_id, event_id, COALESCE(last_value(price IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY rn
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(price IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY rn
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM t""",
)
def _tick_fill(spark, folder):
    gappy = _tick_positions(spark, folder).withColumn("price", F.when(F.col("price") >= 5, F.col("price")))
    return fill_positions(gappy, "price", size=64).select("series_id", "event_id", "price")
