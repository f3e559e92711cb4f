"""Queries that profile a panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricecast.operators import eda
from pricecast.operators.evaluate import residuals, to_wide
from pricecast.operators.windows import pct_change_column, rolling_std
from pricecast.plans import frames
from pricecast.plans.catalog import query, r, rounded
from pricecast.plans.oracle import sql

COLS = eda.BAR_COLUMNS


@query(
    "summary_row",
    sql(
        f"""SELECT series_id, count(*) AS n_rows, min(date) AS start_date, max(date) AS end_date, {r('avg(price)', 4, 'mean_price')},
        {r('stddev_samp(price)', 4, 'std_price')}, min(price) AS min_price, max(price) AS max_price, {r('avg(vol)', 4, 'mean_volume')}
        FROM bars GROUP BY series_id""",
        "bars",
    ),
)
def _summary_row(spark, folder):
    return rounded(eda.summary_row(frames.bars(spark, folder)))


@query(
    "describe",
    sql(
        " UNION ALL ".join(
            f"""SELECT series_id, '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS count_values, {r(f'avg({c})', 4, 'mean')},
            {r(f'stddev_samp({c})', 4, 'std')}, {r(f'min({c})', 4, 'min')}, {r(f'quantile_cont({c}, 0.25)', 4, 'q25')},
            {r(f'quantile_cont({c}, 0.5)', 4, 'q50')}, {r(f'quantile_cont({c}, 0.75)', 4, 'q75')}, {r(f'max({c})', 4, 'max')}
            FROM bars GROUP BY series_id"""
            for c in COLS
        ),
        "bars",
    ),
)
def _describe(spark, folder):
    return rounded(eda.describe(frames.bars(spark, folder)))


@query(
    "weekday_mean",
    sql(
        f"""SELECT s.series_id, CAST(d.i AS BIGINT) AS level_no, d.name AS level_name, {r('avg(b.price)', 4, 'mean')}
        FROM (SELECT DISTINCT series_id FROM bars) s
        CROSS JOIN (VALUES (0, 'Mon'), (1, 'Tue'), (2, 'Wed'), (3, 'Thu'), (4, 'Fri')) d(i, name)
        LEFT JOIN bars b ON b.series_id = s.series_id AND isodow(b.date) - 1 = d.i GROUP BY s.series_id, d.i, d.name""",
        "bars",
    ),
)
def _weekday_mean(spark, folder):
    return rounded(eda.mean_by_level(frames.bars(spark, folder), "price", F.weekday("date"), eda.WEEKDAYS))


BOX = """SELECT b.series_id, CAST(b.m AS BIGINT) AS month, count(*) AS n_rows, round(any_value(q1), 4) + 0.0 AS q1,
round(any_value(q2), 4) + 0.0 AS median, round(any_value(q3), 4) + 0.0 AS q3,
min(CASE WHEN price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN price END) AS whisker_low,
max(CASE WHEN price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN price END) AS whisker_high,
count(*) FILTER (WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT *, month(date) AS m FROM bars) b JOIN (SELECT series_id, month(date) AS m, quantile_cont(price, 0.25) AS q1,
quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3 FROM bars GROUP BY ALL) q
ON q.series_id = b.series_id AND q.m = b.m GROUP BY b.series_id, b.m"""


@query("month_box", sql(BOX, "bars"))
def _month_box(spark, folder):
    df = frames.bars(spark, folder).withColumn("month", F.month("date"))
    return rounded(eda.box_stats(df, "price", ["series_id", "month"]))


@query(
    "correlation_matrix",
    sql(
        " UNION ALL ".join(
            f"SELECT series_id, '{a}' AS column_a, '{b}' AS column_b, "
            + ("CAST(1.0 AS DOUBLE) AS correlation" if a == b else r(f"corr({a}, {b})", 8, "correlation"))
            + " FROM bars GROUP BY series_id"
            for a in COLS
            for b in COLS
        ),
        "bars",
    ),
)
def _correlation_matrix(spark, folder):
    return rounded(eda.correlation_matrix(frames.bars(spark, folder)), 8)


def _volatile(spark, folder):
    df = frames.bars(spark, folder).withColumn("ret", pct_change_column("price", 1))
    return df.withColumn("volatility", rolling_std(F.col("ret"), 14))


@query("quantile_75", sql(f"SELECT series_id, {r('quantile_cont(vol14, 0.75)', 8, 'quantile')} FROM vols GROUP BY series_id", "vols"))
def _quantile_75(spark, folder):
    return rounded(eda.quantile(_volatile(spark, folder), "volatility", 0.75), 8)


@query(
    "top10_volatility",
    sql(
        f"""SELECT series_id, date, price, {r('vol14', 8, 'volatility')} FROM vols
        ORDER BY vol14 DESC NULLS LAST, series_id, date LIMIT 10""",
        "vols",
    ),
)
def _top10_volatility(spark, folder):
    top = eda.top_n(_volatile(spark, folder), "volatility", 10, "series_id", "date")
    return rounded(top.select("series_id", "date", "price", "volatility"), 8)


@query("tail_n", sql("SELECT series_id, date, price FROM bars WHERE n - rn < 80", "bars"))
def _tail_n(spark, folder):
    return eda.tail_n(frames.bars(spark, folder), 80).select("series_id", "date", "price")


@query(
    "residual_histogram",
    sql(
        """, e AS (SELECT series_id, model, actual - predicted AS x FROM long),
        s AS (SELECT series_id, model, min(x) AS lo, max(x) AS hi FROM e GROUP BY series_id, model),
        c AS (SELECT e.series_id, e.model, least(CAST(floor((x - lo) / ((hi - lo) / 25)) AS BIGINT), 24) AS bin, count(*) AS n
        FROM e JOIN s ON s.series_id = e.series_id AND s.model = e.model GROUP BY ALL)
        SELECT s.series_id, s.model, b.bin, round(lo + b.bin * ((hi - lo) / 25), 4) + 0.0 AS bin_start,
        round(lo + (b.bin + 1) * ((hi - lo) / 25), 4) + 0.0 AS bin_end, COALESCE(c.n, 0) AS n_rows
        FROM s CROSS JOIN range(25) b(bin) LEFT JOIN c ON c.series_id = s.series_id AND c.model = s.model AND c.bin = b.bin""",
        "long",
    ),
)
def _residual_histogram(spark, folder):
    return rounded(eda.histogram(residuals(frames.simple_forecasts(spark, folder)), "residual", 25, ["series_id", "model"]))


@query(
    "residual_density",
    sql(
        """, e AS (SELECT series_id, model, actual - predicted AS x FROM long),
        s AS (SELECT series_id, model, min(x) AS lo, max(x) AS hi, CAST(count(*) AS DOUBLE) AS n,
        stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS bw FROM e GROUP BY series_id, model),
        g AS (SELECT s.*, CAST(p.i AS BIGINT) AS point, lo - 3 * bw + p.i * ((hi - lo + 6 * bw) / 199) AS gx FROM s CROSS JOIN range(200) p(i))
        SELECT g.series_id, g.model, g.point, round(any_value(gx), 3) + 0.0 AS x,
        round(sum(exp(-0.5 * ((gx - x) / bw) * ((gx - x) / bw)) / (n * bw * sqrt(2 * pi()))) * 1e6, 6) + 0.0 AS density_per_million
        FROM g JOIN e ON e.series_id = g.series_id AND e.model = g.model GROUP BY g.series_id, g.model, g.point""",
        "long",
    ),
)
def _residual_density(spark, folder):
    df = eda.density(residuals(frames.simple_forecasts(spark, folder)), "residual", ["series_id", "model"])
    df = df.select("series_id", "model", "point", "x", (F.col("density") * 1e6).alias("density_per_million"))
    return rounded(df, 6, x=3)


LABELS = (("naive", "Last price"), ("mean_7", "Mean of 7"), ("last_train", "Constant"))


@query(
    "label_lookup",
    sql(
        """SELECT series_id, label, count(*) AS n_rows FROM long
        JOIN (VALUES ('naive', 'Last price'), ('mean_7', 'Mean of 7'), ('last_train', 'Constant')) t(model, label) USING (model)
        WHERE model IN ('naive', 'mean_7') GROUP BY series_id, label""",
        "long",
    ),
)
def _label_lookup(spark, folder):
    labels = spark.createDataFrame(list(LABELS), "model string, label string")
    long = frames.simple_forecasts(spark, folder).where(F.col("model").isin("naive", "mean_7"))
    # The label table is a fixed list of three rows.
    return long.join(F.broadcast(labels), "model", "left").groupBy("series_id", "label").agg(F.count("*").alias("n_rows"))


@query(
    "melt_metrics",
    sql(
        f"""SELECT series_id, model, regime, round(rmse, 4) + 0.0 AS rmse FROM (SELECT series_id, model, rmse_high_volatility AS high_volatility,
        rmse_low_volatility AS low_volatility FROM board) UNPIVOT INCLUDE NULLS (rmse FOR regime IN (high_volatility, low_volatility))""",
        "board",
    ),
)
def _melt_metrics(spark, folder):
    from pricecast.operators.evaluate import regime_rmse, volatility_regime

    wide = regime_rmse(frames.simple_forecasts(spark, folder), volatility_regime(frames.split_bars(spark, folder)))
    wide = wide.select(
        "series_id", "model",
        F.col("rmse_high_volatility").alias("high_volatility"), F.col("rmse_low_volatility").alias("low_volatility"),
    )
    return rounded(wide.unpivot(["series_id", "model"], ["high_volatility", "low_volatility"], "regime", "rmse"))


@query(
    "pivot_predictions",
    sql(
        """SELECT series_id, date, actual, round(max(CASE WHEN model = 'naive' THEN predicted END), 4) + 0.0 AS pred_naive,
        round(max(CASE WHEN model = 'mean_7' THEN predicted END), 4) + 0.0 AS pred_mean_7,
        round(max(CASE WHEN model = 'last_train' THEN predicted END), 4) + 0.0 AS pred_last_train FROM long
        GROUP BY series_id, date, actual""",
        "long",
    ),
)
def _pivot_predictions(spark, folder):
    return rounded(to_wide(frames.simple_forecasts(spark, folder), ["naive", "mean_7", "last_train"]))
