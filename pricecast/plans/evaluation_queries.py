"""Queries that score forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricecast.operators import evaluate as ev
from pricecast.plans import frames
from pricecast.plans.catalog import query, r, rounded
from pricecast.plans.oracle import sql

METRICS = ("rmse", "mae", "mape", "r2")
BOARD = (*METRICS, "rmse_high_volatility", "rmse_low_volatility", "rolling_rmse_mean", "rolling_rmse_max", "procurement_abs_error_cost")


@query("aligned_predictions", sql(f"SELECT series_id, date, model, actual, {r('predicted')} FROM long", "long"))
def _aligned_predictions(spark, folder):
    actuals = frames.bars(spark, folder).select("series_id", "date", F.col("price").alias("actual"))
    return rounded(ev.align(actuals, frames.simple_forecasts(spark, folder).drop("actual")))


@query("residuals", sql(f"SELECT series_id, date, model, {r('actual - predicted', 4, 'residual')} FROM long", "long"))
def _residuals(spark, folder):
    df = ev.residuals(frames.simple_forecasts(spark, folder))
    return rounded(df.select("series_id", "date", "model", "residual"))


@query("metrics_by_model", sql(f"SELECT series_id, model, {', '.join(r(m, 6 if m in ('mape', 'r2') else 4) for m in METRICS)} FROM scored", "scored"))
def _metrics_by_model(spark, folder):
    return rounded(ev.metrics(frames.simple_forecasts(spark, folder)), 4, mape=6, r2=6)


@query(
    "gate_metrics",
    sql(
        f"""SELECT s.series_id, s.model, {r('s.rmse', 4, 'rmse')}, {r('s.r2', 6, 'r2')},
        {r('(s.rmse - b.rmse) / b.rmse * 100.0', 6, 'rmse_drift_pct')} FROM scored s
        JOIN scored b ON b.series_id = s.series_id AND b.model = 'naive'""",
        "scored",
    ),
)
def _gate_metrics(spark, folder):
    from pyspark.sql import Window

    m = ev.metrics(frames.simple_forecasts(spark, folder), constant_is_perfect=True)
    baseline = F.max(F.when(F.col("model") == "naive", F.col("rmse"))).over(Window.partitionBy("series_id"))
    m = m.withColumn("baseline", baseline)
    return rounded(
        m.select("series_id", "model", "rmse", "r2", ev.drift_pct(F.col("rmse"), F.col("baseline")).alias("rmse_drift_pct")),
        4, r2=6, rmse_drift_pct=6,
    )


@query(
    "mean_abs_prediction",
    sql(f"SELECT series_id, model, {r('avg(abs(predicted))', 4, 'mean_abs_predicted')} FROM long GROUP BY series_id, model", "long"),
)
def _mean_abs_prediction(spark, folder):
    return rounded(ev.mean_abs_prediction(frames.simple_forecasts(spark, folder)))


@query("regime_mask", sql(f"SELECT series_id, date, {r('volatility', 8)}, {r('threshold', 8)}, is_high FROM regime", "regime"))
def _regime_mask(spark, folder):
    return rounded(ev.volatility_regime(frames.split_bars(spark, folder)), 8)


@query("regime_rmse", sql(f"SELECT series_id, model, {r('rmse_high_volatility')}, {r('rmse_low_volatility')} FROM board", "board"))
def _regime_rmse(spark, folder):
    return rounded(ev.regime_rmse(frames.simple_forecasts(spark, folder), ev.volatility_regime(frames.split_bars(spark, folder))))


@query(
    "rolling_rmse",
    sql(f"SELECT series_id, model, {r('avg(rolling_rmse)', 4, 'rolling_rmse_mean')}, {r('max(rolling_rmse)', 4, 'rolling_rmse_max')} FROM rolled GROUP BY series_id, model", "rolled"),
)
def _rolling_rmse(spark, folder):
    return rounded(ev.rolling_rmse_stats(frames.simple_forecasts(spark, folder)))


@query("cost_proxy", sql(f"SELECT series_id, model, {r('sum(abs(actual - predicted)) * 10000.0', 0, 'cost')} FROM long GROUP BY series_id, model", "long"))
def _cost_proxy(spark, folder):
    long = frames.simple_forecasts(spark, folder)
    return rounded(long.groupBy("series_id", "model").agg(ev.cost(10_000.0).alias("cost")), 0)


def _board(spark, folder):
    return ev.leaderboard(frames.simple_forecasts(spark, folder), ev.volatility_regime(frames.split_bars(spark, folder)))


@query(
    "leaderboard",
    sql(f"SELECT series_id, model, {', '.join(r(c, {'mape': 6, 'r2': 6, 'procurement_abs_error_cost': 0}.get(c, 4)) for c in BOARD)} FROM board", "board"),
)
def _leaderboard(spark, folder):
    board = ev.sort_by_metric(_board(spark, folder), "rmse", "series_id", "model")
    return rounded(board, 4, mape=6, r2=6, procurement_abs_error_cost=0)


@query(
    "best_model",
    sql(
        f"""SELECT series_id, metric, arg_min(model, CASE WHEN metric = 'r2' THEN -value ELSE value END) AS model,
        round(CASE WHEN metric = 'r2' THEN max(value) ELSE min(value) END, 6) + 0.0 AS value
        FROM (SELECT * FROM scored UNPIVOT (value FOR metric IN (rmse, mae, mape, r2))) GROUP BY series_id, metric""",
        "scored",
    ),
)
def _best_model(spark, folder):
    wide = ev.metrics(frames.simple_forecasts(spark, folder))
    return rounded(ev.best_by_metric(wide.unpivot(["series_id", "model"], list(METRICS), "metric", "value")), 6)


@query("ewma_variance", sql(f"SELECT series_id, {r('sqrt(avg((ret * ret - v) * (ret * ret - v)))', 6, 'ewma_variance_rmse')} FROM ewma GROUP BY series_id", "ewma"))
def _ewma_variance(spark, folder):
    return rounded(ev.ewma_rmse(ev.ewma_forecast(frames.split_bars(spark, folder))), 6)


@query(
    "run_summary",
    sql(
        """, sizes AS (SELECT series_id, count(*) AS rows_total, count(*) FILTER (WHERE split = 'train') AS rows_train,
        count(*) FILTER (WHERE split = 'test') AS rows_test FROM rets GROUP BY series_id),
        top AS (SELECT series_id, arg_min(model, rmse) AS m, min(rmse) AS v, arg_min(procurement_abs_error_cost, rmse) AS c FROM board GROUP BY series_id),
        ew AS (SELECT series_id, sqrt(avg((ret * ret - v) * (ret * ret - v))) AS e FROM ewma GROUP BY series_id)
        SELECT s.series_id, rows_total, rows_train, rows_test, m AS best_model_by_rmse, round(v, 4) + 0.0 AS best_rmse,
        round(c, 0) + 0.0 AS best_procurement_cost, round(threshold, 8) + 0.0 AS high_volatility_threshold,
        round(e, 6) + 0.0 AS ewma_variance_rmse
        FROM sizes s JOIN top USING (series_id) JOIN thresholds USING (series_id) JOIN ew USING (series_id)""",
        "board", "ewma", "thresholds",
    ),
)
def _run_summary(spark, folder):
    split = frames.split_bars(spark, folder)
    regime = ev.volatility_regime(split)
    board = ev.leaderboard(frames.simple_forecasts(spark, folder), regime)
    doc = ev.run_summary(split, board, regime, ev.ewma_rmse(ev.ewma_forecast(split)))
    return rounded(
        doc.select(
            "series_id", "rows_total", "rows_train", "rows_test", "best_model_by_rmse", "best_rmse", "best_procurement_cost",
            "volatility.high_volatility_threshold", "volatility.ewma_variance_rmse",
        ),
        4, best_procurement_cost=0, high_volatility_threshold=8, ewma_variance_rmse=6,
    )
