"""Queries on runs, gates, lifecycle and settings.

A run is one model scored on one series over one year: the first half of the year is the test set, the
second half the predictions recomputed before staging.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricecast.functions.maps import flatten_metrics
from pricecast.functions.numeric import is_minimised
from pricecast.operators import governance as gov
from pricecast.operators.evaluate import metric_columns, to_long
from pricecast.plans import frames
from pricecast.plans.catalog import query, r, rounded
from pricecast.plans.oracle import CTES, sql

E = "(actual - predicted)"
DENOMINATOR = "CASE WHEN abs(actual) < 1e-8 THEN 1e-8 ELSE actual END"
CTES["half_years"] = (
    ("complete",),
    """SELECT series_id, m.model, year(date) AS y, month(date) <= 6 AS first_half, date, price AS actual,
    CASE m.model WHEN 'naive' THEN price_lag_1 WHEN 'leaky_rounded' THEN round(price, 0)
         ELSE CASE WHEN month(date) <= 6 THEN round(price, 0) ELSE price_lag_1 END END AS predicted
    FROM complete CROSS JOIN (VALUES ('naive'), ('leaky_rounded'), ('leaky_lapsing')) m(model)""",
)
CTES["runs"] = (
    ("half_years",),
    """SELECT 'price_' || series_id || '_' || model AS model_name, series_id || '-' || model || '-' || y AS run_id, max(date) AS run_ts, """
    + ", ".join(
        f"""sqrt(avg({E} * {E}) FILTER (WHERE {w})) AS {p}_rmse, avg(abs({E})) FILTER (WHERE {w}) AS {p}_mae,
        avg(abs({E} / {DENOMINATOR})) FILTER (WHERE {w}) AS {p}_mape,
        1 - avg({E} * {E}) FILTER (WHERE {w}) / var_pop(actual) FILTER (WHERE {w}) AS {p}_r2"""
        for p, w in (("test", "first_half"), ("staging", "NOT first_half"))
    )
    + " FROM half_years GROUP BY series_id, model, y",
)
CTES["defaulted"] = (
    ("runs",),
    """SELECT * REPLACE (COALESCE(test_rmse, 'inf'::DOUBLE) AS test_rmse, COALESCE(test_mae, 'inf'::DOUBLE) AS test_mae,
    COALESCE(test_mape, 'inf'::DOUBLE) AS test_mape, COALESCE(test_r2, '-inf'::DOUBLE) AS test_r2),
    row_number() OVER (PARTITION BY model_name ORDER BY run_ts, run_id) AS version FROM runs""",
)
CTES["tested"] = (
    ("defaulted",),
    """SELECT *, test_rmse <= 0.5 AS rmse_ok, test_mape <= 0.01 AS mape_ok, test_r2 >= 0.99 AS r2_ok,
    test_rmse <= 0.5 AND test_mape <= 0.01 AND test_r2 >= 0.99 AS testing_passed FROM defaulted""",
)
CTES["drifted"] = (
    ("tested",),
    """SELECT *, CASE WHEN test_rmse <= 1e-8 THEN CASE WHEN staging_rmse <= 1e-8 THEN 0.0 ELSE 'inf'::DOUBLE END
    ELSE CASE WHEN test_rmse = 'inf'::DOUBLE THEN NULL ELSE (staging_rmse - test_rmse) / test_rmse * 100.0 END END AS rmse_drift_pct FROM tested""",
)
CTES["staged"] = (
    ("drifted",),
    """SELECT *, COALESCE(rmse_drift_pct <= 20.0, false) AND COALESCE(staging_mape <= 0.01, false) AND COALESCE(staging_r2 >= 0.99, false)
    AS staging_passed FROM drifted""",
)
CTES["decided"] = (
    ("staged",),
    """SELECT *, CASE WHEN testing_passed AND staging_passed THEN 'production' ELSE 'testing' END AS final_state,
    CASE WHEN NOT testing_passed THEN 'failed_testing_gate' WHEN NOT staging_passed THEN 'failed_staging_gate_rolled_back_to_testing'
    ELSE 'passed_testing_and_staging' END AS reason FROM staged""",
)
CTES["events_log"] = (
    ("decided",),
    """SELECT model_name, 'testing' AS alias, version, run_ts, 0 AS step, false AS deleted FROM decided
    UNION ALL SELECT model_name, 'staging', version, run_ts, 1, NOT testing_passed FROM decided
    UNION ALL SELECT model_name, 'testing', version, run_ts, 2, false FROM decided WHERE testing_passed AND NOT staging_passed
    UNION ALL SELECT model_name, 'staging', version, run_ts, 3, true FROM decided WHERE testing_passed AND NOT staging_passed
    UNION ALL SELECT model_name, 'production', version, run_ts, 4, false FROM decided WHERE testing_passed AND staging_passed""",
)


def _half_years(spark, folder):
    df = frames.complete_rows(spark, folder)
    rounded_price = F.round("price", 0)
    first = F.month("date") <= 6
    df = df.withColumns(
        {
            "_naive": F.col("price_lag_1"),
            "_rounded": rounded_price,
            "_lapsing": F.when(first, rounded_price).otherwise(F.col("price_lag_1")),
        }
    )
    return to_long(df, {"naive": "_naive", "leaky_rounded": "_rounded", "leaky_lapsing": "_lapsing"})


def _runs(spark, folder):
    """One row per run with its two metric sets, from one aggregation."""
    long = _half_years(spark, folder)
    first = F.month("date") <= 6
    columns = [F.max("date").alias("run_ts")]
    for part, rows in (("test", first), ("staging", ~first)):
        e = F.when(rows, F.col("actual") - F.col("predicted"))
        a = F.when(rows, F.col("actual"))
        mse = F.avg(e * e)
        columns += [
            F.sqrt(mse).alias(f"{part}_rmse"), F.avg(F.abs(e)).alias(f"{part}_mae"),
            F.avg(F.abs(e / F.when(F.abs(a) < 1e-8, F.lit(1e-8)).otherwise(a))).alias(f"{part}_mape"),
            F.when(F.var_pop(a) != 0, 1 - mse / F.var_pop(a)).when(F.var_pop(a) == 0, 1.0).alias(f"{part}_r2"),
        ]
    return long.groupBy("series_id", "model", F.year("date").alias("y")).agg(*columns).select(
        F.concat_ws("_", F.lit("price"), "series_id", "model").alias("model_name"),
        F.concat_ws("-", "series_id", "model", F.col("y").cast("string")).alias("run_id"),
        "run_ts", *[f"{p}_{m}" for p in ("test", "staging") for m in ("rmse", "mae", "mape", "r2")],
    )


def _decided(spark, folder):
    runs = _runs(spark, folder)
    versions = gov.register_versions(runs).select("run_id", "version")
    gated = gov.staging_gate(gov.testing_gate(gov.with_metric_defaults(runs)))
    return gov.lifecycle(gated.join(versions, "run_id"))


@query(
    "experiment_runs",
    sql(
        """SELECT model_name, run_id, kind, key, value FROM (
        SELECT model_name, run_id, 'param' AS kind, 'year' AS key, right(run_id, 4) AS value FROM runs
        UNION ALL SELECT model_name, run_id, 'metric', 'n_rows', CAST(CAST(n AS DOUBLE) AS VARCHAR) FROM
        (SELECT model_name, run_id FROM runs) JOIN (SELECT series_id || '-' || model || '-' || year(date) AS run_id, count(*) AS n FROM half_years GROUP BY ALL) USING (run_id))""",
        "runs",
    ),
)
def _experiment_runs(spark, folder):
    long = _half_years(spark, folder)
    runs = long.groupBy("series_id", "model", F.year("date").cast("string").alias("y")).agg(F.count("*").alias("n_rows"))
    runs = runs.select(
        F.concat_ws("_", F.lit("price"), "series_id", "model").alias("model_name"),
        F.concat_ws("-", "series_id", "model", "y").alias("run_id"),
        "n_rows", F.create_map(F.lit("year"), F.col("y")).alias("params"),
    )
    return gov.log_runs(runs, ["model_name", "run_id"])


@query(
    "register_versions",
    sql("SELECT model_name, version, run_id, run_ts, 'testing' AS alias, 'models:/' || model_name || '/' || version AS model_uri FROM defaulted", "defaulted"),
)
def _register_versions(spark, folder):
    out = gov.register_versions(_runs(spark, folder))
    return out.select("model_name", "version", "run_id", "run_ts", "alias", "model_uri")


@query(
    "metrics_long",
    sql(
        """SELECT model_name, run_id, metric, round(value, 6) + 0.0 AS value FROM (SELECT model_name, run_id, test_rmse AS "test.rmse", test_r2 AS "test.r2",
        staging_rmse AS "staging.rmse" FROM runs) UNPIVOT (value FOR metric IN ("test.rmse", "test.r2", "staging.rmse"))""",
        "runs",
    ),
)
def _metrics_long(spark, folder):
    doc = _runs(spark, folder).select(
        "model_name", "run_id",
        F.struct(F.col("test_rmse").alias("rmse"), F.col("test_r2").alias("r2")).alias("test"),
        F.struct(F.col("staging_rmse").alias("rmse")).alias("staging"),
    )
    return rounded(flatten_metrics(doc, ["model_name", "run_id"]), 6)


@query(
    "flatten_metrics",
    sql(
        """SELECT run_id, metric, round(value, 4) + 0.0 AS value FROM (SELECT run_id, CAST(CASE WHEN testing_passed THEN 1 ELSE 0 END AS DOUBLE) AS "gate.passed",
        CASE WHEN test_rmse < 'inf'::DOUBLE THEN test_rmse END AS "gate.metrics.rmse" FROM tested) UNPIVOT (value FOR metric IN ("gate.passed", "gate.metrics.rmse"))""",
        "tested",
    ),
)
def _flatten_metrics(spark, folder):
    gated = gov.testing_gate(gov.with_metric_defaults(_runs(spark, folder)))
    rmse = F.when(F.col("test_rmse") < float("inf"), F.col("test_rmse"))
    doc = gated.select(
        "run_id",
        F.struct(
            F.lit("testing").alias("name"), F.col("testing_passed").alias("passed"), F.struct(rmse.alias("rmse")).alias("metrics")
        ).alias("gate"),
    )
    return rounded(flatten_metrics(doc, ["run_id"]))


@query(
    "metric_defaults",
    sql(
        """SELECT run_id, CAST(test_rmse AS VARCHAR) = 'inf' AS rmse_defaulted, CAST(test_r2 AS VARCHAR) = '-inf' AS r2_defaulted,
        round(CASE WHEN test_rmse < 'inf'::DOUBLE THEN test_rmse ELSE -1 END, 4) + 0.0 AS rmse_or_minus_one FROM defaulted""",
        "defaulted",
    ),
)
def _metric_defaults(spark, folder):
    df = gov.with_metric_defaults(_runs(spark, folder))
    inf = float("inf")
    return rounded(
        df.select(
            "run_id", (F.col("test_rmse") == inf).alias("rmse_defaulted"), (F.col("test_r2") == -inf).alias("r2_defaulted"),
            F.when(F.col("test_rmse") < inf, F.col("test_rmse")).otherwise(F.lit(-1.0)).alias("rmse_or_minus_one"),
        )
    )


@query("testing_gate", sql("SELECT run_id, rmse_ok, mape_ok, r2_ok, testing_passed FROM tested", "tested"))
def _testing_gate(spark, folder):
    df = gov.testing_gate(gov.with_metric_defaults(_runs(spark, folder)))
    return df.select("run_id", "rmse_ok", "mape_ok", "r2_ok", "testing_passed")


@query("staging_gate", sql("SELECT run_id, staging_passed FROM staged", "staged"))
def _staging_gate(spark, folder):
    df = gov.staging_gate(gov.with_metric_defaults(_runs(spark, folder)))
    return df.select("run_id", "staging_passed")


@query("lifecycle_decision", sql("SELECT model_name, version, final_state, reason FROM decided", "decided"))
def _lifecycle_decision(spark, folder):
    return _decided(spark, folder).select("model_name", "version", "final_state", "reason")


@query(
    "alias_view",
    sql(
        """SELECT model_name, alias, version FROM (SELECT *, row_number() OVER (PARTITION BY model_name, alias ORDER BY run_ts DESC, version DESC, step DESC) AS k
        FROM events_log) WHERE k = 1 AND NOT deleted""",
        "events_log",
    ),
)
def _alias_view(spark, folder):
    return gov.current_aliases(gov.alias_events(_decided(spark, folder)))


@query(
    "lifecycle_stages",
    sql(
        """SELECT model_name, version, final_state AS lifecycle_stage,
        CASE WHEN NOT testing_passed THEN 'failed_testing_gate' WHEN NOT staging_passed THEN 'failed_staging_gate' ELSE 'promoted_to_production' END AS lifecycle_status,
        CASE WHEN NOT testing_passed THEN 'testing' WHEN NOT staging_passed THEN 'testing>staging>testing' ELSE 'testing>staging>production' END AS stages
        FROM decided""",
        "decided",
    ),
)
def _lifecycle_stages(spark, folder):
    """The stage of every version, folded from its events."""
    return gov.current_stages(gov.stage_events(_decided(spark, folder))).withColumn("stages", F.array_join("stages", ">"))


@query(
    "params_json",
    sql("""SELECT run_id, '{"series":"' || split_part(run_id, '-', 1) || '","year":"' || right(run_id, 4) || '"}' AS params_json FROM runs""", "runs"),
)
def _params_json(spark, folder):
    part = F.split("run_id", "-")
    params = F.create_map(F.lit("series"), part[0], F.lit("year"), F.element_at(part, -1))
    return _runs(spark, folder).select("run_id", F.to_json(params).alias("params_json"))


@query(
    "metric_direction",
    sql(
        """SELECT metric, minimise, count(*) AS n FROM (SELECT metric, regexp_matches(metric, 'rmse|mae|mape|loss|error') AS minimise
        FROM (SELECT run_id, test_rmse, test_r2 FROM defaulted) UNPIVOT (v FOR metric IN (test_rmse, test_r2))) GROUP BY ALL""",
        "defaulted",
    ),
)
def _metric_direction(spark, folder):
    df = gov.with_metric_defaults(_runs(spark, folder)).unpivot("run_id", ["test_rmse", "test_r2"], "metric", "v")
    return df.groupBy("metric", is_minimised(F.col("metric")).alias("minimise")).agg(F.count("*").alias("n"))


CTES["configs"] = (
    ("half_years",),
    """SELECT series_id AS key, y AS run_ts, arg_min(model, (rmse, model)) AS model_name, '{"year":"' || y || '"}' AS params_json
    FROM (SELECT series_id, y, model, round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse FROM half_years GROUP BY ALL)
    GROUP BY series_id, y""",
)


@query(
    "best_config",
    sql(
        """SELECT key, run_ts, model_name, params_json, old_model, old_params,
        model_name IS DISTINCT FROM old_model OR params_json IS DISTINCT FROM old_params AS changed FROM (
        SELECT *, lag(model_name) OVER w AS old_model, lag(params_json) OVER w AS old_params, row_number() OVER (PARTITION BY key ORDER BY run_ts DESC) AS k
        FROM configs WINDOW w AS (PARTITION BY key ORDER BY run_ts)) WHERE k = 1""",
        "configs",
    ),
)
def _best_config(spark, folder):
    long = _half_years(spark, folder).withColumn("y", F.year("date").cast("long"))
    scores = long.groupBy("series_id", "model", "y").agg(F.round(metric_columns()["rmse"], 6).alias("rmse"))
    winners = scores.groupBy("series_id", "y").agg(F.min_by("model", F.struct("rmse", "model")).alias("model_name"))
    configs = winners.select(
        F.col("series_id").alias("key"), F.col("y").alias("run_ts"), "model_name",
        F.to_json(F.create_map(F.lit("year"), F.col("y").cast("string"))).alias("params_json"),
    )
    return gov.best_config(configs)


@query(
    "deploy_manifest",
    sql(
        """SELECT model_name, max(version) AS model_version, 'passed_testing_and_staging' AS promotion_reason,
        'models:/' || model_name || '@production' AS production_model_uri FROM decided WHERE final_state = 'production' GROUP BY model_name""",
        "decided",
    ),
)
def _deploy_manifest(spark, folder):
    out = gov.deploy_manifest(_decided(spark, folder), "deploy/model", "deploy/features")
    return out.select("model_name", "model_version", "promotion_reason", "production_model_uri")
