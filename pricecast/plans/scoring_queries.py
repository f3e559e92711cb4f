"""Queries that score requests, as a table and as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricecast.config import SelectionConfig, feature_names
from pricecast.functions.text import parse_history
from pricecast.operators import governance as gov
from pricecast.operators import ranking
from pricecast.operators import score as sc
from pricecast.operators.gram import ridge_fit
from pricecast.operators.regress import ridge_pipeline
from pricecast.operators.windows import sequence_windows
from pricecast.plans import frames
from pricecast.plans.catalog import query, r, rounded
from pricecast.plans.model_queries import ALL, ALPHA, ONE, _feature_split, _scores_sql
from pricecast.plans.oracle import CTES, add_ridge, sql
from pricecast.session import materialise, shared_dir
from pricecast.sources.files import Bundle
from pricecast.streaming.scoring import REQUEST_SCHEMA, read_requests, start_scoring, start_scoring_deployed

MAP_FEATURES = ["price_lag_1", "open", "vol"]


def _map_requests(spark, folder):
    """Feature maps with one defect for some calendar days: a missing, an extra or a wordy value."""
    df = frames.complete_rows(spark, folder)
    day = F.dayofmonth("date")
    text = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    full = F.map_from_arrays(
        F.array(*[F.lit(n) for n in MAP_FEATURES]),
        F.array(text("price_lag_1"), F.when(day == 13, F.lit("n/a")).otherwise(text("open")), text("vol")),
    )
    short = F.map_filter(full, lambda k, v: k != "vol")
    wide = F.map_concat(full, F.create_map(F.lit("bonus"), F.lit("1")))
    features = F.when(day == 11, short).when(day == 12, wide).otherwise(full)
    return df.select("series_id", "date", "split", "price", features.alias("features"))


@query(
    "validate_map_rows",
    sql(
        """SELECT series_id, date, CASE day(date) WHEN 11 THEN 'missing: vol' WHEN 12 THEN 'extra: bonus' WHEN 13 THEN 'not numeric: open'
        ELSE 'accepted' END AS outcome FROM complete""",
        "complete",
    ),
)
def _validate_map_rows(spark, folder):
    good, bad = sc.validate_maps(_map_requests(spark, folder), MAP_FEATURES)
    return good.select("series_id", "date", F.lit("accepted").alias("outcome")).unionByName(
        bad.select("series_id", "date", F.col("reason").alias("outcome"))
    )


CHOSEN = f""", s AS ({_scores_sql()}), k AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY round(score, 6) DESC, position) AS rank,
list_position(['open', 'high', 'low', 'vol', 'change_pct'], feature) AS place FROM s),
chosen AS (SELECT series_id, feature, row_number() OVER (PARTITION BY series_id ORDER BY CASE WHEN rank <= 12 THEN 0 ELSE 1 END,
CASE WHEN rank <= 12 THEN rank ELSE place END) AS position FROM k WHERE rank <= 12 OR place IS NOT NULL),
h AS (SELECT *, greatest(COALESCE(try_cast(regexp_extract(feature, '^price_(lag|roll_(mean|std|min|max))_([0-9]+)$', 3) AS INT), 1),
CASE feature WHEN 'price_return_1' THEN 2 WHEN 'price_return_7' THEN 8 WHEN 'ema_14' THEN 14 WHEN 'volatility_14' THEN 15 ELSE 1 END) AS need FROM chosen)
"""


def _chosen(spark, folder):
    cfg = SelectionConfig(method="f_regression")
    train = _feature_split(spark, folder).where(F.col("split") == "train")
    chosen = ranking.select_features(ranking.rank_features(train, feature_names(), cfg), cfg)
    return chosen.select("series_id", F.col("selected_position").alias("position"), "feature")


@query("min_history", sql(CHOSEN + "SELECT series_id, CAST(max(need) AS BIGINT) AS minimum_history FROM h GROUP BY series_id", "feature_rows"))
def _min_history(spark, folder):
    return rounded(sc.min_history(_chosen(spark, folder), ("series_id",)))


@query(
    "model_metadata",
    sql(
        CHOSEN
        + """SELECT series_id, string_agg(feature, ',' ORDER BY position) AS feature_columns, count(*) AS model_feature_count,
        CAST(max(need) AS BIGINT) AS minimum_history FROM h GROUP BY series_id""",
        "feature_rows",
    ),
)
def _model_metadata(spark, folder):
    meta = sc.model_metadata(_chosen(spark, folder), ("series_id",))
    return rounded(
        meta.select("series_id", F.array_join("model_feature_columns", ",").alias("feature_columns"), "model_feature_count", "minimum_history")
    )


@query(
    "parse_history",
    sql(
        """SELECT series_id, date, CAST(3 AS BIGINT) AS n_values, round(price_lag_2 + price_lag_1 + price, 2) + 0.0 AS total, price AS newest
        FROM complete""",
        "complete",
    ),
)
def _parse_history(spark, folder):
    text = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    df = frames.complete_rows(spark, folder).withColumn(
        "text", F.concat(text("price_lag_2"), F.lit(", "), text("price_lag_1"), F.lit(",, x,"), text("price"))
    )
    values = parse_history(F.col("text"))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return rounded(
        df.select("series_id", "date", F.size(values).cast("long").alias("n_values"), total.alias("total"), F.element_at(values, -1).alias("newest")), 2
    )


def _requests(spark, folder):
    """One request per bar with the 30 prices before it; the 13th of a month is sent as unreadable text."""
    df = sequence_windows(frames.split_bars(spark, folder).withColumn("change_pct", F.coalesce("change_pct", F.lit(0.0))), "price", 30)
    text = F.when(F.dayofmonth("date") == 13, F.lit("13th")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    return df.select(
        F.concat_ws("|", "series_id", F.date_format("date", "yyyy-MM-dd")).alias("request_id"),
        "series_id", text.alias("date"), "open", "high", "low", "vol", "change_pct", F.col("sequence").alias("price_history"), "split",
    )


LAGS = (1, 2, 3, 5, 7, 14, 21, 30)
CTES["payloads"] = (
    ("derived",),
    """SELECT d.*, (lag(price, 1) OVER w - lag(price, 2) OVER w) / CASE WHEN abs(lag(price, 2) OVER w) > 1e-8 THEN lag(price, 2) OVER w ELSE 1e-8 END AS r1,
    (lag(price, 1) OVER w - lag(price, 8) OVER w) / CASE WHEN abs(lag(price, 8) OVER w) > 1e-8 THEN lag(price, 8) OVER w ELSE 1e-8 END AS r7,
    series_id || '|' || strftime(date, '%Y-%m-%d') AS request_id FROM derived d WINDOW w AS (PARTITION BY series_id ORDER BY date)""",
)
CTES["short_emas"] = (
    ("bars",),
    """SELECT b.series_id, b.rn, sum(h.price * CASE WHEN h.rn = b.rn - 30 THEN pow(CAST(13.0/15.0 AS DOUBLE), 29)
    ELSE CAST(2.0/15.0 AS DOUBLE) * pow(CAST(13.0/15.0 AS DOUBLE), b.rn - 1 - h.rn) END) AS e
    FROM bars b JOIN bars h ON h.series_id = b.series_id AND h.rn BETWEEN b.rn - 30 AND b.rn - 1 WHERE b.rn > 30 GROUP BY b.series_id, b.rn""",
)
STATS = [f"price_roll_{s}_{n}" for n in (7, 14, 30) for s in ("mean", "std", "min", "max")]


@query(
    "simple_payload_features",
    sql(
        "SELECT p.request_id, "
        + ", ".join(f"p.price_lag_{k}" for k in LAGS)
        + ", "
        + ", ".join(r(f"p.{c}", 4, c) for c in STATS)
        + """, round(r1, 8) + 0.0 AS price_return_1, round(r7, 8) + 0.0 AS price_return_7, round(e, 4) + 0.0 AS ema_14,
        round(p.volatility_14, 8) + 0.0 AS volatility_14, CAST(isodow(p.date) - 1 AS DOUBLE) AS day_of_week, CAST(week(p.date) AS DOUBLE) AS week_of_year
        FROM payloads p JOIN short_emas s ON s.series_id = p.series_id AND s.rn = p.rn WHERE day(p.date) <> 13""",
        "payloads", "short_emas",
    ),
)
def _simple_payload_features(spark, folder):
    good, _ = sc.derive_simple(_requests(spark, folder), feature_names())
    names = [*[f"price_lag_{k}" for k in LAGS], *STATS, "price_return_1", "price_return_7", "ema_14", "volatility_14", "day_of_week", "week_of_year"]
    return rounded(good.select("request_id", *names), 4, price_return_1=8, price_return_7=8, volatility_14=8)


@query(
    "refused_payloads",
    sql("SELECT series_id || '|' || strftime(date, '%Y-%m-%d') AS request_id, 'date must be a day written as 2024-01-31' AS reason FROM bars WHERE rn > 30 AND day(date) = 13", "bars"),
)
def _refused_payloads(spark, folder):
    _, bad = sc.derive_simple(_requests(spark, folder), feature_names())
    return bad.select("request_id", "reason")


def _all_coefficients(spark, folder):
    return ridge_fit(_feature_split(spark, folder).where(F.col("split") == "train"), feature_names(), ALPHA)


add_ridge("ridge_map", "complete", MAP_FEATURES, ALPHA)


@query(
    "score_map_rows",
    sql(
        """SELECT c.series_id, c.date, round(b0 + list_dot_product(b, [price_lag_1, open, vol]), 2) + 0.0 AS prediction
        FROM complete c JOIN ridge_map USING (series_id) WHERE day(date) NOT IN (11, 12, 13)""",
        "complete", "ridge_map",
    ),
)
def _score_map_rows(spark, folder):
    good, _ = sc.validate_maps(_map_requests(spark, folder), MAP_FEATURES)
    train = frames.complete_rows(spark, folder).where(F.col("split") == "train")
    scored = sc.score_with_coefficients(good, ridge_fit(train, MAP_FEATURES, ALPHA))
    return rounded(scored.select("series_id", "date", "prediction"), 2)


# A payload's own features: what its history gives in place of the table's returns and exponential mean.
PAYLOAD = ALL.replace("CAST(price_return_1 ", "CAST(r1 ").replace("CAST(price_return_7 ", "CAST(r7 ").replace("CAST(ema_14 ", "CAST(e ")
for plain, text in {
    "change_pct": "COALESCE(change_pct, 0.0)", "day_of_week": "isodow(date) - 1", "day_of_month": "day(date)", "week_of_year": "week(date)",
    "month": "month(date)", "quarter": "quarter(date)", "year": "year(date)",
    "is_month_start": "CASE WHEN day(date) = 1 THEN 1 ELSE 0 END", "is_month_end": "CASE WHEN date = last_day(date) THEN 1 ELSE 0 END",
}.items():
    PAYLOAD = PAYLOAD.replace(f"CAST({plain} AS", f"CAST({text} AS")
SCORED = f"""SELECT request_id, CASE WHEN day(date) <> 13 THEN round(b0 + list_dot_product(b, {PAYLOAD}), 2) + 0.0 END AS prediction,
    CASE WHEN day(date) = 13 THEN 'date must be a day written as 2024-01-31' END AS reason
    FROM (SELECT p.*, s.e FROM payloads p JOIN short_emas s ON s.series_id = p.series_id AND s.rn = p.rn) JOIN ridge_all USING (series_id)"""


@query("score_simple_rows", sql(f"SELECT request_id, prediction FROM ({SCORED}) WHERE reason IS NULL", "payloads", "short_emas", "ridge_all"))
def _score_simple_rows(spark, folder):
    names = feature_names()
    good, _ = sc.derive_simple(_requests(spark, folder), names)
    x = F.array(*[F.col(n).cast("double") for n in names])
    scored = sc.score_with_coefficients(good.withColumn("x", x), _all_coefficients(spark, folder))
    return rounded(scored.select("request_id", "prediction"), 2)


@query("stream_score_simple", sql(SCORED, "payloads", "short_emas", "ridge_all"))
def _stream_score_simple(spark, folder):
    """All requests written as files, scored by a stream and read back from its sink, refused ones with their reason."""
    base = f"{shared_dir(spark)}/pricecast/stream-{uuid.uuid4().hex}"
    _requests(spark, folder).select(*[f.name for f in REQUEST_SCHEMA]).write.parquet(f"{base}/in")
    _all_coefficients(spark, folder).write.parquet(f"{base}/coefficients")
    coefficients = spark.read.parquet(f"{base}/coefficients")

    def score(good):
        x = F.array(*[F.col(n).cast("double") for n in feature_names()])
        scored = sc.score_with_coefficients(good.withColumn("x", x), coefficients)
        return scored.select("request_id", "prediction", "reason")

    stream = start_scoring(read_requests(spark, f"{base}/in"), feature_names(), score, f"{base}/out", f"{base}/state")
    stream.awaitTermination()
    return rounded(spark.read.schema("request_id string, prediction double, reason string").parquet(f"{base}/out"), 2)


STIFF = 25.0  # penalty of the second version
add_ridge("ridge_stiff", "feature_rows", feature_names(), STIFF)


@query(
    "stream_hot_swap",
    sql(
        " UNION ALL ".join(
            f"""SELECT request_id, CASE WHEN day(date) <> 13 THEN round(b0 + list_dot_product(b, {PAYLOAD}), 2) + 0.0 END AS prediction,
            CASE WHEN day(date) = 13 THEN 'date must be a day written as 2024-01-31' END AS reason, CAST({version} AS BIGINT) AS version
            FROM (SELECT p.*, s.e FROM payloads p JOIN short_emas s ON s.series_id = p.series_id AND s.rn = p.rn) JOIN {model} USING (series_id)
            WHERE {days}"""
            for version, model, days in ((1, "ridge_all", "day(date) <= 15"), (2, "ridge_stiff", "day(date) > 15"))
        ),
        "payloads", "short_emas", "ridge_all", "ridge_stiff",
    ),
)
def _stream_hot_swap(spark, folder):
    """Requests of the first half of each month meet version 1; the second is deployed before those of the other half."""
    base = f"{shared_dir(spark)}/pricecast/swap-{uuid.uuid4().hex}"
    names = feature_names()
    asked = materialise(_requests(spark, folder).select(*[f.name for f in REQUEST_SCHEMA]), "requests")
    train = materialise(_feature_split(spark, folder).where(F.col("split") == "train"), "train")
    positions = spark.createDataFrame(list(enumerate(names)), "position int, feature string")
    late = F.substring("request_id", -2, 2).cast("int") > 15
    for version, (alpha, half) in enumerate(((ALPHA, ~late), (STIFF, late)), 1):
        decision = spark.createDataFrame([("price_model", version, "production", "passed_testing_and_staging")], "model_name string, version long, final_state string, reason string")
        gov.deploy_version(decision, Bundle(ridge_fit(train, names, alpha), names), positions, f"{base}/deploy")
        asked.where(half).write.mode("append").parquet(f"{base}/in")
        stream = start_scoring_deployed(read_requests(spark, f"{base}/in"), f"{base}/deploy", "price_model", f"{base}/out", f"{base}/state")
        stream.awaitTermination()
    return rounded(spark.read.parquet(f"{base}/out").select("request_id", "prediction", "reason", "version"), 2)


@query(
    "pipeline_scores",
    sql(
        f""", m AS (SELECT avg(price_lag_1) AS mx, avg(price) AS my, stddev_pop(price_lag_1) AS sx, covar_pop(price, price_lag_1) AS c,
        count(*) AS k FROM complete WHERE split = 'train')
        SELECT series_id, date, round(my + (price_lag_1 - mx) / sx * (k * c / sx / (k + {ALPHA})), 3) + 0.0 AS prediction
        FROM complete, m WHERE split = 'test'""",
        "complete",
    ),
)
def _pipeline_scores(spark, folder):
    """One MLlib pipeline for all series with the same penalty."""
    df = frames.complete_rows(spark, folder)
    train = df.where(F.col("split") == "train")
    size = train.agg(F.count("*").alias("n"), F.stddev_pop("price").alias("s")).first()
    model = ridge_pipeline(ONE, ALPHA, size["n"], size["s"]).fit(train)
    scored = sc.score_with_pipeline(df.where(F.col("split") == "test"), model)
    return rounded(scored.select("series_id", "date", "prediction"), 3)
