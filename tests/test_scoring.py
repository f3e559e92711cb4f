import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricecast.config import feature_names
from pricecast.operators import score as sc
from pricecast.operators.regress import ridge_pipeline
from pricecast.sources import files
from pricecast.streaming.scoring import REQUEST_SCHEMA, read_requests, start_scoring

HISTORY = [float(x) for x in 100 + np.cumsum(np.random.default_rng(1).normal(0, 1, 30))]


def request(i, date="2023-12-29", history=HISTORY):
    return (str(i), "a", date, 1.0, 2.0, 0.5, 0.0, 0.15, history)


def test_needed_history(spark):
    assert sc.needed_history(["open"]) == 1
    assert sc.needed_history(["Price_lag_21", "volatility_14"]) == 21
    assert sc.needed_history(["price_roll_std_30"]) == 30 and sc.needed_history(["ema_14"]) == 14
    rows = spark.createDataFrame([("m", 2, "price_return_7"), ("m", 1, "open")], "k string, position int, feature string")
    meta = sc.model_metadata(rows, ("k",)).first()
    assert (meta.minimum_history, meta.model_feature_count, meta.model_feature_columns) == (8, 2, ["open", "price_return_7"])


def test_maps(spark):
    maps = [{"a": "1", "b": "2"}, {"a": "1"}, {"a": "1", "b": "2", "c": "3"}, {"a": "1", "b": "x"}, {"c": "3"}, None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, features map<string,string>")
    good, bad = sc.validate_maps(df, ["b", "a"])
    assert [(r.i, r.x) for r in good.collect()] == [(0, [2.0, 1.0])]
    assert [r.reason for r in bad.orderBy("i").collect()] == ["missing: b", "extra: c", "not numeric: b", "missing: a,b", "missing: all"]
    with pytest.raises(ValueError):
        sc.require_rows(df.where("i > 9"))


def test_simple_features(spark):
    df = spark.createDataFrame([request(0)], REQUEST_SCHEMA)
    good, bad = sc.derive_simple(df, feature_names())
    row, h = good.first(), pd.Series(HISTORY)
    assert bad.count() == 0
    assert row.price_lag_1 == HISTORY[-1] and row.price_lag_30 == HISTORY[0]
    assert abs(row.price_roll_std_7 - h.iloc[-7:].std()) < 1e-12 and row.price_roll_max_14 == h.iloc[-14:].max()
    assert abs(row.ema_14 - h.ewm(span=14, adjust=False).mean().iloc[-1]) < 1e-10
    assert abs(row.volatility_14 - h.pct_change().rolling(14).std().iloc[-1]) < 1e-12
    assert abs(row.price_return_7 - (HISTORY[-1] / HISTORY[-8] - 1)) < 1e-12
    assert (row.day_of_week, row.week_of_year, row.quarter, row.is_month_end) == (4.0, 52.0, 4.0, 0.0)


def test_refusals(spark):
    nan = float("nan")
    rows = [request(0, "soon"), request(1, history=[]), request(2, history=[1.0]), request(3, history=[nan] * 30), request(4, history=[0.0] * 30)]
    good, bad = sc.derive_simple(spark.createDataFrame(rows, REQUEST_SCHEMA), feature_names())
    reasons = [r.reason for r in bad.orderBy("request_id").collect()]
    assert ["date must", "no price", "too short", "non-finite"] == [w for w, r in zip(("date must", "no price", "too short", "non-finite"), reasons) if w in r]
    zero = good.first()
    assert zero.request_id == "4" and zero.price_return_1 == 0.0 and zero.volatility_14 == 0.0
    with pytest.raises(ValueError):
        sc.derive_simple(spark.createDataFrame(rows, REQUEST_SCHEMA), ["no_such_feature"])


def test_stream_equals_batch(spark, tmp_path):
    names = ["price_lag_1", "ema_14"]
    rng = np.random.default_rng(2)
    rows = [request(i, str(dt.date(2023, 1, 1) + dt.timedelta(days=i)), [float(x) for x in rng.uniform(90, 110, 30)]) for i in range(40)]
    rows.append(request(99, "bad"))
    df = spark.createDataFrame(rows, REQUEST_SCHEMA)
    train = sc.derive_simple(df, names)[0].withColumn("price", F.col("price_lag_1") * 2 + 1)
    path = str(tmp_path / "model")
    files.save_model(ridge_pipeline(names, 0.001, 40, 5.0).fit(train), path)
    model = files.load_model(path)
    score = lambda good: sc.score_with_pipeline(good, model).select("request_id", "prediction")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = start_scoring(read_requests(spark, str(tmp_path / "in"), files_per_trigger=1), names, score, str(tmp_path / "out"), str(tmp_path / "state"))
    stream.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    got = {r.request_id: r.prediction for r in rows if r.reason is None}
    want = {r.request_id: r.prediction for r in score(sc.derive_simple(df, names)[0]).collect()}
    assert got == want and len(got) == 40
    assert [(r.request_id, r.prediction) for r in rows if r.reason] == [("99", None)]


def test_unknown_series_keep_their_request(spark):
    good = spark.createDataFrame([("1", "a", [2.0]), ("2", "z", [2.0])], "request_id string, series_id string, x array<double>")
    beta = spark.createDataFrame([("a", [1.0, 3.0])], "series_id string, beta array<double>")
    rows = {r.request_id: (r.prediction, r.reason) for r in sc.score_with_coefficients(good, beta).collect()}
    assert rows == {"1": (7.0, None), "2": (None, sc.NO_MODEL)}


def test_infinite_prices_are_refused(spark):
    inf = float("inf")
    rows = [request(0, history=[1.0] * 29 + [inf]), request(1, history=[-inf] + [1.0] * 29), request(2, history=[1.0] * 30)]
    df = spark.createDataFrame(rows, REQUEST_SCHEMA)
    good, bad = sc.derive_simple(df, ["price_lag_30"])
    assert [r.request_id for r in good.collect()] == ["2"]
    assert {r.request_id for r in bad.collect()} == {"0", "1"} and {r.reason for r in bad.collect()} == {"price_history holds a missing or non-finite price"}
