import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricecast.config import FeatureConfig, feature_names, public_name
from pricecast.functions.calendar import calendar_columns
from pricecast.operators.features import derived_features, existing_features, feature_list, feature_table, lag_roll_features
from pricecast.operators.layout import BlockLayout, with_positions
from pricecast.operators.recurrence import ema, scan_blocks, scan_series
from pricecast.operators.windows import fill_positions, lag_columns, rolling_columns


def golden(p: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({"price_lag_30": p.shift(30)})
    for w in (7, 30):
        roll = p.shift(1).rolling(w)
        out[f"price_roll_mean_{w}"], out[f"price_roll_std_{w}"] = roll.mean(), roll.std()
        out[f"price_roll_min_{w}"], out[f"price_roll_max_{w}"] = roll.min(), roll.max()
    out["price_return_7"] = p.pct_change(7)
    out["ema_14"] = p.ewm(span=14, adjust=False).mean().shift(1)
    out["volatility_14"] = p.pct_change().rolling(14).std().shift(1)
    return out


def test_against_pandas(panel, prices):
    got = derived_features(lag_roll_features(panel)).toPandas().sort_values(["series_id", "date"])
    for name, rows in got.groupby("series_id"):
        want = golden(prices[prices.series_id == name].price.reset_index(drop=True))
        for c in want.columns:
            np.testing.assert_allclose(rows[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_feature_table(panel):
    df = feature_table(panel)
    assert feature_list(df) == feature_names() and len(feature_names()) == 37
    assert df.count() == 2 * (420 - 30)
    assert public_name("price_lag_1") == "Price_lag_1" and public_name("vol") == "Vol."
    with pytest.raises(ValueError):
        existing_features(df, ["nothing"])


def test_future_rows_change_nothing(panel):
    cut = panel.where(F.col("date") < "2021-03-01")
    names = [n for n in feature_names() if n.startswith(("price_", "ema", "vol"))]
    for cfg in (FeatureConfig(), FeatureConfig(leaky=False)):
        a = feature_table(cut, cfg).select("series_id", "date", *names)
        b = feature_table(panel, cfg).where(F.col("date") < "2021-03-01").select("series_id", "date", *names)
        x, y = (d.toPandas().sort_values(["series_id", "date"]).iloc[:, 2:].to_numpy(float) for d in (a, b))
        np.testing.assert_allclose(x, y, rtol=1e-10, atol=1e-10)


def test_zero_price_is_infinite_return_not_error(spark):
    rows = [("z", f"2024-01-{d:02d}", p) for d, p in ((1, 0.0), (2, 5.0), (3, 0.0), (4, 0.0))]
    df = spark.createDataFrame(rows, "series_id string, date string, price double").withColumn("date", F.to_date("date"))
    got = [r.price_return_1 for r in derived_features(df).orderBy("date").collect()]
    assert got[1] == float("inf") and got[2] == -1.0 and got[3] is None


def test_calendar(spark, prices):
    days = pd.to_datetime(pd.date_range("2019-12-25", "2021-01-10"))
    df = spark.createDataFrame(pd.DataFrame({"date": days.date}))
    got = df.select("date", *[c.alias(k) for k, c in calendar_columns(F.col("date")).items()]).orderBy("date").toPandas()
    assert (got.week_of_year.to_numpy() == days.isocalendar().week.to_numpy()).all()
    assert (got.day_of_week.to_numpy() == days.dayofweek.to_numpy()).all()
    assert (got.is_month_end.to_numpy() == days.is_month_end.astype(int)).all()


@pytest.fixture(scope="module")
def long_panel(spark):
    """One hot series and one short one, on uneven seconds."""
    rng = np.random.default_rng(3)
    parts = []
    for name, n in (("hot", 6000), ("cold", 40)):
        seconds = np.sort(rng.integers(0, 40_000, n))
        parts.append(pd.DataFrame({"series_id": name, "sec": seconds, "tie": np.arange(n), "price": rng.normal(100, 5, n)}))
    pdf = pd.concat(parts, ignore_index=True)
    df = with_positions(spark.createDataFrame(pdf), ("sec", "tie"), 5)
    return pdf, df.cache()


def test_positions(long_panel):
    pdf, df = long_panel
    got = df.toPandas().sort_values(["series_id", "_rn"])
    for _, rows in got.groupby("series_id"):
        assert (rows._rn.to_numpy() == np.arange(1, len(rows) + 1)).all()
        assert (rows.tie.to_numpy() == np.arange(len(rows))).all()


def test_blocks_equal_whole_series(long_panel):
    pdf, df = long_panel
    layout = BlockLayout(64)
    ready = layout.prepare(df, 30)
    got = layout.finish(ready.withColumns({**lag_columns("price", (30,), layout), **rolling_columns("price", (30,), layout)}))
    got = ema(got, "price", 14, "ema", scan_blocks).toPandas()
    assert len(got) == len(pdf)
    for name, rows in got.groupby("series_id"):
        rows, p = rows.sort_values("_rn"), pdf[pdf.series_id == name].price.reset_index(drop=True)
        np.testing.assert_allclose(rows.price_lag_30.to_numpy(float), p.shift(30), rtol=1e-12)
        np.testing.assert_allclose(rows.price_roll_std_30.to_numpy(float), p.shift(1).rolling(30).std(), rtol=1e-8)
        np.testing.assert_allclose(rows.ema.to_numpy(float), p.ewm(span=14, adjust=False).mean(), rtol=1e-11)
    with pytest.raises(ValueError):
        layout.prepare(df, 65)


def test_scans_agree(long_panel):
    _, df = long_panel
    a = ema(df, "price", 14, "e", scan_series).select("series_id", "_rn", "e")
    b = ema(df, "price", 14, "f", scan_blocks).select("series_id", "_rn", "f")
    assert a.join(b, ["series_id", "_rn"]).agg(F.max(F.abs(F.col("e") - F.col("f")))).first()[0] < 1e-9


def test_fill_over_blocks(long_panel):
    pdf, df = long_panel
    gappy = F.when(F.col("price") > 109, F.col("price"))
    got = fill_positions(df.withColumn("price", gappy), "price", size=8).toPandas()
    for name, rows in got.groupby("series_id"):
        p = pdf[pdf.series_id == name].price.reset_index(drop=True)
        np.testing.assert_allclose(rows.sort_values("_rn").price.to_numpy(float), p.where(p > 109).ffill().bfill())


def test_positions_of_one_minute_are_spread(spark):
    """All ticks of a hot series in one minute: every range gets a share, and positions run from 1 to n."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("series_id"), F.lit(60).alias("sec"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("tie"))
    out = with_positions(df, ("sec", "tie"), 8).cache()
    rows = out.groupBy("series_id").agg(F.count("*").alias("n"), F.min("_rn").alias("lo"), F.max("_rn").alias("hi"), F.count_distinct("_rn").alias("d")).collect()
    assert {(r.series_id, r.n, r.lo, r.hi, r.d) for r in rows} == {("a", 18_000, 1, 18_000, 18_000), ("b", 2_000, 1, 2_000, 2_000)}
    w = Window.partitionBy("series_id").orderBy("sec", "tie")
    assert out.where(F.col("_rn") != F.lit(0)).withColumn("want", F.row_number().over(w)).where("want <> _rn").count() == 0
    sizes = df.repartitionByRange(8, "series_id", "sec", "tie").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 20_000 / 8
