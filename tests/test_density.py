import numpy as np
import pytest
from pyspark.sql import functions as F

from pricecast.operators import eda


@pytest.mark.parametrize("kind", ["normal", "heavy", "few"])
def test_density_equals_the_sum_of_kernels(spark, kind):
    r = np.random.default_rng(1)
    x = {"normal": r.normal(5, 2, 700), "heavy": r.standard_cauchy(400) * 3, "few": np.array([1.0, 1.0, 4.0])}[kind]
    df = spark.createDataFrame([("k", float(v)) for v in x] + [("flat", 2.0), ("flat", 2.0), ("k", None)], "key string, x double").repartition(3)
    got = eda.density(df, "x", ["key"], 60).orderBy("point").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * bw, x.max() + 3 * bw, 60)
    want = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(axis=1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert {r.key for r in got} == {"k"} and len(got) == 60
    np.testing.assert_allclose([r.x for r in got], grid, rtol=1e-9)
    np.testing.assert_allclose([r.density for r in got], want, rtol=1e-9, atol=1e-15)


def test_one_row_a_bin_is_shuffled(spark):
    """Fifty thousand values in about as many bins as there are half bandwidths."""
    df = spark.range(50_000).select(F.lit("k").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(10_007)) / 10_007).alias("x"))
    out = eda.density(df, "x", ["key"], 20)
    assert abs(out.where("point BETWEEN 5 AND 14").agg(F.avg("density")).first()[0] - 1) < 0.02
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1]
