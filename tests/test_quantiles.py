import numpy as np
import pytest

from pricecast.operators import eda


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_equal_to_sorting(spark, bins):
    """Skewed, tied and constant groups; the ends and in between."""
    r = np.random.default_rng(0)
    groups = {"heavy": r.standard_cauchy(500), "ties": r.integers(0, 4, 301).astype(float), "flat": np.full(9, 2.5), "one": np.array([7.0]), "two": np.array([1.0, 1e9])}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("heavy", None), ("heavy", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "series_id string, x double").repartition(3)
    qs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r.series_id: r.quantiles for r in eda.exact_quantiles(df, "x", qs, bins=bins).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        np.testing.assert_allclose(got[k], np.quantile(x, qs), rtol=1e-12)
