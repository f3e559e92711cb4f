"""Every query with a SQL twin agrees with it on the smallest tables; the others return rows."""

import pytest

import compare as cmp
from pricecast.plans import registry

FOLDER = "/root/testdata/sf0.001"
# Tree searches take minutes; bench and the catalogue check run them.
SLOW = {"model_comparison", "forest_importance", "hybrid_inverse_rmse", "residual_multi_step", "gbt_forecast"}


@pytest.fixture(scope="module")
def con():
    return cmp.connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.ORACLE])
def test_matches_sql(spark, con, name):
    ok, text, _ = cmp.compare(spark, con, FOLDER, registry.QUERIES[name], registry.ORACLE[name])
    assert ok, text


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLE and n not in SLOW])
def test_returns_rows(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).take(1)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
