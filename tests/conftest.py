import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pricecast.session import get_session

    s = get_session("local[8]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def prices():
    """Two series of weekday prices as a pandas frame."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    days = pd.bdate_range("2020-01-01", periods=420)
    parts = []
    for name, level in (("a", 130.0), ("b", 20.0)):
        p = level + np.cumsum(rng.normal(0, level / 100, len(days)))
        parts.append(pd.DataFrame({"series_id": name, "date": days.date, "price": p}))
    out = pd.concat(parts, ignore_index=True)
    out["open"] = out.price + 0.1
    out["high"] = out.price + 1
    out["low"] = out.price - 1
    out["vol"] = 1000.0
    out["change_pct"] = out.groupby("series_id").price.pct_change().fillna(0.0) * 100
    return out


@pytest.fixture(scope="session")
def panel(spark, prices):
    return spark.createDataFrame(prices).cache()
