"""Times the catalogue's headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricecast.plans import registry  # noqa: E402
from pricecast.session import get_session  # noqa: E402

HEADLINE = (
    "daily_bars brand_bars features_lag_roll holdout_split clean_volume coerce_dates dedupe_last fill_forward_back "
    "cleaning_report ema_14 volatility_14 feature_table sequence_windows describe month_box correlation_matrix "
    "residual_histogram leaderboard best_model ewma_variance walk_forward_folds f_regression_rank select_features "
    "alpha_grid ridge_forecast ar5_diff_forecast damped_trend_grid gbt_forecast lifecycle_decision alias_view "
    "simple_payload_features score_map_rows score_simple_rows stream_score_simple tick_positions tick_lag_roll tick_ema tick_fill"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["ingest_report"](spark, folder).collect()  # start-up costs stay out of the first number
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
