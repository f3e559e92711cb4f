"""Feature scores, ranking and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricecast.config import SelectionConfig
from pricecast.operators.evaluate import safe_corr
from pricecast.operators.features import existing_features
from pricecast.operators.trees import ForestParams, grow_random_forest

# Score of a feature that explains the target perfectly: the largest double.
PERFECT = 1.7976931348623157e308


def _scores_to_rows(wide: DataFrame, features: list[str], scores: list, keys: list[str]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), s.alias("score")) for i, (f, s) in enumerate(zip(features, scores))]
    )
    return wide.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def f_regression(df: DataFrame, features: list[str], target: str = "price", keys=("series_id",)) -> DataFrame:
    """Univariate F score of every feature; all correlations come from one aggregation.

    A constant feature scores 0, a perfect one the largest double.
    """
    features = existing_features(df, features)
    wide = df.groupBy(*keys).agg(
        F.count("*").alias("_n"), *[safe_corr(F.col(f), F.col(target)).alias(f"r_{f}") for f in features]
    )
    scores = []
    for f in features:
        r2 = F.col(f"r_{f}") * F.col(f"r_{f}")
        ratio = r2 / F.when(r2 < 1, 1 - r2) * (F.col("_n") - 2)
        scores.append(
            F.when(r2.isNull() | F.isnan(r2), F.lit(0.0)).when(r2 >= 1, F.lit(PERFECT)).otherwise(ratio)
        )
    return _scores_to_rows(wide, features, scores, list(keys))


def forest_importance(df: DataFrame, features: list[str], target: str = "price", cfg: SelectionConfig = SelectionConfig(), max_depth: int | None = None) -> DataFrame:
    """Impurity importance of a random forest over all rows given; names joined to scores by position."""
    params = ForestParams(n_estimators=cfg.n_estimators, max_depth=max_depth)
    return grow_random_forest(df, existing_features(df, features), target, params, cfg.random_state).importance()


def rank(scores: DataFrame, keys=("series_id",)) -> DataFrame:
    """Add ``rank``, best score first; at most one row per feature and key.

    Scores equal to six decimals are ties and keep table order: proportional features, such as a return and the same
    return in percent, differ by rounding only.
    """
    order = (F.round("score", 6).desc_nulls_last(), "position")
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return scores.withColumn("rank", F.row_number().over(w))


def select_features(ranked: DataFrame, cfg: SelectionConfig = SelectionConfig(), keys=("series_id",)) -> DataFrame:
    """The top k (clipped to 1..n), then mandatory features not among them, in the order they are listed."""
    listed = F.array(*[F.lit(m) for m in cfg.mandatory_features])
    place = F.array_position(listed, F.col("feature"))
    chosen = F.col("rank") <= max(1, cfg.top_k)
    kept = ranked.where(chosen | (place > 0)).withColumn("_late", F.when(chosen, F.lit(0)).otherwise(1))
    order = [F.col("_late"), F.when(F.col("_late") == 0, F.col("rank").cast("long")).otherwise(place)]
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return kept.withColumn("selected_position", F.row_number().over(w)).drop("_late")


def rank_features(df: DataFrame, features: list[str], cfg: SelectionConfig = SelectionConfig(), keys=("series_id",)) -> DataFrame:
    """Ranked features by the configured method: ``none``, ``f_regression`` or ``random_forest_importance``."""
    if cfg.method == "none":
        scores = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
        scores = _scores_to_rows(scores, features, [F.lit(0.0)] * len(features), list(keys))
        return rank(scores, keys)
    if cfg.method == "f_regression":
        return rank(f_regression(df, features, keys=keys), keys)
    if cfg.method == "random_forest_importance":
        return rank(forest_importance(df, features, cfg=cfg), ())
    raise ValueError(f"no ranking is called {cfg.method!r}; there are none, f_regression and random_forest_importance")
