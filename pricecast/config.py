"""Settings of each stage. The defaults are fixed values that results must agree with."""

from __future__ import annotations

from dataclasses import dataclass, field

RAW_COLUMNS = ("Date", "Price", "Open", "High", "Low", "Vol.", "Change %")

# Raw column -> name used inside the library (dots break vector assembly).
SNAKE_NAMES = {
    "Date": "date",
    "Price": "price",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Vol.": "vol",
    "Change %": "change_pct",
}

CALENDAR_FEATURES = (
    "day_of_week",
    "day_of_month",
    "week_of_year",
    "month",
    "quarter",
    "year",
    "is_month_start",
    "is_month_end",
)


@dataclass(frozen=True)
class CleaningConfig:
    keep_weekdays_only: bool = True
    date_formats: tuple[str, ...] = ("yyyy-MM-dd", "MM/dd/yyyy")


@dataclass(frozen=True)
class FeatureConfig:
    lags: tuple[int, ...] = (1, 2, 3, 5, 7, 14, 21, 30)
    rolling_windows: tuple[int, ...] = (7, 14, 30)
    ema_span: int = 14
    volatility_window: int = 14
    # True: returns include the current row. False: every derived column is shifted by one row.
    leaky: bool = True


@dataclass(frozen=True)
class SelectionConfig:
    method: str = "random_forest_importance"
    top_k: int = 12
    n_estimators: int = 400
    random_state: int = 42
    mandatory_features: tuple[str, ...] = ("open", "high", "low", "vol", "change_pct")


@dataclass(frozen=True)
class TrainingConfig:
    model_name: str = "ridge"
    test_size: int = 252
    cv_splits: int = 5
    n_iter: int = 30
    random_state: int = 42
    fixed_params: dict = field(default_factory=lambda: {"alpha": 0.2196385372416547})


@dataclass(frozen=True)
class ExperimentConfig:
    models: tuple[str, ...] = ("ridge", "random_forest", "gradient_boosting", "extra_trees")
    n_iter_per_model: int = 10
    cv_splits: int = 3
    random_state: int = 42
    optimization_metric: str = "test_rmse"


@dataclass(frozen=True)
class ResearchConfig:
    test_size: int = 252
    lags: tuple[int, ...] = (1, 2, 3, 5, 7, 14, 21, 30)
    ar_order: tuple[int, int, int] = (5, 1, 0)
    rolling_window: int = 30
    rolling_min_periods: int = 5
    volatility_window: int = 14
    high_volatility_quantile: float = 0.75
    procurement_volume_tons: float = 10_000.0
    ewma_lambda: float = 0.94
    sequence_length: int = 30
    validation_ratio: float = 0.15
    epochs: int = 80
    patience: int = 12


@dataclass(frozen=True)
class GateConfig:
    max_test_rmse: float = 0.5
    max_test_mape: float = 0.01
    min_test_r2: float = 0.99
    max_rmse_drift_pct: float = 20.0
    max_mape: float = 0.01
    min_r2: float = 0.99


# Search spaces of the model families: fixed values.
SEARCH_SPACES = {
    "ridge": {"alpha": [10 ** (-4 + 7 * i / 199) for i in range(200)]},
    "random_forest": {
        "n_estimators": [200, 300, 500, 800],
        "max_depth": [None, 8, 12, 16, 24],
        "min_samples_split": [2, 4, 8, 12],
        "min_samples_leaf": [1, 2, 4, 6],
        "max_features": ["sqrt", "log2", 0.6, 0.8, 1.0],
    },
    "gradient_boosting": {
        "n_estimators": [150, 250, 350, 500],
        "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2],
        "max_depth": [2, 3, 4, 5],
        "subsample": [0.6, 0.8, 1.0],
        "min_samples_split": [2, 4, 8],
        "min_samples_leaf": [1, 2, 4],
    },
    "extra_trees": {
        "n_estimators": [200, 300, 500, 800],
        "max_depth": [None, 8, 12, 16, 24],
        "min_samples_split": [2, 4, 8],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2", 0.6, 0.8, 1.0],
    },
}


def feature_names(cfg: FeatureConfig = FeatureConfig()) -> list[str]:
    """All feature columns in table order: bar columns, calendar, lags, rolls, derived."""
    names = ["open", "high", "low", "vol", "change_pct", *CALENDAR_FEATURES]
    names += [f"price_lag_{k}" for k in cfg.lags]
    for w in cfg.rolling_windows:
        names += [f"price_roll_{stat}_{w}" for stat in ("mean", "std", "min", "max")]
    return names + ["price_return_1", "price_return_7", "ema_14", "volatility_14"]


def public_name(name: str) -> str:
    """Library column name -> the name used in files (``price_lag_1`` -> ``Price_lag_1``)."""
    back = {v: k for k, v in SNAKE_NAMES.items()}
    if name in back:
        return back[name]
    if name.startswith(("price_lag_", "price_roll_")):
        return "P" + name[1:]
    return name
