"""Price models on Spark ML."""

from fareflow.pricing.features import feature_stages, label_index, split_rows
from fareflow.pricing.models import (
    best_model,
    fit_models,
    leaderboard,
    load_model,
    one_split_tree,
    price_regressors,
    regression_metrics,
    save_model,
    score,
)

__all__ = [
    "best_model",
    "feature_stages",
    "fit_models",
    "label_index",
    "leaderboard",
    "load_model",
    "one_split_tree",
    "price_regressors",
    "regression_metrics",
    "save_model",
    "score",
    "split_rows",
]
