"""Whole dataflows, from tables or files to a result."""

from rankflow.plans.classifier import (
    DEFAULT_GRID,
    FeatureSpec,
    PASSENGER_FEATURES,
    classify,
    classify_passengers,
    fit_cross_validated,
    index_features,
    index_label,
    prepare_passengers,
    submit_passengers,
)
from rankflow.plans.duplicates import pair_features, pair_features_from_files
from rankflow.plans.evaluation import map_at_k, mean_average_precision, score_list_files
from rankflow.plans.recommender import (
    hotel_rules,
    interactions_and_requests,
    recommend,
    recommend_hotels,
    submit_hotels,
)

__all__ = [
    "DEFAULT_GRID",
    "FeatureSpec",
    "PASSENGER_FEATURES",
    "classify",
    "classify_passengers",
    "fit_cross_validated",
    "hotel_rules",
    "index_features",
    "index_label",
    "interactions_and_requests",
    "map_at_k",
    "mean_average_precision",
    "pair_features",
    "pair_features_from_files",
    "prepare_passengers",
    "recommend",
    "recommend_hotels",
    "score_list_files",
    "submit_hotels",
    "submit_passengers",
]
