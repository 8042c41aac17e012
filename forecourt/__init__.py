"""Listing analytics on Spark: quality, market features, as-of joins, drift, decisions and pricing models."""

from .functions.request_features import add_features
from .operators.asof import asof_join, point_in_time_join
from .operators.calendar import add_calendar_cols, holdout_cutoff, time_based_split
from .operators.decisions import (
    RetrainPolicy,
    Thresholds,
    check_prediction_sanity,
    check_thresholds,
    combine,
    decide_promotion,
    decide_retraining,
)
from .operators.market_index import compute_market_index
from .operators.model_input import to_model_input
from .operators.price_model import TrainingParams, build_pipeline, evaluate_model, score_batch, train_model
from .operators.profile import baseline_profile, drift_from_profile, sliced_drift
from .operators.psi import categorical_psi, compute_drift, drift_summary, numeric_psi
from .operators.quality import filter_valid, gate, quarantine, validate_listings
from .operators.regression import monitor_metrics, prediction_sanity, regression_metrics, sliced_profile
from .operators.upsert import backfill_labels, upsert

__all__ = [
    "RetrainPolicy",
    "Thresholds",
    "TrainingParams",
    "add_calendar_cols",
    "add_features",
    "asof_join",
    "backfill_labels",
    "baseline_profile",
    "build_pipeline",
    "categorical_psi",
    "check_prediction_sanity",
    "check_thresholds",
    "combine",
    "compute_drift",
    "compute_market_index",
    "decide_promotion",
    "decide_retraining",
    "drift_from_profile",
    "drift_summary",
    "evaluate_model",
    "filter_valid",
    "gate",
    "holdout_cutoff",
    "monitor_metrics",
    "numeric_psi",
    "point_in_time_join",
    "prediction_sanity",
    "quarantine",
    "regression_metrics",
    "score_batch",
    "sliced_drift",
    "sliced_profile",
    "time_based_split",
    "to_model_input",
    "train_model",
    "upsert",
    "validate_listings",
]
