"""Scoring, anomaly detection and drift monitoring for event tables and streams."""

from streamwatch.operators.anomaly import flagged_only, iqr_anomalies, iqr_bounds, zscore_anomalies
from streamwatch.operators.drift import (
    baseline_drift_alerts,
    data_drift,
    data_drift_alerts,
    label_drift,
    label_drift_alerts,
    monitoring_report,
    performance,
    prediction_drift,
)
from streamwatch.operators.isolation_forest import IsolationForestModel, fit_isolation_forest
from streamwatch.operators.scoring import load_model, save_model, score_events, train_classifier
from streamwatch.operators.window_stats import amount_statistics
from streamwatch.schema import EVENT_SCHEMA, FEATURE_COLUMNS
from streamwatch.session import build_session, fresh_folder

__all__ = [
    "EVENT_SCHEMA",
    "FEATURE_COLUMNS",
    "IsolationForestModel",
    "amount_statistics",
    "baseline_drift_alerts",
    "build_session",
    "data_drift",
    "data_drift_alerts",
    "fit_isolation_forest",
    "flagged_only",
    "fresh_folder",
    "iqr_anomalies",
    "iqr_bounds",
    "label_drift",
    "label_drift_alerts",
    "load_model",
    "monitoring_report",
    "performance",
    "prediction_drift",
    "save_model",
    "score_events",
    "train_classifier",
    "zscore_anomalies",
]
