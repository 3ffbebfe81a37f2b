"""The three monitoring jobs, from raw messages to a running query.

A job takes the raw messages, so it runs the same on a topic, on files or on a
test source, and returns the started query. It takes events as well, a stream with the fields of one, such as
:func:`streamwatch.streaming.ingest.stream_route` gives: then unreadable and late messages have been put aside before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from streamwatch.functions.messages import decode_events
from streamwatch.functions.sketches import ACCURACY
from streamwatch.operators.anomaly import flagged_only, iqr_anomalies, zscore_anomalies
from streamwatch.operators.drift import (
    BASELINE_RATE_PERCENT,
    DATA_THRESHOLD,
    LABEL_THRESHOLD,
    data_drift_alerts,
    label_drift_alerts,
    monitoring_report,
)
from streamwatch.operators.isolation_forest import IsolationForestModel
from streamwatch.operators.scoring import score_events
from streamwatch.schema import EVENT_SCHEMA
from streamwatch.streaming.sinks import to_console, to_files, to_reports

METHODS = ("zscore", "iqr", "isolation_forest")
DELAY = "10 minutes"


def scoring_job(
    messages: DataFrame,
    model: PipelineModel,
    *,
    path: str | None = None,
    checkpoint: str | None = None,
    keep: Sequence[str] = (),
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Score every message; without ``path`` the scores go to the console."""
    scored = score_events(_events(messages, keep=keep), model)
    output = scored.select(
        *keep, "timestamp", "Amount", "Class", "is_fraud", "fraud_probability"
    )
    return _append(output, path, checkpoint, every, drain)


def anomaly_job(
    messages: DataFrame,
    *,
    method: str = "zscore",
    window: str = "5 minutes",
    threshold: float = 3.0,
    multiplier: float = 1.5,
    accuracy: int = ACCURACY,
    forest: IsolationForestModel | None = None,
    delay: str = DELAY,
    path: str | None = None,
    checkpoint: str | None = None,
    keep: Sequence[str] = (),
    keys: Sequence[str] = (),
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Report anomalies: of each window (and ``keys``, columns of the messages) once it has closed, or by a fitted ``forest`` at once."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, choose from {METHODS}")
    if method == "isolation_forest":
        if forest is None:
            raise ValueError("the isolation forest must be fitted on a table first")
        columns = ["timestamp", *forest.features]
        judged = forest.transform(_events(messages, columns=columns, keep=[*keep, *keys]))
    else:
        events = _events(messages, columns=["timestamp", "Amount"], keep=[*keep, *keys])
        if method == "zscore":
            judged = zscore_anomalies(
                events, window=window, threshold=threshold, delay=delay, keys=keys
            )
        else:
            judged = iqr_anomalies(
                events, window=window, multiplier=multiplier, delay=delay, accuracy=accuracy, keys=keys
            )
    return _append(flagged_only(judged), path, checkpoint, every, drain)


def drift_job(
    messages: DataFrame,
    model: PipelineModel | None = None,
    *,
    window: str = "10 minutes",
    delay: str = DELAY,
    data_threshold: float = DATA_THRESHOLD,
    label_threshold: float = LABEL_THRESHOLD,
    baseline_rate_percent: float = BASELINE_RATE_PERCENT,
    accuracy: int = ACCURACY,
    path: str | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Keep the drift reports and alerts up to date; with a model, those on predictions too."""
    if model is None:
        events = _events(messages, columns=["timestamp", "Amount", "Class"])
        report = monitoring_report(events, window=window, delay=delay, accuracy=accuracy)
    else:
        report = monitoring_report(
            score_events(_events(messages), model),
            probability_col="fraud_probability",
            prediction_col="is_fraud",
            window=window,
            delay=delay,
            accuracy=accuracy,
        )
    report = data_drift_alerts(report, data_threshold)
    report = label_drift_alerts(report, label_threshold, baseline_rate_percent)
    if path is None:
        return to_console(report, mode="update", checkpoint=checkpoint, every=every, drain=drain)
    return to_reports(report, path, _required(checkpoint), every=every, drain=drain)


def _events(
    messages: DataFrame, *, columns: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The fields of raw messages, or of what is already decoded."""
    if "value" in messages.columns:
        return decode_events(messages, columns=columns, keep=keep)
    return messages.select(*keep, *(columns or EVENT_SCHEMA.fieldNames()))


def _append(
    df: DataFrame, path: str | None, checkpoint: str | None, every: str | None, drain: bool
) -> StreamingQuery:
    if path is None:
        return to_console(df, checkpoint=checkpoint, every=every, drain=drain)
    return to_files(df, path, _required(checkpoint), every=every, drain=drain)


def _required(checkpoint: str | None) -> str:
    if checkpoint is None:
        raise ValueError("writing to files needs a checkpoint folder")
    return checkpoint
