"""Drift of data, labels, predictions and model quality over time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamwatch.functions.sketches import ACCURACY
from streamwatch.functions.values import all_of, finite
from streamwatch.operators.window_stats import (
    Measures,
    extremes,
    moments,
    per_window,
    percentiles,
)
from streamwatch.schema import require_columns

# Alert defaults of the reports.
DATA_THRESHOLD = 0.1
LABEL_THRESHOLD = 0.02
BASELINE_RATE_PERCENT = 0.172

# Columns of each report, besides the window and the keys.
REPORT_COLUMNS = {
    "data": (
        "transaction_count", "avg_amount", "stddev_amount", "invalid_count", "min_amount",
        "max_amount", "median_amount", "p95_amount", "p99_amount",
    ),
    "label": ("total_transactions", "fraud_count", "fraud_rate_percent"),
    "prediction": (
        "predictions_count", "avg_fraud_prob", "stddev_fraud_prob", "median_fraud_prob",
        "p95_fraud_prob",
    ),
    "performance": ("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1_score"),
}
ALERT_COLUMNS = {"data": "has_data_drift", "label": "has_label_drift"}


def _counted(name: str) -> Measures:
    return Measures({}, (F.count("*").alias(name),), (F.col(name),))


def _data_measures(value_col: str, accuracy: int | None) -> Measures:
    cuts = {"median_amount": 0.5, "p95_amount": 0.95, "p99_amount": 0.99}
    return (
        _counted("transaction_count")
        + moments(value_col)
        + extremes(value_col)
        + percentiles("amount", finite(value_col), cuts, accuracy)
    )


def _label_measures(df: DataFrame, label_col: str) -> Measures:
    whole = isinstance(df.schema[label_col].dataType, T.IntegralType)
    return _counted("total_transactions") + Measures(
        {
            "__label": finite(label_col),
            # labels are summed as they are: whole numbers as such, others as doubles
            "__label_sum": F.col(label_col).cast("bigint") if whole else finite(label_col),
        },
        (
            F.sum("__label_sum").alias("fraud_count"),
            F.avg("__label").alias("__label_rate"),
        ),
        (F.col("fraud_count"), (F.col("__label_rate") * 100).alias("fraud_rate_percent")),
    )


def _prediction_measures(probability_col: str, accuracy: int | None) -> Measures:
    probability = finite(probability_col)
    cuts = {"median_fraud_prob": 0.5, "p95_fraud_prob": 0.95}
    return (
        _counted("predictions_count")
        + Measures(
            {"__fraud_prob": probability},
            (
                F.avg("__fraud_prob").alias("avg_fraud_prob"),
                F.stddev_samp("__fraud_prob").alias("stddev_fraud_prob"),
            ),
            (F.col("avg_fraud_prob"), F.col("stddev_fraud_prob")),
        )
        + percentiles("fraud_prob", probability, cuts, accuracy)
    )


def _performance_measures(prediction_col: str, label_col: str) -> Measures:
    def cell(predicted: int, actual: int) -> Column:
        return F.count_if((F.col("__predicted") == predicted) & (F.col("__label") == actual))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return Measures(
        {"__predicted": finite(prediction_col), "__label": finite(label_col)},
        (
            cell(1, 1).alias("tp"),
            cell(1, 0).alias("fp"),
            cell(0, 1).alias("fn"),
            cell(0, 0).alias("tn"),
        ),
        (
            tp,
            fp,
            fn,
            tn,
            F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
            precision.alias("precision"),
            recall.alias("recall"),
            F.try_divide(2 * precision * recall, precision + recall).alias("f1_score"),
        ),
    )


def data_drift(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    window: str = "10 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
    accuracy: int | None = ACCURACY,
) -> DataFrame:
    """Count, mean, deviation, range and percentiles of the amounts in each window."""
    require_columns(df, [value_col])
    measures = _data_measures(value_col, accuracy)
    return per_window(df, measures, ts_col=ts_col, window=window, keys=keys, delay=delay)


def label_drift(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    label_col: str = "Class",
    window: str = "10 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
) -> DataFrame:
    """Events, positives and positive rate in each window.

    An unknown label counts as an event but is left out of the rate.
    """
    require_columns(df, [label_col])
    measures = _label_measures(df, label_col)
    return per_window(df, measures, ts_col=ts_col, window=window, keys=keys, delay=delay)


def prediction_drift(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    probability_col: str = "fraud_probability",
    window: str = "10 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
    accuracy: int | None = ACCURACY,
) -> DataFrame:
    """Distribution of the predicted probability in each window."""
    require_columns(df, [probability_col])
    measures = _prediction_measures(probability_col, accuracy)
    return per_window(df, measures, ts_col=ts_col, window=window, keys=keys, delay=delay)


def performance(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    prediction_col: str = "is_fraud",
    label_col: str = "Class",
    window: str = "10 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
) -> DataFrame:
    """Confusion cells, accuracy, precision, recall and F1 in each window.

    A pair with an unknown side falls in no cell. A ratio over zero is null.
    """
    require_columns(df, [prediction_col, label_col])
    measures = _performance_measures(prediction_col, label_col)
    return per_window(df, measures, ts_col=ts_col, window=window, keys=keys, delay=delay)


def monitoring_report(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    label_col: str | None = "Class",
    probability_col: str | None = None,
    prediction_col: str | None = None,
    window: str = "10 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
    accuracy: int | None = ACCURACY,
) -> DataFrame:
    """All reports in one aggregation: one scan of a table, one state store on a stream.

    A report whose column is ``None`` is left out; performance needs the
    prediction and the label.
    """
    require_columns(df, [value_col, label_col, probability_col, prediction_col])
    measures = _data_measures(value_col, accuracy)
    if label_col is not None:
        measures += _label_measures(df, label_col)
    if probability_col is not None:
        measures += _prediction_measures(probability_col, accuracy)
    if prediction_col is not None and label_col is not None:
        measures += _performance_measures(prediction_col, label_col)
    return per_window(df, measures, ts_col=ts_col, window=window, keys=keys, delay=delay)


def report_parts(report: DataFrame, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The single reports, with their alerts, inside the output of ``monitoring_report``."""
    parts = {}
    for name, columns in REPORT_COLUMNS.items():
        if set(columns) <= set(report.columns):
            alerts = [c for c in report.columns if c == ALERT_COLUMNS.get(name)]
            parts[name] = report.select("window_start", "window_end", *keys, *columns, *alerts)
    return parts


def data_drift_alerts(report: DataFrame, threshold: float = DATA_THRESHOLD) -> DataFrame:
    """Flag windows whose deviation is above a fixed level."""
    require_columns(report, ["stddev_amount"])
    return report.withColumn("has_data_drift", F.col("stddev_amount") > threshold)


def label_drift_alerts(
    report: DataFrame,
    threshold: float = LABEL_THRESHOLD,
    baseline_rate_percent: float = BASELINE_RATE_PERCENT,
) -> DataFrame:
    """Flag windows whose positive rate is further than ``threshold`` from the baseline."""
    require_columns(report, ["fraud_rate_percent"])
    distance = F.abs(F.col("fraud_rate_percent") - baseline_rate_percent)
    return report.withColumn("has_label_drift", distance > threshold * 100)


def baseline_drift_alerts(
    report: DataFrame,
    baseline: DataFrame,
    *,
    keys: Sequence[str] = (),
    threshold: float = DATA_THRESHOLD,
) -> DataFrame:
    """Flag windows whose mean moved by more than a share of the baseline mean.

    ``baseline`` holds ``baseline_avg``: one row, or one row per key.
    """
    require_columns(report, ["avg_amount", *keys])
    require_columns(baseline, ["baseline_avg", *keys])
    if keys:
        renamed = {key: f"__on_{i}" for i, key in enumerate(keys)}
        by_key = baseline.select(*keys, "baseline_avg").withColumnsRenamed(renamed)
        same = all_of([F.col(key).eqNullSafe(F.col(other)) for key, other in renamed.items()])
        compared = report.join(by_key, same, "left").drop(*renamed.values())
    else:
        compared = report.withColumn("baseline_avg", baseline.select("baseline_avg").scalar())
    moved = F.abs(F.col("avg_amount") - F.col("baseline_avg"))
    change = F.try_divide(moved, F.abs("baseline_avg"))
    return compared.withColumn("relative_change", change).withColumn(
        "has_data_drift", change > threshold
    )
