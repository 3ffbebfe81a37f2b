import math

import pytest
from pyspark.sql import functions as F

from streamwatch.operators.drift import (
    REPORT_COLUMNS,
    baseline_drift_alerts,
    data_drift,
    data_drift_alerts,
    label_drift,
    label_drift_alerts,
    monitoring_report,
    performance,
    prediction_drift,
    report_parts,
)

START = "2024-01-01T00:00:00"
LATER = "2024-01-01T00:10:00"


@pytest.fixture()
def judged(spark):
    """Rows of (time, prediction, label) with a probability and an amount."""

    def build(pairs, time=START):
        rows = [(time, float(i), p, y, 0.1 * i) for i, (p, y) in enumerate(pairs)]
        return spark.createDataFrame(
            rows, "timestamp string, Amount double, is_fraud double, Class int, fraud_probability double"
        )

    return build


def test_percentiles_are_values_of_the_data(transactions):
    rows = transactions([(START, float(i), 0) for i in range(1, 11)])
    got = data_drift(rows).first()
    assert (got.median_amount, got.p95_amount, got.p99_amount) == (5.0, 10.0, 10.0)
    assert (got.transaction_count, got.min_amount, got.max_amount) == (10, 1.0, 10.0)
    assert got.avg_amount == 5.5 and math.isclose(got.stddev_amount, 3.0276503540974917)


def test_window_without_amounts(transactions):
    got = data_drift(transactions([(START, None, 0), (START, float("nan"), 1)])).first()
    assert (got.transaction_count, got.invalid_count) == (2, 1)
    assert (got.avg_amount, got.median_amount, got.p99_amount) == (None, None, None)


def test_unknown_label_counts_as_event_only(transactions):
    rows = [(START, 1.0, y) for y in (1, 0, 0, None)] + [(LATER, 1.0, None)]
    first, second = label_drift(transactions(rows)).orderBy("window_start").collect()
    assert (first.total_transactions, first.fraud_count) == (4, 1)
    assert math.isclose(first.fraud_rate_percent, 100 / 3)
    assert (second.total_transactions, second.fraud_count, second.fraud_rate_percent) == (1, None, None)


def test_label_sum_is_an_aggregate(transactions):
    """A sum taken by Python instead of Spark would fail on a column."""
    frame = label_drift(transactions([(START, 1.0, 1), (START, 1.0, 1)]))
    assert frame.first().fraud_count == 2 and frame.schema["fraud_count"].dataType.simpleString() == "bigint"


def test_prediction_drift(judged):
    got = prediction_drift(judged([(0.0, 0)] * 5)).first()
    assert got.predictions_count == 5
    assert math.isclose(got.avg_fraud_prob, 0.2) and math.isclose(got.median_fraud_prob, 0.2)
    assert math.isclose(got.p95_fraud_prob, 0.4)
    with pytest.raises(ValueError, match="fraud_probability"):
        prediction_drift(judged([(0.0, 0)]).drop("fraud_probability"))


def test_confusion_cells_and_ratios(judged):
    pairs = [(1.0, 1)] * 3 + [(1.0, 0)] + [(0.0, 1)] * 2 + [(0.0, 0)] * 4
    unknown = [(None, 1), (1.0, None), (None, None)]
    got = performance(judged(pairs + unknown)).first()
    assert (got.tp, got.fp, got.fn, got.tn) == (3, 1, 2, 4)
    assert (got.accuracy, got.precision, got.recall) == (0.7, 0.75, 0.6)
    assert math.isclose(got.f1_score, 2 / 3)


def test_ratios_over_zero_are_null(judged):
    none_predicted = performance(judged([(0.0, 1), (0.0, 0)])).first()
    assert (none_predicted.precision, none_predicted.recall, none_predicted.f1_score) == (None, 0.0, None)
    nothing_known = performance(judged([(None, None)])).first()
    assert nothing_known.accuracy is None
    all_wrong = performance(judged([(1.0, 0), (0.0, 1)])).first()
    assert (all_wrong.precision, all_wrong.recall, all_wrong.f1_score) == (0.0, 0.0, None)


def test_performance_needs_both_columns(judged):
    with pytest.raises(ValueError, match="is_fraud"):
        performance(judged([(0.0, 1)]).drop("is_fraud"))


def test_default_alert_levels(spark):
    report = spark.createDataFrame(
        [(0.1, 2.172), (0.11, 2.173), (None, None)], "stddev_amount double, fraud_rate_percent double"
    )
    got = label_drift_alerts(data_drift_alerts(report)).collect()
    assert [r.has_data_drift for r in got] == [False, True, None]
    assert [r.has_label_drift for r in got] == [False, True, None]


def test_baseline_alerts_with_and_without_keys(spark):
    report = spark.createDataFrame(
        [("a", 11.0), ("a", 11.2), ("b", 50.0), (None, 2.0), ("new", 1.0)], "kind string, avg_amount double"
    )
    single = spark.sql("SELECT 10.0D AS baseline_avg")
    flags = [r.has_data_drift for r in baseline_drift_alerts(report, single).collect()]
    assert flags == [False, True, True, True, True]
    by_kind = spark.createDataFrame(
        [("a", 11.0), ("b", -50.0), (None, 2.0)], "kind string, baseline_avg double"
    )
    got = baseline_drift_alerts(report, by_kind, keys=["kind"])
    assert sorted((r.kind or "-", r.avg_amount, r.has_data_drift) for r in got.collect()) == [
        ("-", 2.0, False), ("a", 11.0, False), ("a", 11.2, False), ("b", 50.0, True), ("new", 1.0, None),
    ]


def test_report_equals_its_parts(judged):
    rows = judged([(1.0, 1), (0.0, 1), (1.0, 0)]).union(judged([(0.0, 0)] * 4, LATER))
    report = monitoring_report(rows, probability_col="fraud_probability", prediction_col="is_fraud")
    singles = {
        "data": data_drift(rows),
        "label": label_drift(rows),
        "prediction": prediction_drift(rows),
        "performance": performance(rows),
    }
    parts = report_parts(report)
    assert parts.keys() == singles.keys() == REPORT_COLUMNS.keys()
    for name, part in parts.items():
        assert part.columns == singles[name].columns
        assert part.orderBy("window_start").collect() == singles[name].orderBy("window_start").collect()


def test_report_leaves_out_what_has_no_column(transactions):
    rows = transactions([(START, 1.0, 0)])
    assert set(report_parts(monitoring_report(rows))) == {"data", "label"}
    assert set(report_parts(monitoring_report(rows, label_col=None))) == {"data"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_report_is_one_scan_and_never_moves_events(judged, spark, tmp_path):
    judged([(1.0, 1)]).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    report = monitoring_report(rows, probability_col="fraud_probability", prediction_col="is_fraud")
    text = plan(report)
    assert text.count("FileScan") == 1
    # what is shuffled has been aggregated
    assert text.count("Exchange") == 1
    assert plan(performance(rows)).count("Exchange") == 1
    assert plan(label_drift(rows)).count("Exchange") == 1


def test_unused_columns_are_not_read(judged, spark, tmp_path):
    judged([(1.0, 1)]).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    text = data_drift(rows)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp:string,Amount:double>" in text
    assert "PushedFilters: [IsNotNull(timestamp)]" in text


def test_sketches_of_small_groups_are_exact(spark):
    """All tasks hold rows of one window."""
    rows = spark.range(8000, numPartitions=8).select(
        F.when(F.col("id") % 1000 == 0, LATER).otherwise(START).alias("timestamp"),
        (F.hash("id") % 5000).cast("double").alias("Amount"),
        (F.col("id") % 2).cast("int").alias("Class"),
    )
    report = data_drift(rows, accuracy=10_000)
    assert plan(report).count("Exchange") == 1
    got = {r.window_start: r for r in report.collect()}
    amounts = {}
    for r in rows.collect():
        amounts.setdefault(r.timestamp, []).append(r.Amount)
    for row, time in zip((got[k] for k in sorted(got)), (START, LATER)):
        ordered = sorted(amounts[time])
        assert row.transaction_count == len(ordered)
        for name, cut in (("median_amount", 0.5), ("p95_amount", 0.95), ("p99_amount", 0.99)):
            assert getattr(row, name) == ordered[math.ceil(cut * len(ordered)) - 1]
