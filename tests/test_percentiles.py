"""Exact percentiles against sorting, with brackets that miss, that are too large, and groups of all kinds."""

import math
import random

import pytest
from pyspark.sql import functions as F

from streamwatch.functions.sketches import sketch_size
from streamwatch.operators.anomaly import iqr_bounds
from streamwatch.operators.drift import data_drift, monitoring_report
from streamwatch.plans import exact_percentiles

DAY = "1 day"


def _rows(n=6000, seed=3):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        day = draw.choice([1, 1, 1, 2, 3])
        value = draw.choice([draw.gauss(0, 100), draw.randint(0, 5), -0.0, 1e300]) if day < 3 else 7.0
        rows.append((f"2024-01-0{day}T00:00:00", float(value) if draw.random() > 0.02 else None, draw.choice(["a", "b", None]), draw.random()))
    return [*rows, ("2024-01-05T00:00:00", None, "a", 0.5), ("2024-01-06T00:00:00", 1.0, None, 0.5)]


def _cut(values, q):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(q * len(ordered))) - 1] if ordered else None


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(_rows(), "timestamp string, Amount double, card string, p double").repartition(7)


def _check(table):
    groups = {}
    for time, value, card, p in _rows():
        amounts, shares = groups.setdefault((time[:10], card), ([], []))
        shares.append(p)
        if value is not None:
            amounts.append(value)
    report = monitoring_report(table, label_col=None, probability_col="p", window=DAY, keys=["card"], accuracy=None).collect()
    assert len(report) == len(groups)
    for row in report:
        amounts, shares = groups[str(row.window_start)[:10], row.card]
        assert row.transaction_count == len(shares) and row.min_amount == min(amounts, default=None)
        assert (row.median_amount, row.p95_amount, row.p99_amount) == tuple(_cut(amounts, q) for q in (0.5, 0.95, 0.99))
        assert (row.median_fraud_prob, row.p95_fraud_prob) == tuple(_cut(shares, q) for q in (0.5, 0.95))


def test_all_columns_of_a_report(table):
    _check(table)


def test_brackets_that_miss_are_opened(table, monkeypatch):
    monkeypatch.setattr(exact_percentiles, "SKETCH", 8)
    monkeypatch.setattr(exact_percentiles, "MARGIN", 0.0)
    opened = []
    monkeypatch.setattr(exact_percentiles, "_opened", lambda *rest, own=exact_percentiles._opened: opened.append(1) or own(*rest))
    _check(table)
    assert opened


@pytest.mark.parametrize("margin", [0.0025, 0.4])
def test_large_brackets_are_narrowed(table, monkeypatch, margin):
    monkeypatch.setattr(exact_percentiles, "MARGIN", margin)
    monkeypatch.setattr(exact_percentiles, "ORDERED", 10)
    monkeypatch.setattr(exact_percentiles, "PARTS", 4)
    monkeypatch.setattr(exact_percentiles, "SKETCH", 8)
    _check(table)


def test_the_input_is_read_twice(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "rows"))
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        reads.add(1)
        return value

    rows = spark.read.parquet(str(tmp_path / "rows")).withColumn("Amount", counted("Amount"))
    data_drift(rows, window=DAY, accuracy=None).collect()
    assert reads.value <= 2 * rows.count()


def test_no_group_is_ordered_whole(table):
    """Only values inside brackets are ordered; the widest brackets of 6,000 rows hold few."""
    text = iqr_bounds(table, window=DAY, accuracy=None)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text and "Python" not in text


def test_size_of_a_sketch():
    assert sketch_size(1) == 8 and sketch_size(10**9) == 65_535 and 3_000 < sketch_size(1_000) < 5_000


def test_approximate_percentiles_are_within_their_error(spark):
    n = 300_000
    rows = spark.range(n).select(F.lit("2024-01-01T00:00:00").alias("timestamp"), F.pmod(F.col("id") * 7919, F.lit(n)).cast("double").alias("Amount"))
    row = data_drift(rows, window=DAY, accuracy=200).first()
    for found, q in ((row.median_amount, 0.5), (row.p95_amount, 0.95), (row.p99_amount, 0.99)):
        assert abs(found / n - q) <= 1 / 200
