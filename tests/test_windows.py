import math
import statistics

import pytest

from streamwatch.operators.window_stats import amount_statistics


def by_start(frame):
    return {r.window_start.strftime("%H:%M"): r for r in frame.collect()}


def test_statistics_of_two_windows(transactions):
    amounts = [1.0, 2.0, 6.0]
    rows = [(f"2024-01-01T00:0{i}:00", a, i % 2) for i, a in enumerate(amounts)]
    got = by_start(amount_statistics(transactions([*rows, ("2024-01-01T00:05:00", 9.0, 1)])))
    first = got["00:00"]
    assert first.avg_amount == 3.0
    assert math.isclose(first.stddev_amount, statistics.stdev(amounts))
    assert (first.min_amount, first.max_amount) == (1.0, 6.0)
    assert math.isclose(first.avg_fraud_rate, 1 / 3)
    assert got["00:05"].stddev_amount is None
    assert got["00:05"].window_end.strftime("%H:%M") == "00:10"


def test_not_a_number_leaves_the_window_intact(transactions):
    rows = [("2024-01-01T00:00:00", v, 0) for v in (1.0, 3.0, float("nan"), float("inf"), None)]
    got = amount_statistics(transactions(rows)).first()
    assert (got.avg_amount, got.max_amount, got.invalid_count) == (2.0, 3.0, 2)


def test_rows_without_a_time_are_left_out(transactions):
    rows = [("2024-01-01T00:00:00", 1.0, 0), (None, 5.0, 0), ("soon", 7.0, 0)]
    got = amount_statistics(transactions(rows)).collect()
    assert [r.avg_amount for r in got] == [1.0]


def test_keys_and_absent_label(transactions):
    rows = [("2024-01-01T00:00:00", 1.0, 0), ("2024-01-01T00:00:01", 5.0, None)]
    frame = amount_statistics(transactions(rows), label_col=None, keys=["Class"])
    assert "avg_fraud_rate" not in frame.columns
    assert {r.Class: r.avg_amount for r in frame.collect()} == {0: 1.0, None: 5.0}


def test_missing_columns_are_named(transactions):
    rows = transactions([("2024-01-01T00:00:00", 1.0, 0)])
    for options in ({"value_col": "a"}, {"ts_col": "a"}, {"label_col": "a"}, {"keys": ["a"]}):
        with pytest.raises(ValueError, match=r"\['a'\]"):
            amount_statistics(rows, **options)
