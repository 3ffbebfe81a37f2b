"""Events that deviate from the other events of their window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamwatch.functions.sketches import ACCURACY
from streamwatch.functions.values import finite, z_score
from streamwatch.operators.window_stats import (
    Measures,
    moments,
    per_window,
    percentiles,
)
from streamwatch.plans.group_join import attach_window_statistics
from streamwatch.schema import require_columns


def zscore_anomalies(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    window: str = "5 minutes",
    threshold: float = 3.0,
    keys: Sequence[str] = (),
    delay: str | None = None,
    **join_options,
) -> DataFrame:
    """Every event with its window's mean and deviation, ``z_score`` and ``is_anomaly``.

    The window includes the event itself, so a window of n events cannot give a
    score above (n-1)/sqrt(n). ``join_options`` go to ``attach_window_statistics``.
    """
    require_columns(df, [value_col])
    measured = attach_window_statistics(
        df,
        moments(value_col),
        ts_col=ts_col,
        window=window,
        keys=keys,
        delay=delay,
        needed=[value_col],
        **join_options,
    )
    score = z_score(finite(value_col), F.col("avg_amount"), F.col("stddev_amount"))
    return measured.withColumn("z_score", score).withColumn(
        "is_anomaly", F.col("z_score") > threshold
    )


def _quartiles(value_col: str, accuracy: int | None) -> Measures:
    mean = Measures({}, (F.avg("__amount").alias("avg_amount"),), (F.col("avg_amount"),))
    return mean + percentiles("amount", finite(value_col), {"q1": 0.25, "q3": 0.75}, accuracy)


def _with_bounds(df: DataFrame, multiplier: float) -> DataFrame:
    reach = multiplier * (F.col("q3") - F.col("q1"))
    return df.withColumns({"lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach})


def iqr_bounds(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    window: str = "5 minutes",
    multiplier: float = 1.5,
    keys: Sequence[str] = (),
    delay: str | None = None,
    accuracy: int | None = ACCURACY,
) -> DataFrame:
    """Quartiles and the accepted range of each window."""
    require_columns(df, [value_col])
    quartiles = per_window(
        df, _quartiles(value_col, accuracy), ts_col=ts_col, window=window, keys=keys, delay=delay
    )
    return _with_bounds(quartiles, multiplier)


def iqr_anomalies(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    window: str = "5 minutes",
    multiplier: float = 1.5,
    keys: Sequence[str] = (),
    delay: str | None = None,
    accuracy: int | None = ACCURACY,
    **join_options,
) -> DataFrame:
    """Every event with its window's accepted range; outside it is an anomaly."""
    require_columns(df, [value_col])
    measured = attach_window_statistics(
        df,
        _quartiles(value_col, accuracy),
        ts_col=ts_col,
        window=window,
        keys=keys,
        delay=delay,
        needed=[value_col],
        **join_options,
    )
    value = finite(value_col)
    outside = (value < F.col("lower_bound")) | (value > F.col("upper_bound"))
    return _with_bounds(measured, multiplier).withColumn("is_anomaly", outside)


def flagged_only(df: DataFrame) -> DataFrame:
    """The anomalies; an unknown flag is none."""
    require_columns(df, ["is_anomaly"])
    return df.filter("is_anomaly")
