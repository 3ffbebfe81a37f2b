"""Statistics per tumbling event-time window, optionally split by keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamwatch.functions.sketches import quantiles, sketch_size
from streamwatch.functions.values import event_time, finite
from streamwatch.schema import require_columns

WINDOW = "__window"
CLOCK = "__clock"


def _name_of(column: Column) -> str:
    """The alias of an expression, or the name of a column."""
    text = str(column).removeprefix("Column<'").removesuffix("'>")
    return text.rpartition(" AS ")[2]


@dataclass(frozen=True)
class Measures:
    """What to compute per group.

    ``inputs`` are projected before grouping, so that the scan and the shuffle
    hold nothing else; ``outputs`` are expressions over the aggregates. Sums of
    measures share one aggregation.
    """

    inputs: dict[str, Column] = field(default_factory=dict)
    aggregates: tuple[Column, ...] = ()
    outputs: tuple[Column, ...] = ()
    #: exact percentiles: the input, and the name and share of each
    exact: dict[str, dict[str, float]] = field(default_factory=dict)

    def names(self) -> list[str]:
        """Names of the outputs."""
        return [_name_of(column) for column in self.outputs]

    def __add__(self, other: Measures) -> Measures:
        return Measures(
            {**self.inputs, **other.inputs},
            self.aggregates + other.aggregates,
            self.outputs + other.outputs,
            {**self.exact, **other.exact},
        )


def open_windows(df: DataFrame, ts_col: str, duration: str, delay: str | None) -> DataFrame:
    """Add the window of each row; rows without a readable time have none and go.

    On a stream the watermark sits on a hidden copy of the time. A join of two
    streams takes one watermarked column per side, and the window is that one.
    """
    require_columns(df, [ts_col])
    # the scan can skip rows without a time
    timed = df.filter(F.col(ts_col).isNotNull()).withColumn(CLOCK, event_time(df, ts_col))
    if df.isStreaming:
        if delay is None:
            raise ValueError("a stream needs `delay`, how long to wait for late events")
        timed = timed.withWatermark(CLOCK, delay)
    return timed.withColumn(WINDOW, F.window(CLOCK, duration)).drop(CLOCK)


def aggregate_windows(rows: DataFrame, measures: Measures, keys: Sequence[str]) -> DataFrame:
    """Group the output of ``open_windows``; Spark combines before the shuffle."""
    require_columns(rows, keys)
    inputs = [column.alias(name) for name, column in measures.inputs.items()]
    rows = rows.select(WINDOW, *keys, *inputs)
    if measures.exact:
        from streamwatch.plans.exact_percentiles import aggregate_with_percentiles

        if rows.isStreaming:
            raise ValueError("exact percentiles need a table; give a stream an accuracy")
        grouped = aggregate_with_percentiles(rows, measures, keys)
    else:
        grouped = rows.groupBy(WINDOW, *keys).agg(*measures.aggregates)
    return grouped.select(WINDOW, *keys, *measures.outputs)


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the window by its start and end."""
    others = [c for c in df.columns if c != WINDOW]
    return df.select(
        F.col(f"{WINDOW}.start").alias("window_start"),
        F.col(f"{WINDOW}.end").alias("window_end"),
        *others,
    )


def per_window(
    df: DataFrame,
    measures: Measures,
    *,
    ts_col: str,
    window: str,
    keys: Sequence[str] = (),
    delay: str | None = None,
) -> DataFrame:
    rows = open_windows(df, ts_col, window, delay)
    return flatten_window(aggregate_windows(rows, measures, keys))


def moments(value: str) -> Measures:
    """Mean and sample deviation of an amount, and how many values were not numbers."""
    raw = F.col(value)
    return Measures(
        {"__amount": finite(value), "__not_number": raw.isNotNull() & finite(value).isNull()},
        (
            F.avg("__amount").alias("avg_amount"),
            F.stddev_samp("__amount").alias("stddev_amount"),
            F.count_if("__not_number").alias("invalid_count"),
        ),
        (F.col("avg_amount"), F.col("stddev_amount"), F.col("invalid_count")),
    )


def extremes(value: str) -> Measures:
    return Measures(
        {"__amount": finite(value)},
        (F.min("__amount").alias("min_amount"), F.max("__amount").alias("max_amount")),
        (F.col("min_amount"), F.col("max_amount")),
    )


def percentiles(
    name: str, column: Column, cuts: dict[str, float], accuracy: int | None
) -> Measures:
    """Approximate percentiles, all from one sketch per group; without ``accuracy`` exact ones."""
    if accuracy is None:
        outputs = tuple(F.col(cut) for cut in cuts)
        return Measures({f"__{name}": column}, (), outputs, exact={f"__{name}": cuts})
    sketch = F.kll_sketch_agg_double(f"__{name}", F.lit(sketch_size(accuracy))).alias(f"__{name}_sketch")
    found = quantiles(f"__{name}_sketch", f"__{name}_n", list(cuts.values()))
    return Measures(
        {f"__{name}": column},
        (sketch, F.count(f"__{name}").alias(f"__{name}_n")),
        tuple(F.get(found, F.lit(i)).alias(cut) for i, cut in enumerate(cuts)),
    )


def amount_statistics(
    df: DataFrame,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    label_col: str | None = "Class",
    window: str = "5 minutes",
    keys: Sequence[str] = (),
    delay: str | None = None,
) -> DataFrame:
    """Mean, deviation, range and label rate of the amounts in each window."""
    require_columns(df, [value_col, label_col])
    measures = moments(value_col) + extremes(value_col)
    if label_col is not None:
        measures += Measures(
            {"__label": finite(label_col)},
            (F.avg("__label").alias("avg_fraud_rate"),),
            (F.col("avg_fraud_rate"),),
        )
    return per_window(df, measures, ts_col=ts_col, window=window, keys=keys, delay=delay)
