"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# a time of day alone would be read as a time of today
_CLOCK_ONLY = r"^\s*(T|\d{1,2}:)"


def event_time(df: DataFrame, name: str) -> Column:
    """``name`` as a timestamp, null where it cannot be read; times without a zone are UTC,
    whatever the session's zone.

    A timestamp column is returned as it is, so that a watermark on it stays. In a session whose zone is UTC a time without
    a zone takes a plain cast; Spark fixes the zone of a cast as the column is used, which should be at once.
    """
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return column
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp") if is_utc(df.sparkSession) else in_utc(column.cast("timestamp_ntz"))
    if isinstance(kind, T.StringType):
        whole = F.when(~column.rlike(_CLOCK_ONLY), column)
        if is_utc(df.sparkSession):
            return whole.try_cast("timestamp")
        has_zone = column.rlike(r"\d:\d{1,2}(:\d{1,2}(\.\d*)?)?\s*([A-Za-z][A-Za-z0-9/_+:-]*|[+-]\d.*?)\s*$")
        return F.when(has_zone, whole.try_cast("timestamp")).otherwise(in_utc(whole.try_cast("timestamp_ntz")))
    return column.try_cast("timestamp")


def is_utc(spark: SparkSession) -> bool:
    """Whether the session's zone is UTC by one of its usual names."""
    return spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")


def in_utc(naive: Column) -> Column:
    """The instant at which clocks in UTC show this time, in a session of any zone."""
    parts = [f(naive) for f in (F.year, F.month, F.day, F.hour, F.minute)]
    return F.when(naive.isNotNull(), F.make_timestamp(*parts, F.extract(F.lit("SECOND"), naive), F.lit("UTC")))


def utc_clock(instant: Column) -> Column:
    """What clocks in UTC show at this instant, as a time without a zone."""
    if is_utc(SparkSession.active()):
        return instant.cast("timestamp_ntz")
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def finite(column: Column | str) -> Column:
    """The number as a double; NaN and infinities become null.

    One NaN would turn the mean and deviation of its whole window into NaN,
    and Spark orders NaN above every threshold.
    """
    number = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in deviations; 0 where the deviation is 0 or unknown."""
    return F.when(deviation > 0, F.abs((value - mean) / deviation)).otherwise(F.lit(0.0))
