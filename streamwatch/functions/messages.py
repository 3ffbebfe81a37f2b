"""Events to and from their JSON wire form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamwatch.functions.values import event_time, utc_clock
from streamwatch.schema import EVENT_SCHEMA, require_columns

# ISO-8601 text with microseconds, as a naive UTC clock prints it.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CORRUPT = "_corrupt_record"  # Spark's default name for unreadable JSON text


def stamp_missing_time(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Fill an absent or null event time with the current time."""
    now = F.current_timestamp()
    # date_format() would write the session's local time
    printed = F.to_json(F.struct(now.alias("now")), {"timestampFormat": TIME_FORMAT, "timeZone": "UTC"})
    text = F.get_json_object(printed, "$.now")
    if ts_col not in df.columns:
        return df.withColumn(ts_col, text)
    kind = df.schema[ts_col].dataType
    if isinstance(kind, T.StringType):
        now = text
    elif isinstance(kind, T.TimestampNTZType):
        now = utc_clock(now)
    return df.withColumn(ts_col, F.coalesce(ts_col, now))


def encode_events(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """One JSON ``value`` per row, and a message ``key`` if asked for."""
    body = F.to_json(
        F.struct("*"),
        {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT, "timeZone": "UTC"},
    ).alias("value")
    if key_col is None:
        return df.select(body)
    require_columns(df, [key_col])
    return df.select(F.col(key_col).cast("string").alias("key"), body)


def decode_events(
    raw: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    *,
    columns: Sequence[str] | None = None,
    label_col: str | None = "Class",
    value_col: str = "value",
    keep: Sequence[str] = (),
    keep_corrupt: bool = False,
) -> DataFrame:
    """Parse JSON messages into flat, typed columns.

    ``columns`` narrows the parse to the fields a job reads. The label is parsed
    as a double and then cast, since a sender with mixed number types writes
    ``1.0`` where the schema says integer. Unreadable input gives nulls; with
    ``keep_corrupt`` its text is kept in ``_corrupt_record``.
    """
    require_columns(raw, [value_col, *keep])
    wanted = [f for f in schema if columns is None or f.name in columns]
    if columns is not None and len(wanted) != len(set(columns)):
        known = {f.name for f in schema}
        raise ValueError(f"not in the event schema: {sorted(set(columns) - known)}")
    wire = [
        T.StructField(f.name, T.DoubleType() if f.name == label_col else f.dataType)
        for f in wanted
    ]
    clash = [name for name in keep if name in {f.name for f in wanted}]
    if clash:
        raise ValueError(f"also fields of the event, rename them first: {clash}")
    options = {}
    if keep_corrupt:
        wire.append(T.StructField(CORRUPT, T.StringType()))
        # Spark prunes the parse to the fields in use only if there are no options;
        # pruned, a bad field that nobody selects would not count as corrupt
        options = {"mode": "PERMISSIVE"}
    parsed = F.from_json(F.col(value_col).cast("string"), T.StructType(wire), options)
    flat = raw.select(*keep, parsed.alias("data")).select(*keep, "data.*")
    if any(f.name == label_col for f in wanted):
        # a label outside the integer range must not stop the job
        flat = flat.withColumn(label_col, F.col(label_col).try_cast(schema[label_col].dataType))
    return flat


def with_validity(decoded: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Add ``is_valid``: readable JSON with a readable event time.

    Takes the output of ``decode_events(..., keep_corrupt=True)``.
    """
    require_columns(decoded, [ts_col, CORRUPT])
    readable = F.col(CORRUPT).isNull() & event_time(decoded, ts_col).isNotNull()
    return decoded.withColumn("is_valid", readable)


def split_events(decoded: DataFrame, ts_col: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Valid events, and the rest with their raw text."""
    marked = with_validity(decoded, ts_col)
    valid = marked.filter("is_valid").drop("is_valid", CORRUPT)
    invalid = marked.filter("not is_valid").drop("is_valid")
    return valid, invalid


def first_events(df: DataFrame, limit: int | None, order_by: Sequence[str]) -> DataFrame:
    """The first ``limit`` events in a fixed order; 0 or ``None`` keeps them all."""
    return df.orderBy(*order_by).limit(limit) if limit else df
