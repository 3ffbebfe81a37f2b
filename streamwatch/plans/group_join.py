"""Joining every row back to the statistics of its own window.

All events of a live window share one join key, so a plain shuffle join would
send a window to one task. The forms here never do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamwatch.functions.sketches import GROUP_ROWS
from streamwatch.functions.values import all_of
from streamwatch.operators.window_stats import (
    WINDOW,
    Measures,
    aggregate_windows,
    flatten_window,
    open_windows,
)
from streamwatch.schema import require_columns
from streamwatch.session import checkpoint_root

SALT = "__salt"

# A group is hot if it holds more than this share of all rows, so there are
# fewer hot groups than the inverse, whatever the data.
HOT_SHARE = 1e-4

# Up to here measured statistics are broadcast whole.
MEASURED_BROADCAST_BYTES = 128 * 2**20

# Copies of the statistics of each key on a stream; raise `salts` if one key holds
# most of it, as its events spread over that many tasks.
KEYED_STREAM_SALTS = 32

# Tasks that the events of a window spread over on a stream without keys. Buffered events keep their
# salt over a restart, so the number must not follow the session; `salts` of a running
# stream must not be changed either.
STREAM_SALTS = 256


def attach_window_statistics(
    df: DataFrame,
    measures: Measures,
    *,
    ts_col: str,
    window: str,
    keys: Sequence[str] = (),
    delay: str | None = None,
    salt_by: Sequence[str] | None = None,
    salts: int | None = None,
    broadcast_bytes: int | None = None,
    needed: Sequence[str] = (),
) -> DataFrame:
    """Left join: ``df`` with its window and the measures of its window and keys.

    A table runs one job here, the aggregation, because its size decides the
    join. A stream is planned lazily. Columns of ``df`` with the name of a result are
    replaced, as ``withColumn`` does, so that one operator can follow another; one that is a key
    or ``needed`` later cannot be.
    """
    require_columns(df, keys)
    rows = open_windows(df, ts_col, window, delay)
    added = ["window_start", "window_end", *measures.names()]
    kept = sorted(set(added).intersection(needed)) + [k for k in keys if k in ("window_start", "window_end")]
    if kept:
        raise ValueError(f"names of results, rename these columns first: {kept}")
    rows = rows.drop(*(name for name in added if name in df.columns))
    if salt_by is not None:
        salt_by = [name for name in salt_by if name in rows.columns]
    if df.isStreaming:
        return _attach_stream(rows, measures, keys, salt_by, salts)
    return _attach_table(rows, measures, keys, broadcast_bytes)


def _attach_table(
    rows: DataFrame, measures: Measures, keys: Sequence[str], broadcast_bytes: int | None
) -> DataFrame:
    spark = rows.sparkSession
    checkpoint_root(spark)
    counted = measures + Measures(
        {}, (F.count("*").alias(GROUP_ROWS),), (F.col(GROUP_ROWS),)
    )
    stats = flatten_window(aggregate_windows(rows, counted, keys)).drop("window_end").checkpoint()
    return join_group_statistics(
        flatten_window(rows), stats, keys, broadcast_bytes=broadcast_bytes
    )


def join_group_statistics(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    *,
    broadcast_bytes: int | None = None,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Left join ``rows`` to one ``stats`` row per window and key, by the measured size.

    * Within the broadcast limit ``stats`` is broadcast and ``rows`` never move.
    * Beyond it only the hot groups are, and their rows do not move either. The
      rows of all other groups are shuffled; none of these groups is large.

    ``stats`` carries the rows per group in ``__group_rows`` and must be cheap to
    read more than once. Null keys match null keys.
    """
    limit = broadcast_limit(rows.sparkSession) if broadcast_bytes is None else broadcast_bytes
    total, size = stats.agg(
        F.coalesce(F.sum(GROUP_ROWS), F.lit(0)), _hashed_size(stats, keys)
    ).first()

    renamed = {"window_start": "__on_window", **_renamed_keys(keys)}
    stats = stats.withColumnsRenamed(renamed)
    same_group = (F.col("window_start") == F.col("__on_window")) & _same_keys(keys)
    helpers = [*renamed.values(), GROUP_ROWS]

    if size <= limit:
        return rows.join(F.broadcast(stats), same_group, "left").drop(*helpers)

    is_hot = F.col(GROUP_ROWS) > F.lit(int(total * hot_share))
    hot, cold = stats.filter(is_hot), stats.filter(~is_hot)
    in_hot = rows.join(F.broadcast(hot), same_group, "inner")
    in_cold = rows.join(
        F.broadcast(hot.select(*renamed.values())), same_group, "left_anti"
    ).join(cold, same_group, "left")
    return in_hot.unionByName(in_cold).drop(*helpers)


def _renamed_keys(keys: Sequence[str]) -> dict[str, str]:
    return {key: f"__on_{i}" for i, key in enumerate(keys)}


def _same_keys(keys: Sequence[str]) -> Column:
    matches = [F.col(key).eqNullSafe(F.col(other)) for key, other in _renamed_keys(keys).items()]
    return all_of(matches) if matches else F.lit(True)


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes of measured statistics that may be broadcast; 0 if the session forbids it.

    Spark's own threshold is small because it guards estimates.
    """
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits):].rstrip("b")
    threshold = int(digits) * {"": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}[unit]
    return 0 if threshold < 0 else max(threshold, MEASURED_BROADCAST_BYTES)


def _hashed_size(stats: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes of a hash table over ``stats``, keys held twice, as an aggregate."""
    fixed = 64 + 8 * (len(stats.columns) + len(keys) + 1)
    bytes_per_row = F.lit(fixed).cast("bigint")
    for name in keys:
        if isinstance(stats.schema[name].dataType, (T.StringType, T.BinaryType)):
            bytes_per_row += 2 * F.coalesce(F.octet_length(name), F.lit(0))
    for field in stats.schema:
        if isinstance(field.dataType, T.ArrayType):
            bytes_per_row += 64 * F.coalesce(F.size(field.name), F.lit(0))
    return F.coalesce(F.sum(bytes_per_row), F.lit(0))


def _attach_stream(
    rows: DataFrame,
    measures: Measures,
    keys: Sequence[str],
    salt_by: Sequence[str] | None,
    salts: int | None,
) -> DataFrame:
    """Stream-stream join with the rows of a group spread over ``salts`` tasks.

    The statistics are one row per closed group, so copying them per salt is
    cheap. The salt is a hash and not random: a retried task must send its rows
    where it sent them before.
    """
    if salts is None:
        salts = KEYED_STREAM_SALTS if keys else STREAM_SALTS
    if salt_by is None:
        # a map has no hash
        salt_by = [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]
    require_columns(rows, salt_by)

    renamed = {WINDOW: "__on_window", **_renamed_keys(keys)}
    stats = (
        aggregate_windows(rows, measures, keys)
        .withColumnsRenamed(renamed)
        .withColumn("__on_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = rows.withColumn(SALT, F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    same_group = (F.col(WINDOW) == F.col("__on_window")) & _same_keys(keys)
    joined = salted.join(stats, same_group & (F.col(SALT) == F.col("__on_salt")), "left")
    return flatten_window(joined.drop(*renamed.values(), SALT, "__on_salt"))
