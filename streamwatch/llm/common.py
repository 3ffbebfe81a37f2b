"""What the operators of this subpackage share: scratch tables, free column names, Arrow texts."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamwatch.session import fresh_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows, of a few numbers or a signature each, that a partition has room for.
ROWS_PER_FILE = 200_000


def in_few_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` rows at most, in as many partitions as these need and at least one for each core, however many a shuffle
    dealt it to. A file costs its executor more than a few rows do: Hadoop's local file system starts two processes for each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // ROWS_PER_FILE)))


def stored(df: DataFrame, purpose: str, rows: int | None = None, **options: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: later steps neither
    repeat its work nor depend on the executors that did it. ``rows``, where known, says how many there are at most
    and keeps them in few files; for steps with little work behind their last shuffle."""
    path = fresh_folder(df.sparkSession, purpose)
    if rows is not None:
        df = in_few_parts(df, rows)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def constant_array(values: list[float]) -> Column:
    """An array of doubles that is one literal of the plan, whatever its length: the optimizer reads the text once.
    An expression for each value would be copied with every copy of the plan."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<double>")


def hash_sample(rows: DataFrame, column: str, most: int) -> DataFrame:
    """Those of the distinct ``rows`` with the smallest hashes of ``column``, at most ``most``. Only rows whose hash is below a
    bound, at which twice as many are expected, are sorted: a task sends a few rows, not ``most``."""
    rows = rows.distinct()
    total = rows.count()
    if total > 2 * most:
        bound = int(2**64 * 2 * most / total) - 2**63
        rows = rows.filter(F.xxhash64(column) < F.lit(bound))
    return rows.orderBy(F.xxhash64(column), column).limit(most)


#: A bitmap holds 32,768 ids side by side in 4 KiB; this many bitmaps (64 MiB) are broadcast at most.
BITMAPS = 16_384


def _bitmaps(number: DataFrame, name: str, bucket: str, bits: str) -> DataFrame | None:
    """The longs of ``number`` as bitmaps, or nothing if they are more than ``BITMAPS``."""
    if number.agg(F.count_distinct(F.bitmap_bucket_number(name))).first()[0] > BITMAPS:
        return None
    return number.groupBy(F.bitmap_bucket_number(name).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias(bits))


def _in_bitmap(own: Column, bits: str) -> Column:
    place = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def rows_by_id(rows: DataFrame, id_col: str, ids: DataFrame, *, among: bool) -> DataFrame:
    """``rows`` whose id is in the only column of ``ids`` (``among``), or is not. A null id is in no set. The ids go as
    bitmaps to the rows, so that texts are not shuffled; ids too many or too scattered for ``BITMAPS`` are joined by a shuffle."""
    bucket, bits, own_number = (free_name(rows, wanted) for wanted in ("bucket", "bits", "number"))
    (name,) = ids.columns
    number = ids.select(F.col(name).cast("long").alias(own_number)).filter(F.col(own_number).isNotNull())
    own = rows[id_col].cast("long")
    maps = _bitmaps(number, own_number, bucket, bits)
    if maps is None:
        return rows.join(number.distinct(), own == F.col(own_number), "left_semi" if among else "left_anti")
    found = _in_bitmap(own, bits)
    joined = rows.join(F.broadcast(maps), F.bitmap_bucket_number(own) == F.col(bucket), "inner" if among else "left")
    return joined.filter(found if among else ~found).drop(bucket, bits)


def marked_by_id(rows: DataFrame, id_col: str, ids: DataFrame, mark: str) -> DataFrame:
    """``rows`` with a column ``mark``: whether the id is in the only column of ``ids``. All ids count, sent as in
    :func:`rows_by_id`; ids that are not whole numbers are joined by a shuffle."""
    bucket, bits, own_id = (free_name(rows, wanted) for wanted in ("bucket", "bits", "other_id"))
    (name,) = ids.columns
    known = ids.select(F.col(name).alias(own_id)).filter(F.col(own_id).isNotNull())
    whole = all(kind.typeName() in ("byte", "short", "integer", "long") for kind in (rows.schema[id_col].dataType, known.schema[own_id].dataType))
    maps = _bitmaps(known.select(F.col(own_id).cast("long")), own_id, bucket, bits) if whole else None
    if maps is None:
        joined = rows.join(known.distinct(), rows[id_col] == F.col(own_id), "left")
        return joined.withColumn(mark, F.col(own_id).isNotNull()).drop(own_id)
    own = rows[id_col].cast("long")
    joined = rows.join(F.broadcast(maps), F.bitmap_bucket_number(own) == F.col(bucket), "left")
    return joined.withColumn(mark, _in_bitmap(own, bits)).drop(bucket, bits)


#: A key is hot if it holds more than this share of all rows, so there are fewer hot keys than the inverse.
HOT_SHARE = 1 / 4096


def attached(rows: DataFrame, values: DataFrame, keys: list[str], hot: Column, spread_by: list[str]) -> DataFrame:
    """Left join of ``rows`` to ``values``, one row per key; keys are not null. Keys for which ``hot`` holds, of which the caller
    proves a bound, are broadcast; the rows of these are dealt out by ``spread_by``, as a shuffle by the key would send them to one task."""
    taken = [name for name in values.columns if name not in keys]
    spread, known = free_name(rows, "spread"), free_name(rows, "known")
    few = values.filter(hot).select(*keys, F.lit(True).alias(known), *(F.col(name).alias(f"_few_{name}") for name in taken))
    rest = values.filter(~hot).select(*keys, F.lit(0).alias(spread), *taken)
    found = rows.join(F.broadcast(few), keys, "left")
    place = F.when(F.col(known), F.pmod(F.xxhash64(*spread_by), F.lit(1 << 20)).cast("int") + 1).otherwise(0)
    found = found.withColumn(spread, place).join(rest, [*keys, spread], "left")
    return found.select(*rows.columns, *(F.coalesce(f"_few_{name}", name).alias(name) for name in taken))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 places where they begin and end.
    A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def as_texts(data: np.ndarray, offsets: np.ndarray) -> pa.StringArray:
    """The texts between ``offsets``, over the same bytes. Under 2 GB of them."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(data))


def groups_of(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of texts with at most ``most`` bytes each; a longer text has its own range."""
    found, begin = [], 0
    while begin < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), len(offsets) - 1)
        found.append((begin, end))
        begin = end
    return found
