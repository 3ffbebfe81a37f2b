"""Event tables and file streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamwatch.functions.messages import CORRUPT
from streamwatch.functions.sketches import quantiles, sketch_size, sketched
from streamwatch.functions.values import event_time
from streamwatch.schema import TABLE_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TABLE_SCHEMA) -> DataFrame:
    """A CSV table with a header. The declared schema saves a pass over the data."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """The files of a folder, or of a path pattern, as a stream.

    ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


SLICE = "__slice"


def publish_slices(df: DataFrame, path: str, numbers: Sequence[int] | None = None) -> None:
    """Append the slices of ``df``, by its whole number ``SLICE``, to a folder that a stream reads: one file each, in their order, so
    that a stream with ``max_files=1`` takes one slice a batch. ``df`` should be a stored table; ``numbers`` are the slices to publish."""
    if numbers is None:
        numbers = [row[0] for row in df.select(SLICE).distinct().orderBy(SLICE).collect()]  # one row per batch to come
    for number in numbers:
        own = df.filter(F.col(SLICE) == number).drop(SLICE)
        own.coalesce(1).write.mode("append").parquet(path)


def sliced_by_time(df: DataFrame, ts_col: str, slices: int) -> DataFrame:
    """``df`` in the order of time: ``SLICE`` from 0 up, of about equally many rows each, by a sketch of the times. Rows of equal time are in one
    slice; those without a readable time are in the first."""
    seconds = F.unix_micros(event_time(df, ts_col)) / 1e6
    timed = df.withColumn("__seconds", seconds)
    ranks = [k / slices for k in range(1, slices)] or [1.0]
    sketch = sketched(timed, [], ["__seconds"], sketch_size(1000))
    borders = sketch.select(quantiles("__seconds_sketch", "__seconds_n", ranks)).first()[0] or []
    after = [F.coalesce((F.col("__seconds") > border).cast("int"), F.lit(0)) for border in borders[: slices - 1]]
    return timed.withColumn(SLICE, sum(after, F.lit(0))).drop("__seconds")


def infer_csv_schema(text: DataFrame) -> T.StructType:
    """The types of a table whose columns are all text, by one aggregation: a column is a long, double, boolean or timestamp if every value that
    is there is one, else a string. What each task finds merges as counts, so the data is not collected or sampled."""
    tests = {
        "long": lambda c: c.rlike(r"^\s*[+-]?\d{1,18}\s*$"),
        "double": lambda c: c.try_cast("double").isNotNull() & ~c.rlike(r"[dDfF]\s*$"),
        "boolean": lambda c: F.lower(F.trim(c)).isin("true", "false"),
        "timestamp_ntz": lambda c: c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}") & c.try_cast("timestamp_ntz").isNotNull(),
    }
    counts = []
    for k, name in enumerate(text.columns):
        column = F.col(f"`{name}`")
        counts.append(F.count(column).alias(f"{k}"))
        counts += [F.count_if(test(column)).alias(f"{k} {kind}") for kind, test in tests.items()]
    found = text.agg(*counts).first()
    fields = []
    for k, name in enumerate(text.columns):
        total = found[f"{k}"]
        kind = next((kind for kind in tests if total and found[f"{k} {kind}"] == total), "string")
        fields.append(T.StructField(name, T._parse_datatype_string(kind)))
    return T.StructType(fields)


def read_csv_inferred(spark: SparkSession, path: str, *, missing_ok: bool = False) -> tuple[DataFrame, DataFrame] | None:
    """A CSV table with a header and types found from its values, and its damaged rows as (record): those with more or fewer values than the header has
    columns, or a value that its column cannot hold. A path without files gives ``None`` if ``missing_ok``, else an error."""
    try:
        header = spark.read.csv(path, header=True)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    text = T.StructType([*header.schema.fields, T.StructField(CORRUPT, T.StringType())])
    # the corrupt record alone cannot be asked for, and rows of the wrong width must not count towards types
    rows = spark.read.csv(path, schema=text, header=True, enforceSchema=False, columnNameOfCorruptRecord=CORRUPT)
    schema = infer_csv_schema(rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))
    return split_csv(spark, path, schema)


def split_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The readable rows of a CSV table with these types, and the text of its damaged rows as (record)."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.csv(path, schema=wide, header=True, enforceSchema=False, columnNameOfCorruptRecord=CORRUPT)
    # always true: it asks for all columns, whatever is selected later, as only then every damage is seen
    known = F.length(F.concat_ws("", *(F.col(f"`{name}`").cast("string") for name in schema.fieldNames()))) >= 0
    return rows.filter(F.col(CORRUPT).isNull() & known).drop(CORRUPT), rows.filter(F.col(CORRUPT).isNotNull() & known).select(F.col(CORRUPT).alias("record"))
