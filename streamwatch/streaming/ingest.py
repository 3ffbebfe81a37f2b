"""From raw messages to readable events, with nothing lost on the way.

One read of the source deals every message out to one of three routes:

* ``events``: readable ones, in time,
* ``late``: readable ones whose window had closed before their batch began; a windowed query would drop them, and Spark's own metric counts them
  only after partial aggregation,
* ``dead``: messages that are no JSON of the schema, or have no readable time, with their text and the reason.

A batch is one job that writes one folder, split by route, and counts and the latest time in the same pass (``DataFrame.observe``). Its record goes last,
so all its routes count or none. The watermark of a batch follows from the record of the one before it, so a repeated batch deals its messages out as the
first time did. Other queries read the routes as tables, or ``events`` as a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamwatch.functions.messages import CORRUPT, decode_events
from streamwatch.functions.values import event_time
from streamwatch.schema import EVENT_SCHEMA
from streamwatch.streaming.store import Record, Store

ROUTES = ("events", "late", "dead")
ROUTE, REASON, RAW = "route", "reason", "raw"
BATCH = "batch_id"


#: Batches whose counts stay in the record; the totals are of all.
KEPT_COUNTS = 1000


def routed(
    messages: DataFrame,
    closed_micros: int | None = None,
    *,
    schema: T.StructType = EVENT_SCHEMA,
    ts_col: str = "timestamp",
    label_col: str | None = "Class",
    width_micros: int = 300_000_000,
    value_col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The fields of each message, its route, and for dead ones the reason and the raw text; ``__time`` is the event's time. Windows of
    ``width_micros`` that end by ``closed_micros``, the watermark, are closed."""
    columns = messages.select(F.col(value_col).cast("string").alias(RAW), *keep)
    decoded = decode_events(columns, schema, label_col=label_col, value_col=RAW, keep=[RAW, *keep], keep_corrupt=True)
    time = event_time(decoded, ts_col)
    reason = F.when(F.col(RAW).isNull(), "empty").when(F.col(CORRUPT).isNotNull(), "unreadable").when(time.isNull(), "no time")
    rows = decoded.withColumns({REASON: reason, "__time": time})
    late = F.lit(False)
    if closed_micros is not None:
        micros = F.unix_micros("__time")
        late = micros - F.pmod(micros, F.lit(width_micros)) + width_micros <= closed_micros
    route = F.when(F.col(REASON).isNotNull(), "dead").when(late, "late").otherwise("events")
    return rows.withColumn(ROUTE, route).withColumn(RAW, F.when(F.col(ROUTE) == "dead", F.col(RAW))).drop(CORRUPT)


def ingest_job(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    schema: T.StructType = EVENT_SCHEMA,
    ts_col: str = "timestamp",
    label_col: str | None = "Class",
    window: str = "5 minutes",
    delay: str = "10 minutes",
    value_col: str = "value",
    keep: Sequence[str] = (),
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Deal the messages out to the routes under ``path``. ``window`` and ``delay`` are those of the queries to come."""
    names = {RAW, REASON, ROUTE, BATCH, "__time"} & {*schema.fieldNames(), *keep}
    if names:
        raise ValueError(f"names that the routes use, rename these fields first: {sorted(names)}")

    spark = messages.sparkSession
    width, wait = micros_of(spark, window), micros_of(spark, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path)
        if store.is_done(batch_id):
            return
        before, name = store.last() or Record(-1), f"{BATCH}={batch_id}"
        closed = before.notes.get("closed_micros")
        rows = routed(batch, closed, schema=schema, ts_col=ts_col, label_col=label_col, width_micros=width, value_col=value_col, keep=keep)
        latest = F.max(F.when(F.col(ROUTE) != "dead", F.unix_micros("__time"))).alias("latest")
        told = [F.count(F.lit(1)).alias("messages"), latest, *(F.count_if(F.col(ROUTE) == route).alias(route) for route in ROUTES)]
        if store.folder.exists(f"{name}/_SUCCESS"):
            # written whole before a failure, and perhaps read by others since
            seen = rows.agg(*told).first().asDict()
        else:
            observation = Observation()
            rows.observe(observation, *told).drop("__time").write.mode("overwrite").partitionBy(ROUTE).parquet(f"{store.path}/{name}")
            seen = dict(observation.get)
        newest = max((x for x in (seen.pop("latest"), before.notes.get("latest_micros")) if x is not None), default=None)
        store.commit(
            Record(
                batch_id,
                notes={
                    "latest_micros": newest,
                    "closed_micros": None if newest is None else newest - wait,
                    "batches": [*before.notes.get("batches", []), {BATCH: batch_id, **seen}][-KEPT_COUNTS:],
                    "totals": {key: before.notes.get("totals", {}).get(key, 0) + n for key, n in seen.items()},
                },
            )
        )

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def read_route(spark: SparkSession, path: str, route: str) -> DataFrame:
    """What a route holds so far, with the number of the batch, of committed batches only."""
    store = Store(spark, path)
    record = store.last() or Record(-1)
    rows = spark.read.parquet(store.path).withColumn(BATCH, F.col(BATCH).cast("long"))
    rows = rows.filter((F.col(ROUTE) == route) & (F.col(BATCH) <= record.batch_id))
    return rows.drop(ROUTE, *(() if route == "dead" else (RAW, REASON)))


def stream_route(spark: SparkSession, path: str, route: str = "events", *, max_files: int | None = None) -> DataFrame:
    """A route as a stream of files. It may run ahead of the log by the batch in progress, whose files do not change any more."""
    schema = read_route(spark, path, route).drop(BATCH).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path.rstrip('/')}/{BATCH}=*/{ROUTE}={route}")


def ingest_counts(spark: SparkSession, path: str) -> DataFrame:
    """batch_id, messages, events, late and dead of the newest batches."""
    record = Store(spark, path).last()
    rows = [tuple(batch[name] for name in (BATCH, "messages", *ROUTES)) for batch in (record.notes["batches"] if record else [])]
    return spark.createDataFrame(rows, ", ".join(f"{name} long" for name in (BATCH, "messages", *ROUTES)))


def ingest_totals(spark: SparkSession, path: str) -> dict[str, int]:
    """messages, events, late and dead of all batches."""
    record = Store(spark, path).last()
    return dict.fromkeys(("messages", *ROUTES), 0) | (record.notes["totals"] if record else {})


def micros_of(spark: SparkSession, duration: str) -> int:
    """Microseconds of a duration such as ``10 minutes``."""
    zero = F.timestamp_micros(F.lit(0).cast("long"))
    return spark.range(1).select(F.unix_micros(zero + F.expr(f"INTERVAL '{duration}'"))).first()[0]
