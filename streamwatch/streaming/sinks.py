"""Starting, writing and waiting for streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from streamwatch.operators.drift import report_parts
from streamwatch.session import fresh_folder
from streamwatch.streaming.store import VERSION, Record, Store, newest_states

#: Batches of a report after which their folders are merged.
COMPACT_EVERY = 20


def _writer(df: DataFrame, mode: str, every: str | None, drain: bool) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if drain:
        return writer.trigger(availableNow=True)
    if every:
        return writer.trigger(processingTime=every)
    return writer


def to_console(
    df: DataFrame,
    *,
    mode: str = "append",
    checkpoint: str | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Print each batch untruncated, to watch a query by eye."""
    # Spark's own default is a folder on the driver, which executors cannot reach
    state = checkpoint or fresh_folder(df.sparkSession, "console")
    writer = _writer(df, mode, every, drain).format("console").option("truncate", False)
    return writer.option("checkpointLocation", state).start()


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Append to a folder, each row exactly once, also across restarts.

    ``every`` sets the batch interval; with ``drain`` the query stops once it has
    read what is there.
    """
    writer = _writer(df, "append", every, drain).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("path", path).option("checkpointLocation", checkpoint).start()


def to_reports(
    report: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: Sequence[str] = (),
    compact_every: int = COMPACT_EVERY,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Write the parts of a monitoring report from one query, in update mode.

    Each batch holds the windows that changed, and counts with all its parts or not at all. After ``compact_every``
    batches their folders are merged into one that holds the newest state of every window, so that the number of folders stays bounded.
    Read with ``read_report``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path)
        if store.is_done(batch_id):
            return
        name, before = f"batch-{batch_id:09d}", store.last() or Record(-1)
        batch = batch.persist()
        try:
            for part, rows in report_parts(batch, keys).items():
                # few, evenly filled files instead of one per state partition
                rows = rows.withColumn(VERSION, F.lit(batch_id).cast("long")).hint("rebalance")
                rows.write.mode("overwrite").parquet(f"{store.path}/{name}/{part}")
        finally:
            batch.unpersist()
        record = Record(batch_id, before.base, (*before.versions, name))
        store.commit(record)
        if len(record.versions) >= compact_every:
            _compact(store, record, keys)

    writer = _writer(report, "update", every, drain).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).start()


def _compact(store: Store, record: Record, keys: Sequence[str]) -> None:
    name = f"merged-{record.batch_id:09d}"
    for part in store.folder.names(record.versions[-1]):
        merged = newest_states(store.read(part), ["window_start", "window_end", *keys])
        merged.hint("rebalance").write.mode("overwrite").parquet(f"{store.path}/{name}/{part}")
    replaced = tuple(folder for folder in (record.base, *record.versions) if folder)
    store.commit(Record(record.batch_id, name, (), replaced))


def read_report(spark: SparkSession, path: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """The newest state of every window in one part of the report, of committed batches only."""
    return newest_states(Store(spark, path).read(name), ["window_start", "window_end", *keys]).drop(VERSION)


def await_queries(queries: Sequence[StreamingQuery], poll_seconds: float = 1) -> None:
    """Wait for all queries; if one fails, stop the others and raise its error."""
    try:
        waiting = list(queries)
        while waiting:
            # raises the error of a failed query, whichever fails first
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
