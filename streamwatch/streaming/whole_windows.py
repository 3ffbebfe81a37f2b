"""Results that need all events of a window at once, such as exact percentiles, on a stream.

The state of a streaming aggregation holds sketches, so its percentiles are approximate. Here a batch adds its events to a table of those whose window is
open, and an operator on tables reads the events of whole windows there: once, when a window has closed, or again after each batch that adds to it. How such
an operator spreads a window over tasks holds here as well.

A window is closed when it ends ``delay`` or more before the latest time seen. Events that come after a batch that closed their window are left out, as by
Spark's windowed aggregations; events without a readable time are in no window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamwatch.functions.values import event_time
from streamwatch.operators.drift import report_parts
from streamwatch.schema import require_columns
from streamwatch.session import checkpoint_root
from streamwatch.streaming.ingest import micros_of
from streamwatch.streaming.store import VERSION, Record, Store, newest_states

#: Batches after which the events of open windows, and the reports, are merged into one folder.
MERGE_EVERY = 20
END, OPEN, JUDGED = "__end", "open", "judged"


def closed_windows_job(
    events: DataFrame,
    judge: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    *,
    ts_col: str = "timestamp",
    window: str = "5 minutes",
    delay: str = "10 minutes",
    merge_every: int = MERGE_EVERY,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Append what ``judge`` makes of the events, a table, of the windows that a batch has closed; each window comes once and whole.
    Read with ``previous_window.read_judged``."""

    def parts(rows: DataFrame) -> dict[str, DataFrame]:
        return {JUDGED: judge(rows)}

    return _start(events, parts, None, path, checkpoint, ts_col, window, delay, merge_every, every, drain)


def window_reports_job(
    events: DataFrame,
    report: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    *,
    ts_col: str = "timestamp",
    window: str = "10 minutes",
    delay: str = "10 minutes",
    keys: Sequence[str] = (),
    merge_every: int = MERGE_EVERY,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Write the parts of a monitoring report, which ``report`` makes of a table of events, for every window that a batch adds to, open or not.
    Read with ``sinks.read_report``."""

    def parts(rows: DataFrame) -> dict[str, DataFrame]:
        return report_parts(report(rows), keys)

    return _start(events, parts, ["window_start", "window_end", *keys], path, checkpoint, ts_col, window, delay, merge_every, every, drain)


def _start(
    events: DataFrame,
    parts: Callable[[DataFrame], dict[str, DataFrame]],
    states: list[str] | None,
    path: str,
    checkpoint: str,
    ts_col: str,
    window: str,
    delay: str,
    merge_every: int,
    every: str | None,
    drain: bool,
) -> StreamingQuery:
    """``states``: the columns that name a window, if later results replace earlier ones."""
    require_columns(events, [ts_col])
    if END in events.columns:
        raise ValueError(f"a name of this job, rename this column first: {END}")
    wait = micros_of(events.sparkSession, delay)
    checkpoint_root(events.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path)
        if store.is_done(batch_id):
            return
        before, name = store.last() or Record(-1), f"batch-{batch_id:09d}"
        closed = before.notes.get("closed")
        timed = batch.filter(event_time(batch, ts_col).isNotNull())
        own = timed.withColumn(END, F.unix_micros(F.window(event_time(timed, ts_col), window)["end"]))
        if closed is not None:
            own = own.filter(F.col(END) > closed)
        own.write.mode("overwrite").parquet(f"{store.path}/{name}/{OPEN}")
        folders = [folder for folder in (before.base, *before.versions) if folder]
        reader = batch.sparkSession.read.schema(own.schema)
        added = reader.parquet(f"{store.path}/{name}/{OPEN}")
        waiting = reader.parquet(*(f"{store.path}/{folder}/{OPEN}" for folder in [*folders, name]))
        seen = added.agg(F.max(F.unix_micros(event_time(added, ts_col)))).first()[0]
        latest = max((x for x in (seen, before.notes.get("latest")) if x is not None), default=None)
        now_closed = None if latest is None else latest - wait
        # what was closed before may still be in the folders
        unjudged = waiting if closed is None else waiting.filter(F.col(END) > closed)
        if states is None:
            chosen = unjudged.filter(F.col(END) <= F.lit(now_closed).cast("long"))
        else:
            # a number for each window; a join by shuffle would send a window to one task
            chosen = unjudged.join(F.broadcast(added.select(END).distinct()), END, "left_semi")
        found = parts(chosen.drop(END))
        for part, rows in found.items():
            if states is not None:
                # few, evenly filled files
                rows = rows.withColumn(VERSION, F.lit(batch_id).cast("long")).hint("rebalance")
            rows.write.mode("overwrite").parquet(f"{store.path}/{name}/{part}")
        record = Record(batch_id, before.base, (*before.versions, name), (), {"latest": latest, "closed": now_closed})
        store.commit(record)
        if len(record.versions) >= merge_every and now_closed is not None:
            merged = f"merged-{batch_id:09d}"
            waiting.filter(F.col(END) > now_closed).write.mode("overwrite").parquet(f"{store.path}/{merged}/{OPEN}")
            if states is not None:
                for part in found:
                    newest_states(store.read(part), states).hint("rebalance").write.mode("overwrite").parquet(f"{store.path}/{merged}/{part}")
            old = [folder for folder in (record.base, *record.versions) if folder]
            # judged events stay where they are
            replaced = tuple(old if states is not None else (f"{folder}/{OPEN}" for folder in old))
            store.commit(Record(batch_id, merged, (), replaced, record.notes))

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
