"""Judging events as they come, against the window before theirs.

A window's own statistics are known when it has closed, so judging against them takes a window and the delay. Against the previous window an event is judged in
the batch that brings it. Each batch adds what it says about its windows to a table of statistics (counts, means and sums of squared distances,
which merge exactly by pairs), then joins its events to that table. A batch's rows for a window are added before any of its events are judged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamwatch.functions.sketches import GROUP_ROWS
from streamwatch.functions.values import event_time, finite, z_score
from streamwatch.plans.group_join import join_group_statistics
from streamwatch.schema import require_columns
from streamwatch.session import checkpoint_root
from streamwatch.streaming.ingest import micros_of
from streamwatch.streaming.store import Record, Store

#: Batches after which the statistics are merged into one folder.
MERGE_EVERY = 20
_MOMENTS = ("n", "mean", "m2")


def _window(time: Column, width: int) -> Column:
    micros = F.unix_micros(time)
    return micros - F.pmod(micros, F.lit(width))


def merged_moments(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group``, n, mean and m2 over rows of such; in the order of their ``batch``, so that a repeated merge gives the same digits."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        mean = a["mean"] + apart * b["n"] / n
        m2 = a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n
        return F.when(b["n"] > 0, F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))).otherwise(a)

    # a group has one row for each batch since the last merge
    parts = F.sort_array(F.collect_list(F.struct("batch", *_MOMENTS)))
    return rows.groupBy(*group).agg(F.aggregate(parts, begin, add).alias("all")).select(*group, "all.*")


def previous_window_job(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    ts_col: str = "timestamp",
    value_col: str = "Amount",
    window: str = "5 minutes",
    threshold: float = 3.0,
    keys: Sequence[str] = (),
    keep_windows: int = 2,
    merge_every: int = MERGE_EVERY,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Append every event of a stream to ``{path}/judged``, with previous_avg and previous_stddev (of the window before its own, and its ``keys``, as far as known),
    z_score and is_anomaly; without a previous window these are null. Statistics older than ``keep_windows`` windows behind the newest are dropped.
    Read with :func:`read_judged`."""
    require_columns(events, [ts_col, value_col, *keys])
    names = {"window_start", "previous_avg", "previous_stddev", "z_score", "is_anomaly"} & {*events.columns}
    if names:
        raise ValueError(f"names of results, rename these columns first: {sorted(names)}")
    width = micros_of(events.sparkSession, window)
    checkpoint_root(events.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, path)
        if store.is_done(batch_id):
            return
        before, name = store.last() or Record(-1), f"batch-{batch_id:09d}"
        rows = batch.withColumn("__at", _window(event_time(batch, ts_col), width)).persist()
        try:
            value = finite(value_col)
            own = rows.filter("__at is not null").groupBy("__at", *keys).agg(
                F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2")
            )
            own.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{store.path}/{name}/statistics")
            folders = [folder for folder in (before.base, *before.versions) if folder]
            parts = batch.sparkSession.read.parquet(*(f"{store.path}/{folder}/statistics" for folder in [*folders, name]))
            known = merged_moments(parts, ["__at", *keys]).filter("n > 0")
            deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
            known = known.select((F.col("__at") + width).alias("window_start"), *keys, F.col("mean").alias("previous_avg"), deviation.alias("previous_stddev"), F.col("n").alias(GROUP_ROWS))
            # all events of a window share a key, so the join goes by the measured size of the statistics
            joined = join_group_statistics(rows.withColumnRenamed("__at", "window_start"), known.checkpoint(), keys)
            score = F.when(F.col("previous_avg").isNotNull(), z_score(value, F.col("previous_avg"), F.col("previous_stddev")))
            judged = joined.withColumn("z_score", score).withColumn("is_anomaly", F.col("z_score") > threshold)
            judged.select(*batch.columns, "previous_avg", "previous_stddev", "z_score", "is_anomaly").write.mode("overwrite").parquet(f"{store.path}/{name}/judged")
            newest = max((x for x in (rows.agg(F.max("__at")).first()[0], before.notes.get("newest")) if x is not None), default=None)
        finally:
            rows.unpersist()
        record = Record(batch_id, before.base, (*before.versions, name), (), {"newest": newest})
        store.commit(record)
        if len(record.versions) >= merge_every and newest is not None:
            merged = f"merged-{batch_id:09d}"
            recent = merged_moments(parts, ["__at", *keys]).filter(F.col("__at") >= newest - keep_windows * width)
            recent.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{store.path}/{merged}/statistics")
            replaced = tuple(f"{folder}/statistics" for folder in (record.base, *record.versions) if folder)
            store.commit(Record(batch_id, merged, (), replaced, record.notes))

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def read_judged(spark: SparkSession, path: str) -> DataFrame:
    """The judged events of all committed batches."""
    store = Store(spark, path)
    last = (store.last() or Record(-1)).batch_id
    names = [name for name in store.folder.names() if name.startswith("batch-") and int(name.removeprefix("batch-")) <= last]
    return spark.read.parquet(*(f"{store.path}/{name}/judged" for name in names))
