"""Dealing messages out, the transactional store, restarts, and the previous window."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamwatch.schema import FEATURE_COLUMNS
from streamwatch.sources.files import SLICE, publish_slices, sliced_by_time, stream_files
from streamwatch.streaming import sinks
from streamwatch.streaming.ingest import ingest_counts, ingest_job, ingest_totals, micros_of, read_route, routed, stream_route
from streamwatch.streaming.jobs import anomaly_job
from streamwatch.streaming.sinks import await_queries, read_report, to_reports
from streamwatch.streaming.store import Record, Store

WIRE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def _message(time, amount=1.0, **more):
    return json.dumps({**dict.fromkeys(FEATURE_COLUMNS, 1.0), "timestamp": time, "Amount": amount, "Class": 0.0} | more)


def _time(minute):
    return f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00"


def _ingest(spark, folder, **options):
    stream = stream_files(spark, str(folder / "in"), WIRE, max_files=1)
    where = {"path": str(folder / "routes"), "checkpoint": str(folder / "state"), "drain": True}
    query = ingest_job(stream, window="10 minutes", delay="5 minutes", keep=["key"], **where | options)
    await_queries([query])


def _publish(spark, folder, batches):
    rows = [(k, str(i), value) for k, batch in batches.items() for i, value in batch]
    df = spark.createDataFrame(rows, f"{SLICE} int, key string, value string")
    publish_slices(df, str(folder / "in"))


#: Batch 2 knows the batches 0 and 1: the latest time is 0:31, so windows up to 0:26 are closed.
BATCHES = {
    0: [(1, _message(_time(1))), (2, "garbage"), (3, None), (4, _message(None))],
    1: [(5, _message(_time(31))), (6, _message(_time(3)))],
    2: [(7, _message(_time(9))), (8, _message(_time(20))), (9, _message(_time(32))), (10, _message(_time(19), Amount="x"))],
}


def test_every_message_goes_one_way(spark, tmp_path):
    _publish(spark, tmp_path, BATCHES)
    _ingest(spark, tmp_path)
    path = str(tmp_path / "routes")
    found = {route: sorted(int(r.key) for r in read_route(spark, path, route).collect()) for route in ("events", "late", "dead")}
    assert found == {"events": [1, 5, 6, 8, 9], "late": [7], "dead": [2, 3, 4, 10]}
    reasons = {int(r.key): (r.reason, r.raw is None) for r in read_route(spark, path, "dead").collect()}
    assert reasons == {2: ("unreadable", False), 3: ("empty", True), 4: ("no time", False), 10: ("unreadable", False)}
    assert [tuple(r) for r in ingest_counts(spark, path).orderBy("batch_id").collect()] == [(0, 4, 1, 0, 3), (1, 2, 2, 0, 0), (2, 4, 2, 1, 1)]
    assert ingest_totals(spark, path) == {"messages": 10, "events": 5, "late": 1, "dead": 4}
    # a windowed query on the route of events misses nothing of it
    spark_rows = stream_route(spark, path, max_files=1)
    assert spark_rows.isStreaming and "raw" not in spark_rows.columns


def test_a_batch_that_failed_before_its_record_is_dealt_out_again(spark, tmp_path, monkeypatch):
    _publish(spark, tmp_path, {k: BATCHES[k] for k in (0, 1)})
    _ingest(spark, tmp_path)
    path = str(tmp_path / "routes")
    _publish(spark, tmp_path, {2: BATCHES[2]})
    commit = Store.commit
    monkeypatch.setattr(Store, "commit", lambda *rest: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        _ingest(spark, tmp_path)
    # its folder is there, but does not count
    assert Store(spark, path).folder.exists("batch_id=2") and read_route(spark, path, "late").count() == 0
    monkeypatch.setattr(Store, "commit", commit)
    _ingest(spark, tmp_path)
    assert [r.key for r in read_route(spark, path, "late").collect()] == ["7"]
    assert ingest_totals(spark, path)["messages"] == 10


def test_jobs_take_the_route_of_events(spark, tmp_path):
    batches = {k: [(100 * k + i, _message(_time(10 * k + i % 10), 500.0 if i == 7 else 50.0 + i % 3)) for i in range(20)] + [(1000 + k, "{")] for k in range(6)}
    _publish(spark, tmp_path, batches)
    _ingest(spark, tmp_path)
    events = stream_route(spark, str(tmp_path / "routes"), max_files=1)
    where = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "jobs"), "drain": True}
    await_queries([anomaly_job(events, window="10 minutes", delay="5 minutes", keep=["key"], **where)])
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(int(r.key) for r in found.collect()) == [100 * k + 7 for k in range(5)]


def test_keys_of_an_anomaly_job(spark, tmp_path):
    rows = [(0, str(i % 2), _message(_time(i % 10), 900.0 if i == 40 else 50.0 + i % 3 + 400 * (i % 2))) for i in range(60)]
    rows.append((1, "0", _message(_time(200))))
    publish_slices(spark.createDataFrame(rows, f"{SLICE} int, key string, value string"), str(tmp_path / "in"))
    messages = stream_files(spark, str(tmp_path / "in"), WIRE, max_files=1)
    where = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "jobs"), "drain": True}
    await_queries([anomaly_job(messages, window="10 minutes", delay="5 minutes", keys=["key"], **where)])
    assert [(r.key, r.Amount) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("0", 900.0)]


def test_routes_of_a_table(spark):
    rows = [(str(i), value) for batch in BATCHES.values() for i, value in batch]
    found = routed(spark.createDataFrame(rows, WIRE), None, keep=["key"])
    assert {r.route: r["count"] for r in found.groupBy("route").count().collect()} == {"events": 6, "dead": 4}
    assert micros_of(spark, "10 minutes") == 600_000_000 and micros_of(spark, "1 day") == 86_400_000_000


def _report(n, value):
    return lambda spark: spark.range(n).select(
        F.timestamp_seconds(F.col("id") * 600).alias("window_start"), F.timestamp_seconds(F.col("id") * 600 + 600).alias("window_end"), F.lit(value).alias("total_transactions"),
        F.lit(1).alias("fraud_count"), F.lit(2.0).alias("fraud_rate_percent"),
    )


class _Batches:
    """Calls the writer of a report as a query would, one batch after another."""

    def __init__(self, spark, monkeypatch):
        self.spark, self.write = spark, None
        monkeypatch.setattr(sinks, "_writer", lambda *rest: self)

    def foreachBatch(self, write):  # noqa: N802
        self.write = write
        return self

    def option(self, *rest):
        return self

    def start(self):
        return self


def test_fifty_batches_leave_few_folders(spark, tmp_path, monkeypatch):
    batches, path = _Batches(spark, monkeypatch), str(tmp_path / "reports")
    to_reports(None, path, "unused", compact_every=6)
    for k in range(50):
        batches.write(_report(1 + k % 7, k)(spark), k)
        assert read_report(spark, path, "label").count() == min(k + 1, 7)
    folders = [name for name in Store(spark, path).folder.names() if not name.startswith("_")]
    assert len(folders) <= 14 and len(Store(spark, path).records()) <= 6
    newest = {r.window_start: r.total_transactions for r in read_report(spark, path, "label").collect()}
    # the newest batch that held a window
    assert [newest[start] for start in sorted(newest)] == [max(k for k in range(50) if k % 7 >= i) for i in range(7)]


def test_a_failure_between_two_parts_shows_nothing(spark, tmp_path, monkeypatch):
    batches, path = _Batches(spark, monkeypatch), str(tmp_path / "reports")
    to_reports(None, path, "unused")
    rows = _report(2, 1)(spark)
    batches.write(rows, 0)
    parts = sinks.report_parts
    failing = lambda batch, keys: {**parts(batch, keys), "data": batch.select(F.raise_error(F.lit("lost")).alias("x"))}
    monkeypatch.setattr(sinks, "report_parts", failing)
    with pytest.raises(Exception, match="lost"):
        batches.write(_report(2, 5)(spark), 1)
    assert {r.total_transactions for r in read_report(spark, path, "label").collect()} == {1}
    monkeypatch.setattr(sinks, "report_parts", parts)
    batches.write(_report(2, 5)(spark), 1)
    assert {r.total_transactions for r in read_report(spark, path, "label").collect()} == {5}
    # a batch that was committed is not written again
    batches.write(_report(2, 9)(spark), 1)
    assert {r.total_transactions for r in read_report(spark, path, "label").collect()} == {5}


def test_records_in_order(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.last() is None and not store.is_done(0)
    for k in range(20):
        store.commit(Record(k, notes={"k": k, "ä": "ö"}))
    assert store.last() == Record(19, notes={"k": 19, "ä": "ö"}) and store.is_done(19) and not store.is_done(20)


def test_slices_follow_time(spark):
    rows = spark.range(1000).select(F.timestamp_seconds(F.pmod(F.col("id") * 37, F.lit(1000))).alias("timestamp"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "timestamp timestamp, id long"))
    found = sliced_by_time(rows, "timestamp", 4).groupBy(SLICE).agg(F.min("timestamp"), F.max("timestamp"), F.count("*").alias("n")).orderBy(SLICE).collect()
    assert len(found) == 4 and all(a[2] < b[1] for a, b in zip(found, found[1:])) and all(200 < r.n < 300 for r in found)
    assert sum(r.n for r in found) == 1001
    assert sliced_by_time(rows.limit(0), "timestamp", 4).count() == 0
