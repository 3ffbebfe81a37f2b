import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from streamwatch.operators.anomaly import flagged_only, iqr_anomalies, zscore_anomalies
from streamwatch.operators.drift import data_drift, label_drift, label_drift_alerts, monitoring_report
from streamwatch.operators.isolation_forest import fit_isolation_forest
from streamwatch.operators.scoring import score_events, train_classifier
from streamwatch.operators.window_stats import amount_statistics
from streamwatch.schema import COMPONENTS, FEATURE_COLUMNS
from streamwatch.sources.files import stream_files
from streamwatch.streaming.jobs import anomaly_job, drift_job, scoring_job
from streamwatch.streaming.sinks import await_queries, read_report, to_console, to_files, to_reports

SCHEMA = "id long, timestamp string, Amount double, Class int"
BASE = dt.datetime(2024, 1, 1)


def events(minutes, start_id=0, seed=0):
    """One event every 20 seconds in the given minutes."""
    rng = random.Random(seed)
    out = []
    for minute in minutes:
        for second in (0, 20, 40):
            when = BASE + dt.timedelta(minutes=minute, seconds=second)
            amount = 500.0 if rng.random() < 0.05 else rng.gauss(50, 5)
            out.append((start_id + len(out), when.isoformat(), amount, int(rng.random() < 0.2)))
    return out


class Feed:
    """A folder of files that a stream reads in the order of writing."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.rows, self.count = spark, folder, [], 0
        (folder / "in").mkdir()

    def add(self, rows):
        self.count += 1
        target = self.folder / "in" / f"{self.count:03d}.json"
        target.write_text("\n".join(json.dumps(dict(zip(("id", "timestamp", "Amount", "Class"), r))) for r in rows))
        # file streams order by modification time
        stamp = 1_700_000_000 + self.count
        os.utime(target, (stamp, stamp))
        self.rows += rows

    def stream(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return stream_files(self.spark, str(self.folder / "in"), schema, fmt="json", max_files=1)

    def table(self):
        return self.spark.createDataFrame(self.rows, SCHEMA)

    def drain(self, frame, name="out"):
        path = str(self.folder / name)
        query = to_files(frame, path, str(self.folder / f"{name}-state"), drain=True)
        await_queries([query])
        return self.spark.read.schema(frame.schema).parquet(path)


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def closed(frame, rows, minutes_late=10):
    newest = max(dt.datetime.fromisoformat(r[1]) for r in rows) - dt.timedelta(minutes=minutes_late)
    ends = F.col("window_start") + F.expr("INTERVAL 5 MINUTES")
    return frame.filter(ends <= F.lit(newest))


def rounded(frame, *columns):
    values = []
    for name in columns:
        column = F.col(name)
        values.append(F.round(column, 9) if frame.schema[name].dataType.simpleString() == "double" else column)
    return sorted(map(str, frame.select(*values).collect()))


@pytest.mark.parametrize("keys", [[], ["Class"]])
@pytest.mark.parametrize("operator", [zscore_anomalies, iqr_anomalies])
def test_stream_judges_like_a_table_once_windows_close(feed, operator, keys):
    feed.add(events(range(0, 30)))
    feed.add(events(range(30, 60), 1000, seed=1))
    got = feed.drain(operator(feed.stream(), keys=keys, delay="10 minutes"))
    want = closed(operator(feed.table(), keys=keys), feed.rows)
    columns = ["id", "timestamp", "Amount", "window_start", "avg_amount", "is_anomaly"]
    assert rounded(got, *columns) == rounded(want, *columns)
    assert got.count() > 100


def test_null_keys_join_on_a_stream(feed):
    rows = [(i, t, a, None if i % 3 else 1) for i, t, a, _ in events(range(0, 40))]
    feed.add(rows)
    got = feed.drain(zscore_anomalies(feed.stream(), keys=["Class"], delay="1 minute"))
    assert got.filter("Class IS NULL").count() > 50
    assert got.filter("avg_amount IS NULL").count() == 0


@pytest.mark.parametrize("salts", [1, 7])
def test_salts_do_not_change_the_result(feed, salts):
    feed.add(events(range(0, 40)))
    frame = zscore_anomalies(feed.stream(), delay="1 minute", salts=salts, salt_by=["id"])
    want = closed(zscore_anomalies(feed.table()), feed.rows, 1)
    assert rounded(feed.drain(frame), "id", "z_score") == rounded(want, "id", "z_score")


def test_a_stream_needs_a_delay(feed):
    for operator in (zscore_anomalies, iqr_anomalies, amount_statistics, data_drift, label_drift):
        with pytest.raises(ValueError, match="delay"):
            operator(feed.stream())


def test_late_events_count_while_their_window_is_open(feed):
    feed.add([(i, t, 50.0, y) for i, t, _, y in events(range(0, 12))])
    feed.add([(i, t, 50.0, y) for i, t, _, y in events(range(12, 13), 1000)])
    late = (900, (BASE + dt.timedelta(minutes=10, seconds=1)).isoformat(), 77.0, 0)
    too_late = (901, (BASE + dt.timedelta(minutes=1)).isoformat(), 88.0, 0)
    feed.add([late, too_late])
    feed.add([(i, t, 50.0, y) for i, t, _, y in events(range(40, 41), 2000)])
    path, state = str(feed.folder / "late"), str(feed.folder / "late-state")
    stats = amount_statistics(feed.stream(), delay="1 minute")
    query = to_files(stats, path, state, drain=True)
    await_queries([query])
    maxima = {r.window_start.minute: r.max_amount for r in feed.spark.read.parquet(path).collect()}
    assert maxima == {0: 50.0, 5: 50.0, 10: 77.0}
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1


def test_restart_neither_repeats_nor_loses_windows(feed):
    def frame():
        return zscore_anomalies(feed.stream(), delay="5 minutes")

    for part in range(3):
        feed.add(events(range(part * 12, part * 12 + 12), part * 1000, seed=part))
        got = feed.drain(frame())
    got = feed.drain(frame())
    want = closed(zscore_anomalies(feed.table()), feed.rows, 5)
    assert rounded(got, "id", "z_score") == rounded(want, "id", "z_score")


def test_update_report_holds_the_newest_state_of_every_window(feed):
    feed.add(events(range(0, 15)))
    feed.add(events(range(10, 25), 1000, seed=1))
    path = str(feed.folder / "report")
    query = to_reports(
        monitoring_report(feed.stream(), delay="10 minutes"), path, str(feed.folder / "state"), drain=True
    )
    await_queries([query])
    table = feed.table()
    for name, want in (("data", data_drift(table)), ("label", label_drift(table))):
        got = read_report(feed.spark, path, name)
        assert got.columns == want.columns
        assert rounded(got, *got.columns) == rounded(want, *want.columns)


def test_report_uses_one_state_store(feed):
    feed.add(events(range(0, 15)))
    query = to_reports(
        monitoring_report(feed.stream(), delay="10 minutes"),
        str(feed.folder / "report"), str(feed.folder / "state"), drain=True,
    )
    await_queries([query])
    assert {len(p.stateOperators) for p in query.recentProgress} == {1}


def test_alerts_on_a_stream(feed):
    feed.add(events(range(0, 60)))
    alerts = label_drift_alerts(label_drift(feed.stream(), delay="1 minute"), baseline_rate_percent=20)
    got = feed.drain(alerts)
    want = label_drift_alerts(label_drift(feed.table()), baseline_rate_percent=20)
    flags = {r.window_start: r.has_label_drift for r in want.collect()}
    assert got.count() == 5
    assert all(flags[r.window_start] == r.has_label_drift for r in got.collect())


def test_first_failure_stops_the_other_queries(feed):
    feed.add(events(range(0, 2)))

    def fail(batch, batch_id):
        raise RuntimeError("broken sink")

    waiting = to_console(feed.stream(), checkpoint=str(feed.folder / "a"), every="1 hour")
    broken = (
        feed.stream().writeStream.foreachBatch(fail)
        .option("checkpointLocation", str(feed.folder / "b")).start()
    )
    with pytest.raises(StreamingQueryException):
        await_queries([waiting, broken])
    assert not waiting.isActive


# --- whole jobs, from JSON messages -------------------------------------------


@pytest.fixture()
def messages(spark, tmp_path):
    """Messages as a topic would carry them: one JSON text per row, labels as doubles."""
    (tmp_path / "topic").mkdir()
    lines = []
    for _, timestamp, amount, label in events(range(0, 60)):
        event = {name: random.Random(len(lines)).gauss(label * 3, 1) for name in COMPONENTS}
        event |= {"Time": float(len(lines)), "Amount": amount, "Class": float(label), "timestamp": timestamp}
        lines.append(json.dumps(event))
    lines += ["garbage", '{"Amount": NaN, "timestamp": "2024-01-01T00:00:01"}']
    (tmp_path / "topic" / "1.txt").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "value string").schema
    return stream_files(spark, str(tmp_path / "topic"), schema, fmt="text"), tmp_path


@pytest.mark.parametrize("method", ["zscore", "iqr"])
def test_anomaly_job(spark, messages, method):
    stream, folder = messages
    query = anomaly_job(
        stream, method=method, path=str(folder / "out"), checkpoint=str(folder / "state"),
        delay="1 minute", drain=True,
    )
    await_queries([query])
    got = spark.read.parquet(str(folder / "out"))
    assert 0 < got.count() < 60
    assert {r.is_anomaly for r in got.collect()} == {True}


def test_anomaly_job_with_a_fitted_forest(spark, messages):
    stream, folder = messages
    table = spark.read.json(str(folder / "topic")).select("Amount")
    forest = fit_isolation_forest(table, trees=20, sample_size=64, contamination=0.2)
    options = {"drain": True, "checkpoint": str(folder / "state"), "path": str(folder / "out")}
    await_queries([anomaly_job(stream, method="isolation_forest", forest=forest, **options)])
    got = spark.read.parquet(str(folder / "out"))
    want = forest.transform(table).filter("is_anomaly")
    assert sorted(r.Amount for r in got.collect()) == sorted(r.Amount for r in want.collect()) != []


def test_anomaly_job_refuses_an_unknown_method(messages):
    with pytest.raises(ValueError, match="forest"):
        anomaly_job(messages[0], method="forest")
    with pytest.raises(ValueError, match="fitted"):
        anomaly_job(messages[0], method="isolation_forest")


def test_scoring_job_then_drift_job(spark, messages):
    stream, folder = messages
    parsed = spark.read.json(str(folder / "topic")).filter("Time IS NOT NULL").drop("_corrupt_record")
    model = train_classifier(parsed, FEATURE_COLUMNS, trees=5, depth=4)
    options = {"drain": True, "checkpoint": str(folder / "s1"), "path": str(folder / "scores")}
    await_queries([scoring_job(stream, model, **options)])
    scores = spark.read.parquet(str(folder / "scores"))
    assert scores.count() == 182 and scores.filter("is_fraud IS NULL").count() == 2
    assert scores.filter("is_fraud = Class").count() > 170

    options = {"drain": True, "checkpoint": str(folder / "s2"), "path": str(folder / "reports")}
    await_queries([drift_job(stream, model, window="1 hour", **options)])
    quality = read_report(spark, str(folder / "reports"), "performance").first()
    batch = score_events(parsed, model).filter("is_fraud = 1 AND Class = 1").count()
    assert quality.tp == batch > 20
    labels = read_report(spark, str(folder / "reports"), "label").first()
    assert labels.total_transactions == 181 and labels.fraud_count > 20


def test_drift_job_without_a_model(spark, messages):
    stream, folder = messages
    query = drift_job(
        stream, window="1 hour", path=str(folder / "reports"), checkpoint=str(folder / "s"), drain=True
    )
    await_queries([query])
    data = read_report(spark, str(folder / "reports"), "data").first()
    assert (data.transaction_count, data.invalid_count) == (181, 1)
    assert data.has_data_drift is True
    assert read_report(spark, str(folder / "reports"), "label").first().has_label_drift is True
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_report(spark, str(folder / "reports"), "performance")


def test_console_jobs_run(messages):
    stream, folder = messages
    query = drift_job(stream, window="1 hour", checkpoint=str(folder / "c"), drain=True)
    await_queries([query])
    first = query.recentProgress[0]
    assert "Console" in first.sink.description and first.numInputRows == 182


def test_files_by_partition(feed):
    feed.add(events(range(0, 3)))
    path = feed.folder / "split"
    query = to_files(
        feed.stream(), str(path), str(feed.folder / "state"), partition_by=["Class"], drain=True
    )
    await_queries([query])
    assert {p.name for p in path.glob("Class=*")} == {f"Class={r[3]}" for r in feed.rows}
    assert feed.spark.read.parquet(str(path)).count() == len(feed.rows)


def test_csv_files_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("a,b\n1,x\n2,y\n")
    stream = stream_files(spark, str(tmp_path / "in"), "a int, b string", fmt="csv")
    query = to_files(stream, str(tmp_path / "out"), str(tmp_path / "state"), drain=True)
    await_queries([query])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1, "x"), (2, "y")]


def test_file_sinks_need_a_checkpoint(messages):
    with pytest.raises(ValueError, match="checkpoint"):
        anomaly_job(messages[0], path="/nowhere")


def test_iqr_filter_has_a_flag(feed):
    feed.add(events(range(0, 40)))
    got = feed.drain(flagged_only(iqr_anomalies(feed.stream(), delay="1 minute")))
    want = flagged_only(closed(iqr_anomalies(feed.table()), feed.rows, 1))
    assert rounded(got, "id") == rounded(want, "id") and got.count() > 0
