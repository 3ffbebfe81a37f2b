"""Whole windows of a stream: exact percentiles, against plain Python."""

import math
import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from streamwatch.operators.anomaly import iqr_anomalies
from streamwatch.operators.drift import monitoring_report
from streamwatch.registry.oracles import ORACLES
from streamwatch.registry.queries import QUERIES
from streamwatch.sources.files import SLICE, publish_slices, stream_files
from streamwatch.streaming.previous_window import read_judged
from streamwatch.streaming.sinks import await_queries, read_report
from streamwatch.streaming.store import Store
from streamwatch.streaming.whole_windows import closed_windows_job, window_reports_job
from tools.check_queries import connect, difference, types_differ

SCHEMA = "id long, timestamp string, Amount double, Class int"


def _quantile(values, q):
    return sorted(values)[max(1, math.ceil(q * len(values))) - 1]


def _rows(n=400):
    """Windows of ten minutes, each a batch of its own and some events of the next batch."""
    draw, rows = random.Random(4), []
    for k in range(n):
        batch = 8 * k // n
        amount = draw.choice([draw.gauss(50, 5), draw.gauss(50, 5), 500.0, None, float("nan")])
        window = max(0, batch - (draw.random() < 0.3))
        time = None if k % 50 == 7 else f"2024-01-01T0{window // 6}:{window % 6}{draw.randint(0, 9)}:00"
        rows.append((batch, k, time, amount, k % 2))
    # its window has closed long ago, and an event that is a copy of another
    return rows + [(7, n, "2024-01-01T00:01:00", 1e6, 1), rows[100]]


def _run(spark, folder, rows, job, result, **options):
    df = spark.createDataFrame(rows, f"{SLICE} int, {SCHEMA}")
    for numbers in (range(4), range(4, 8)):
        publish_slices(df, str(folder / "in"), numbers)
        stream = stream_files(spark, str(folder / "in"), df.drop(SLICE).schema, max_files=1)
        await_queries([job(stream, result, str(folder / "out"), str(folder / "state"), window="10 minutes", delay="10 minutes", drain=True, **options)])


def _by_window(rows):
    windows = {}
    for _, i, time, amount, _ in rows:
        if time and amount != 1e6:
            windows.setdefault(time[:15], []).append((i, amount if amount is not None and not math.isnan(amount) else None))
    return windows


def test_closed_windows_come_once_and_whole(spark, tmp_path):
    rows = _rows()
    _run(spark, tmp_path, rows, closed_windows_job, lambda df: iqr_anomalies(df, window="10 minutes", accuracy=None), merge_every=3)
    found = {}
    for row in read_judged(spark, str(tmp_path / "out")).collect():
        found.setdefault(row.timestamp[:15], []).append(row)
    windows = _by_window(rows)
    latest = datetime.fromisoformat(max(row[2] for row in rows if row[2]))
    closed = {start for start in windows if datetime.fromisoformat(f"{start}0:00") + timedelta(minutes=20) <= latest}
    assert set(found) == closed and 5 <= len(closed) < len(windows)
    for start, own in found.items():
        assert sorted(row.id for row in own) == sorted(i for i, _ in windows[start])
        known = [x for _, x in windows[start] if x is not None]
        q1, q3 = _quantile(known, 0.25), _quantile(known, 0.75)
        for row in own:
            assert (row.q1, row.q3) == (q1, q3)
            if row.Amount is not None and not math.isnan(row.Amount):
                assert row.is_anomaly == (not q1 - 1.5 * (q3 - q1) <= row.Amount <= q3 + 1.5 * (q3 - q1))


def test_reports_follow_every_batch(spark, tmp_path):
    rows = _rows()
    _run(spark, tmp_path, rows, window_reports_job, lambda df: monitoring_report(df, window="10 minutes", accuracy=None), merge_every=3)
    windows = _by_window(rows)
    found = {f"{row.at:%Y-%m-%dT%H:%M}"[:15]: row for row in read_report(spark, str(tmp_path / "out"), "data").withColumn("at", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert set(found) == set(windows)
    for start, row in found.items():
        known = [x for _, x in windows[start] if x is not None]
        assert row.transaction_count == len(windows[start])
        assert (row.median_amount, row.p95_amount, row.p99_amount) == tuple(_quantile(known, q) for q in (0.5, 0.95, 0.99))
    assert read_report(spark, str(tmp_path / "out"), "label").count() == len(windows)
    assert len(Store(spark, str(tmp_path / "out")).last().versions) < 3


def test_a_batch_without_times(spark, tmp_path):
    rows = [(k, k, None, 1.0, 0) for k in range(8)]
    _run(spark, tmp_path, rows, closed_windows_job, lambda df: iqr_anomalies(df, window="10 minutes", accuracy=None), merge_every=2)
    assert read_judged(spark, str(tmp_path / "out")).count() == 0


@pytest.fixture(scope="module")
def many(tmp_path_factory):
    """Days of more values than a sketch holds."""
    folder = tmp_path_factory.mktemp("many")
    duckdb.sql(f"""
      COPY (
        SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 9) SECOND AS ts, i % 97 AS user_id,
               ['error', 'view', 'click'][1 + i % 3] AS event_type, round(exp(3 * sin(i * i * 0.37) + (i % 1009) * 0.001) * 40, 6) AS value,
               '{{"k": ' || (i * 31 % 100) || '}}' AS props
        FROM range(40000) t(i)
      ) TO '{folder}/events.parquet'""")
    return str(folder)


@pytest.mark.parametrize("name", ["stream_iqr", "stream_monitor"])
def test_streams_give_the_events_and_percentiles_themselves(spark, many, name):
    con = connect(many)
    result = QUERIES[name](spark, many)
    assert ("event_id" if name == "stream_iqr" else "p99_amount") in result.columns
    assert types_differ(result, con, ORACLES[name]) is None
    want = con.sql(ORACLES[name]).df()
    assert len(want) > 3
    assert difference(result.toPandas(), want) is None
