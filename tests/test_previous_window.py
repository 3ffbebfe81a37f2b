"""Judging against the window before, against plain Python."""

import math
import random

from pyspark.sql import functions as F

from streamwatch.sources.files import SLICE, publish_slices, stream_files
from streamwatch.streaming.previous_window import merged_moments, previous_window_job, read_judged
from streamwatch.streaming.sinks import await_queries
from streamwatch.streaming.store import Store

SCHEMA = "id long, timestamp string, Amount double, card string"


def _rows(seed=2, windows=12):
    draw, rows = random.Random(seed), []
    for window in range(windows):
        if window == 5:
            continue  # a gap: the window after it has none before
        for _ in range(draw.randint(1, 12)):
            amount = draw.choice([draw.gauss(50, 5), draw.gauss(50, 5), 500.0, None, float("nan")])
            rows.append((len(rows), f"2024-01-01T0{window // 6}:{window % 6}{draw.randint(0, 9)}:00", amount, draw.choice(["a", "b", None])))
    return rows


def _expected(rows, keyed):
    known = {}
    for _, time, amount, card in rows:
        if amount is not None and not math.isnan(amount):
            known.setdefault((time[:15], card if keyed else None), []).append(amount)
    found = {}
    for i, time, amount, card in rows:
        minutes = int(time[11:13]) * 60 + int(time[14]) * 10 - 10
        before = known.get((f"2024-01-01T{minutes // 60:02d}:{minutes % 60 // 10}", card if keyed else None)) if minutes >= 0 else None
        if not before:
            found[i] = (None, None, None)
            continue
        mean = sum(before) / len(before)
        sd = math.sqrt(sum((x - mean) ** 2 for x in before) / (len(before) - 1)) if len(before) > 1 else None
        if not sd:
            z = 0.0
        else:
            z = None if amount is None or math.isnan(amount) else abs(amount - mean) / sd
        found[i] = (mean, sd, z)
    return found


def _close(a, b):
    return a is b is None or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def _run(spark, folder, rows, batches, **options):
    size = -(-len(rows) // batches)
    df = spark.createDataFrame([(k // size, *row) for k, row in enumerate(rows)], f"{SLICE} int, {SCHEMA}")
    for run in range(2):
        publish_slices(df, str(folder / "in"), range(run * (batches // 2), batches if run else batches // 2))
        stream = stream_files(spark, str(folder / "in"), df.drop(SLICE).schema, max_files=1)
        where = {"window": "10 minutes", "drain": True}
        await_queries([previous_window_job(stream, str(folder / "out"), str(folder / "state"), **where | options)])
    return read_judged(spark, str(folder / "out"))


def test_every_event_against_the_window_before(spark, tmp_path):
    rows = sorted(_rows(), key=lambda row: row[1])
    found = _run(spark, tmp_path, rows, 8, merge_every=3)
    expected = _expected(rows, False)
    got = {r.id: r for r in found.collect()}
    assert set(got) == set(expected) and found.count() == len(rows)
    for i, row in got.items():
        assert all(map(_close, (row.previous_avg, row.previous_stddev, row.z_score), expected[i])), (row, expected[i])
        assert row.is_anomaly == (None if row.z_score is None else row.z_score > 3.0)
    # old statistics were merged and dropped
    store = Store(spark, str(tmp_path / "out"))
    record = store.last()
    assert record.base is not None and len(record.versions) < 3
    assert spark.read.parquet(f"{store.path}/{record.base}/statistics").count() <= 3


def test_keys_and_null_keys(spark, tmp_path):
    rows = sorted(_rows(seed=7, windows=6), key=lambda row: row[1])
    expected = _expected(rows, True)
    for row in _run(spark, tmp_path, rows, 2, keys=["card"]).collect():
        assert all(map(_close, (row.previous_avg, row.previous_stddev, row.z_score), expected[row.id]))


def test_moments_merge_exactly(spark):
    """Far from zero, where sums of squares would lose all digits."""
    values = [1e9 + k % 7 for k in range(1000)]
    rows = spark.createDataFrame([(k % 13, v) for k, v in enumerate(values)], "batch long, v double")
    parts = rows.groupBy("batch").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"))
    (row,) = merged_moments(parts.withColumn("g", F.lit(1)), ["g"]).collect()
    mean = sum(v - 1e9 for v in values) / 1000
    assert row.n == 1000 and math.isclose(row.mean - 1e9, mean, abs_tol=1e-5)
    assert math.isclose(row.m2, sum((v - 1e9 - mean) ** 2 for v in values), rel_tol=1e-6)
