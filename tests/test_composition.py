"""Operators after one another, in sessions of any zone, on windows and forests of any size."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from streamwatch.functions.messages import stamp_missing_time
from streamwatch.functions.values import event_time, utc_clock
from streamwatch.operators.anomaly import iqr_anomalies, iqr_bounds, zscore_anomalies
from streamwatch.operators.drift import data_drift, label_drift
from streamwatch.operators.isolation_forest import fit_isolation_forest
from streamwatch.operators.window_stats import amount_statistics
from streamwatch.sources.files import stream_files
from streamwatch.streaming.sinks import await_queries, to_files

DAY = "1 day"


def _rows(n, start="2024-01-01T00:00:00"):
    first = datetime.datetime.fromisoformat(start)
    return [((first + datetime.timedelta(minutes=k)).isoformat(), float(k % 50), k % 2) for k in range(n)]


def test_methods_follow_each_other(transactions):
    df = transactions(_rows(200))
    scores = zscore_anomalies(df, window=DAY)
    both = iqr_anomalies(scores, window=DAY).collect()
    alone = iqr_anomalies(df, window=DAY)
    assert len(both) == 200 and {"z_score", "q1", "q3", "window_start"} <= set(both[0].asDict())
    expected = {(row.timestamp, row.Amount): (row.q1, row.q3, row.is_anomaly) for row in alone.collect()}
    assert {(r.timestamp, r.Amount): (r.q1, r.q3, r.is_anomaly) for r in both} == expected
    assert data_drift(scores, window=DAY).first().transaction_count == 200


def test_results_replace_columns_of_their_name(transactions):
    df = transactions(_rows(20)).withColumn("avg_amount", F.lit("old")).withColumn("window_start", F.lit(0))
    rows = zscore_anomalies(df, window=DAY).collect()
    assert all(row.avg_amount == 9.5 and row.window_start.year == 2024 for row in rows)
    with pytest.raises(ValueError, match="avg_amount"):
        zscore_anomalies(df.withColumn("avg_amount", F.lit(1.0)), value_col="avg_amount")


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "UTC"])
def test_times_are_utc_in_any_session(spark, setting, transactions, zone):
    setting("spark.sql.session.timeZone", zone)
    df = transactions([("2024-03-10T01:00:00", 1.0, 0), ("2024-03-10 02:30:00", 2.0, 0), ("2024-03-10", 3.0, 0), ("2024-03-10T23:30:00-05:00", 9.0, 0), ("nonsense", 1.0, 0)])
    naive = df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
    shown = df.select(utc_clock(event_time(df, "timestamp")).cast("string").alias("t")).collect()
    assert [row.t for row in shown] == ["2024-03-10 01:00:00", "2024-03-10 02:30:00", "2024-03-10 00:00:00", "2024-03-11 04:30:00", None]
    kept = naive.select(utc_clock(event_time(naive, "timestamp")).cast("string").alias("t")).collect()
    assert [row.t for row in kept][:3] == ["2024-03-10 01:00:00", "2024-03-10 02:30:00", "2024-03-10 00:00:00"]
    assert sorted(row.avg_amount for row in amount_statistics(df, window=DAY).collect()) == [2.0, 9.0]
    stamped = stamp_missing_time(df.withColumn("timestamp", F.lit(None).cast("string"))).first().timestamp
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs((datetime.datetime.fromisoformat(stamped) - now).total_seconds()) < 60


def test_labels_are_summed_as_they_are(spark):
    rows = [("2024-01-01T00:00:00", 0.5), ("2024-01-01T00:01:00", 0.6), ("2024-01-02T00:00:00", 1e12)]
    df = spark.createDataFrame(rows, "timestamp string, Class double")
    found = sorted(row.fraud_count for row in label_drift(df, window=DAY).collect())
    assert found == [1.1, 1e12]
    whole = label_drift(df.withColumn("Class", F.lit(1)), window=DAY)
    assert dict(whole.dtypes)["fraud_count"] == "bigint" and sorted(r.fraud_count for r in whole.collect()) == [1, 2]


def test_percentiles_of_a_large_window_are_exact(spark):
    n = 1_200_000
    df = spark.range(n).select(F.lit("2024-01-01T00:00:00").alias("timestamp"), F.pmod(F.col("id") * 7919, F.lit(n)).cast("double").alias("Amount"))
    row = data_drift(df, window=DAY, accuracy=None).first()
    # the k-th of 0, 1, 2, ... is k - 1
    assert (row.median_amount, row.p95_amount, row.p99_amount) == (n * 0.5 - 1, n * 0.95 - 1, n * 0.99 - 1)


def test_exact_percentiles_of_odd_groups(spark):
    rows = [("2024-01-01T00:00:00", 1.0, "a"), ("2024-01-01T00:00:01", 1.0, "a"), ("2024-01-01T00:00:02", float("nan"), "a"), ("2024-01-01T00:00:03", 5.0, None), ("2024-01-01T00:00:04", None, "b")]
    df = spark.createDataFrame(rows, "timestamp string, Amount double, card string")
    found = {row.card: (row.q1, row.q3) for row in iqr_bounds(df, window=DAY, keys=["card"], accuracy=None).collect()}
    assert found == {"a": (1.0, 1.0), None: (5.0, 5.0), "b": (None, None)}
    assert iqr_bounds(df.limit(0), window=DAY, accuracy=None).count() == 0


@pytest.mark.parametrize("rows", [7_900, 8_100])
@pytest.mark.parametrize("partitions", [2, 9])
def test_every_tree_has_its_sample(spark, rows, partitions):
    df = spark.range(rows).select(F.col("id").cast("double").alias("Amount")).repartition(partitions)
    nodes = fit_isolation_forest(df, trees=1000, sample_size=2).nodes
    assert nodes["tree"].nunique() == 1000 and set(nodes["sample"]) == {2}
    assert set(nodes.groupby("tree").size()) == {3}
    few = fit_isolation_forest(df.limit(5), trees=3, sample_size=256).nodes
    assert set(few["sample"]) == {5}
    with pytest.raises(ValueError, match="nodes"):
        fit_isolation_forest(df, trees=10, sample_size=10, max_nodes=100)


def test_a_restart_with_other_partitions_loses_nothing(spark, setting, transactions, tmp_path):
    """Files in the order of time, one per batch; the number of shuffle partitions changes in between."""
    rows = _rows(900)
    schema = transactions(rows[:1]).schema
    for part in range(3):
        if part:
            setting("spark.sql.shuffle.partitions", (2, 32)[part - 1])
        own = pd.DataFrame(rows[300 * part : 300 * part + 300], columns=schema.names)
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = stream_files(spark, str(tmp_path / "in"), schema, max_files=1)
        judged = zscore_anomalies(stream, window="1 hour", delay="1 minute")
        await_queries([to_files(judged, str(tmp_path / "out"), str(tmp_path / "state"), drain=True)])
    found = spark.read.parquet(str(tmp_path / "out"))
    closed = {row.window_start for row in found.select("window_start").distinct().collect()}
    assert len(closed) >= 13 and found.filter("avg_amount is null").count() == 0
    batch = zscore_anomalies(transactions(rows), window="1 hour").filter(F.col("window_start").isin(list(closed)))
    columns = ["timestamp", "Amount", F.round("avg_amount", 9), F.round("z_score", 9)]
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))
