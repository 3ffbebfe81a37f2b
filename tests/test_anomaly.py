import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamwatch.operators.anomaly import flagged_only, iqr_anomalies, iqr_bounds, zscore_anomalies
from streamwatch.operators.window_stats import amount_statistics
from streamwatch.plans.group_join import GROUP_ROWS, broadcast_limit, join_group_statistics

START = "2024-01-01T00:00:00"


def at_start(amounts):
    return [(START, a, 0) for a in amounts]


def test_single_row_and_constant_windows_score_zero(transactions):
    rows = [("2024-01-01T00:00:00", 5.0, 0)] + [("2024-01-01T00:05:00", 7.0, 0)] * 3
    for row in zscore_anomalies(transactions(rows)).collect():
        assert row.z_score == 0 and row.is_anomaly is False


def test_extreme_among_sixteen_is_flagged(transactions):
    amounts = [10.0, 11.0, 12.0] * 5 + [1000.0]
    flagged = flagged_only(zscore_anomalies(transactions(at_start(amounts)))).collect()
    assert [r.Amount for r in flagged] == [1000.0]
    assert math.isclose(flagged[0].z_score, 3.75, abs_tol=0.001)


def test_ten_rows_can_never_reach_three(transactions):
    scored = zscore_anomalies(transactions(at_start([1.0] * 9 + [1e6])))
    assert math.isclose(scored.agg(F.max("z_score")).first()[0], 9 / math.sqrt(10))
    assert flagged_only(scored).count() == 0


def test_unknown_amount_has_no_score(transactions):
    scored = zscore_anomalies(transactions(at_start([1.0, 2.0, None, float("nan")])))
    unknown = scored.filter("Amount IS NULL OR isnan(Amount)").collect()
    assert [(r.z_score, r.is_anomaly) for r in unknown] == [(None, None)] * 2
    assert flagged_only(scored).count() == 0
    assert scored.count() == 4


def test_threshold_is_strict(transactions):
    rows = transactions(at_start([1.0, 3.0]))
    z = zscore_anomalies(rows).first().z_score
    assert flagged_only(zscore_anomalies(rows, threshold=z)).count() == 0


def test_iqr_bounds_are_inclusive(transactions):
    # q1 = 2, q3 = 4, so the range is -1 to 7
    rows = transactions(at_start([1.0, 2.0, 3.0, 4.0, 7.0]))
    bounds = iqr_bounds(rows).first()
    assert (bounds.q1, bounds.q3, bounds.lower_bound, bounds.upper_bound) == (2, 4, -1, 7)
    assert flagged_only(iqr_anomalies(rows)).count() == 0
    assert [r.Amount for r in flagged_only(iqr_anomalies(rows, multiplier=1.4)).collect()] == [7.0]


def test_iqr_of_an_unknown_amount_is_unknown(transactions):
    rows = transactions(at_start([1.0, 2.0, 3.0, None]))
    assert [r.is_anomaly for r in iqr_anomalies(rows).filter("Amount IS NULL").collect()] == [None]


@pytest.fixture(scope="module")
def skewed(spark):
    """One user has a third of the rows, some rows have no user."""
    rng = np.random.default_rng(7)
    n = 3000
    users = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 900, n))
    rows = [
        (i, f"2024-01-01T00:{int(rng.integers(0, 20)):02d}:00", None if u == 5 else int(u), float(rng.gamma(2, 10)))
        for i, u in enumerate(users)
    ]
    return spark.createDataFrame(rows, "id int, timestamp string, user int, Amount double").repartition(6)


def brute_force(rows):
    groups = {}
    for r in rows:
        groups.setdefault((int(r.timestamp[14:16]) // 5, r.user), []).append(r)
    scores = {}
    for members in groups.values():
        amounts = np.array([m.Amount for m in members])
        deviation = amounts.std(ddof=1) if len(amounts) > 1 else 0.0
        for m in members:
            scores[m.id] = abs(m.Amount - amounts.mean()) / deviation if deviation > 0 else 0.0
    return scores


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_keyed_scores_match_brute_force_in_both_joins(skewed, setting, broadcast_bytes):
    if broadcast_bytes == 0:
        setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    scored = zscore_anomalies(skewed, keys=["user"], broadcast_bytes=broadcast_bytes)
    got = {r.id: r.z_score for r in scored.collect()}
    want = brute_force(skewed.collect())
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], abs_tol=1e-9) for i in want)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_small_statistics_are_broadcast_and_rows_do_not_move(skewed):
    text = plan(zscore_anomalies(skewed, keys=["user"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # the repartition of the fixture is the only exchange of rows
    assert text.count("Exchange hashpartitioning") == 0


@pytest.mark.parametrize("hot_share", [0.0, 0.01, 1.0])
def test_split_join_is_whole_for_any_share(skewed, setting, hot_share):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = skewed.withColumn("window_start", F.lit(START).cast("timestamp"))
    stats = rows.groupBy("window_start", "user").agg(
        F.count("*").alias(GROUP_ROWS), F.avg("Amount").alias("mean")
    ).checkpoint()
    joined = join_group_statistics(rows, stats, ["user"], broadcast_bytes=0, hot_share=hot_share)
    assert joined.columns == [*rows.columns, "mean"]
    whole = join_group_statistics(rows, stats, ["user"], broadcast_bytes=2**30)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert "SortMergeJoin" in plan(joined)


def test_broadcast_limit_follows_the_session(spark, setting):
    for text, limit in (("10MB", 128 * 2**20), ("1g", 2**30), ("-1", 0), ("300000000b", 300_000_000)):
        setting("spark.sql.autoBroadcastJoinThreshold", text)
        assert broadcast_limit(spark) == limit


def test_statistics_agree_with_the_scores(skewed):
    stats = {r.window_start: r for r in amount_statistics(skewed, label_col=None).collect()}
    for row in zscore_anomalies(skewed).select("window_start", "avg_amount", "stddev_amount").distinct().collect():
        assert math.isclose(stats[row.window_start].avg_amount, row.avg_amount)
        assert math.isclose(stats[row.window_start].stddev_amount, row.stddev_amount)


def test_quartiles_match_brute_force(skewed):
    groups = {}
    for r in skewed.collect():
        groups.setdefault((int(r.timestamp[14:16]) // 5, r.user), []).append(r.Amount)
    bounds = iqr_bounds(skewed, keys=["user"], accuracy=100_000).collect()
    assert len(bounds) == len(groups)
    for row in bounds:
        amounts = sorted(groups[row.window_start.minute // 5, row.user])
        q1, q3 = (amounts[math.ceil(p * len(amounts)) - 1] for p in (0.25, 0.75))
        assert (row.q1, row.q3) == (q1, q3)
        assert math.isclose(row.upper_bound, q3 + 1.5 * (q3 - q1))


def test_windows_before_the_epoch(transactions):
    rows = transactions([("1969-12-31T23:58:00", 1.0, 0), ("1969-12-31T23:54:00", 3.0, 0)])
    starts = sorted(str(r.window_start) for r in amount_statistics(rows).collect())
    assert starts == ["1969-12-31 23:50:00", "1969-12-31 23:55:00"]


@pytest.mark.parametrize("broadcast_bytes", [None, -1])
def test_empty_tables(transactions, broadcast_bytes):
    nothing = transactions([])
    options = {"keys": ["Class"], "broadcast_bytes": broadcast_bytes}
    assert zscore_anomalies(nothing, **options).count() == 0
    assert iqr_anomalies(nothing, **options).count() == 0
    assert iqr_bounds(nothing).count() == 0
