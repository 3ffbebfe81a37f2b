import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamwatch.operators.isolation_forest import (
    IsolationForestModel,
    fit_isolation_forest,
    usual_path,
)


@pytest.fixture(scope="module")
def points(spark):
    """A dense cloud and ten far points."""
    cloud = spark.range(2000, numPartitions=4).select(
        "id", F.randn(1).alias("Amount"), F.randn(2).alias("other")
    )
    far = spark.range(2000, 2010, numPartitions=1).select(
        "id", (F.lit(30.0) + F.col("id") % 7).alias("Amount"), F.lit(-25.0).alias("other")
    )
    return cloud.unionByName(far).checkpoint()


def brute_force(model, row):
    """The score of one row, walking every tree by its definition."""
    paths, usual = [], []
    for _, tree in model.nodes.groupby("tree"):
        nodes = tree.set_index("node")
        at = 0
        while nodes.feature[at] >= 0:
            value = row[model.features[nodes.feature[at]]]
            at = nodes.child[at] + int(value > nodes.split[at])
        paths.append(nodes.path[at])
        usual.append(usual_path(int(nodes["sample"].iloc[0])))
    return 2 ** (-np.mean(paths) / np.mean(usual))


@pytest.mark.parametrize("features", [("Amount",), ("Amount", "other")])
def test_scores_match_brute_force(points, features):
    model = fit_isolation_forest(points, features, trees=15, sample_size=64)
    rows = model.transform(points.filter("id % 50 = 0 OR id >= 2000")).collect()
    assert len(rows) == 50
    for row in rows:
        assert math.isclose(row.anomaly_score, brute_force(model, row), rel_tol=1e-12)


@pytest.mark.parametrize("features", [("Amount",), ("Amount", "other")])
def test_far_points_score_highest(points, features):
    model = fit_isolation_forest(points, features)
    top = model.transform(points).orderBy(F.desc("anomaly_score")).limit(10).collect()
    assert {r.id for r in top} == set(range(2000, 2010))


def test_the_threshold_flags_the_expected_share(points):
    model = fit_isolation_forest(points, ["Amount", "other"], contamination=0.05)
    flagged = model.transform(points).filter("is_anomaly").count()
    assert 0.04 * 2010 <= flagged <= 0.05 * 2010


def test_same_input_same_forest(points):
    options = {"trees": 10, "sample_size": 32}
    first = fit_isolation_forest(points, **options)
    second = fit_isolation_forest(points, **options)
    assert first.nodes.sort_values(["tree", "node"], ignore_index=True).equals(
        second.nodes.sort_values(["tree", "node"], ignore_index=True)
    )
    assert first.threshold == second.threshold


def test_another_seed_gives_another_forest(points):
    options = {"trees": 3, "sample_size": 32}
    assert not fit_isolation_forest(points, **options).nodes.equals(
        fit_isolation_forest(points, **options, seed=1).nodes
    )


def test_trees_hold_the_asked_sample(points):
    model = fit_isolation_forest(points, trees=20, sample_size=64)
    assert model.nodes.groupby("tree").ngroups == 20
    assert set(model.nodes["sample"]) == {64}
    assert model.nodes.groupby("tree").size().max() <= 2 * 64 - 1


def test_the_sample_is_drawn_from_a_pool_of_a_large_table(spark):
    rows = spark.range(50_000, numPartitions=8).select(F.randn(5).alias("Amount"))
    model = fit_isolation_forest(rows, trees=10, sample_size=64)
    assert set(model.nodes["sample"]) == {64}
    splits = model.nodes[model.nodes.feature >= 0].split
    assert -6 < splits.min() < -1 and 1 < splits.max() < 6


def test_copies_of_a_row_are_sampled_by_their_share(spark):
    """A third of the rows are the same; they fill about a third of the samples."""
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(10 + F.rand(5)).alias("Amount")
    )
    model = fit_isolation_forest(rows, trees=40, sample_size=64)
    assert set(model.nodes["sample"]) == {64}
    roots = model.nodes[model.nodes.node == 0]
    assert (roots.split < 11).all() and (roots.split < 10).sum() > 30


def test_unknown_amounts_neither_train_nor_score(spark, points):
    rows = points.select("id", "Amount").unionByName(
        spark.createDataFrame([(-1, None), (-2, float("nan"))], "id long, Amount double")
    )
    model = fit_isolation_forest(rows, trees=5, sample_size=32)
    unknown = model.transform(rows).filter("id < 0").collect()
    assert [(r.anomaly_score, r.is_anomaly) for r in unknown] == [(None, None)] * 2


def test_identical_rows(spark):
    rows = spark.range(100).select("id", F.lit(5.0).alias("Amount"))
    model = fit_isolation_forest(rows, trees=3, sample_size=16)
    assert model.transform(rows).filter("is_anomaly").count() == 0
    with pytest.raises(ValueError, match="two rows"):
        fit_isolation_forest(rows.limit(1))


def test_too_large_a_model_is_refused(points):
    with pytest.raises(ValueError, match="nodes"):
        fit_isolation_forest(points, trees=10_000, sample_size=100_000)


def test_saved_forest_scores_the_same(spark, points, tmp_path):
    model = fit_isolation_forest(points, ["Amount", "other"], trees=5, sample_size=32)
    model.save(spark, str(tmp_path / "forest"))
    loaded = IsolationForestModel.load(spark, str(tmp_path / "forest"))
    assert loaded.features == model.features and loaded.threshold == model.threshold
    assert model.transform(points).exceptAll(loaded.transform(points)).count() == 0


def test_usual_path():
    assert usual_path(1) == 0 and usual_path(2) == 1
    harmonic = sum(1 / i for i in range(1, 256))
    assert math.isclose(usual_path(256), 2 * harmonic - 2 * 255 / 256, rel_tol=1e-3)


def test_keyed_draws_do_not_hang_on_partitions(spark):
    rows = spark.range(30_000).select("id", (F.hash("id") % 1000).cast("double").alias("Amount"))
    forests = [fit_isolation_forest(rows.repartition(n), trees=20, draw_by=["id"]).nodes for n in (1, 5, 50)]
    assert forests[0].equals(forests[1]) and forests[0].equals(forests[2])
    other = fit_isolation_forest(rows, trees=20, draw_by=["id"], seed=7).nodes
    assert not forests[0].equals(other)


def test_draws_are_the_least_of_all(spark):
    """By brute force over the same draws."""
    from streamwatch.operators.isolation_forest import _least_draws

    rows = spark.range(3000).select(F.xxhash64("id").alias("__row"), F.col("id").cast("double").alias("x"))
    few, many = (_least_draws(rows.repartition(n), ["x"], 3, k, 1) for n, k in ((7, 20), (1, 3000)))
    assert few[0] == many[0] == 3000
    own = {tree: sorted((r.draw, r.x) for r in many[1].collect() if r.tree == tree) for tree in range(3)}
    assert all(len(rows) == 3000 for rows in own.values()) and own[0] != own[1]
    for tree in range(3):
        assert sorted((r.draw, r.x) for r in few[1].collect() if r.tree == tree) == own[tree][:20]
