import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from streamwatch.operators.scoring import load_model, save_model, score_events, train_classifier
from streamwatch.schema import FEATURE_COLUMNS

SMALL = {"trees": 5, "depth": 4}


@pytest.fixture(scope="module")
def training(spark):
    """The label follows from the sign of a and b together; a is on a large scale."""
    return spark.range(400, numPartitions=2).select(
        "id",
        (F.hash("id") % 1000).cast("double").alias("a"),
        ((F.hash("id", F.lit(1)) % 1000) / 1000).alias("b"),
        F.lit("2024-01-01T00:00:00").alias("timestamp"),
    ).withColumn("Class", ((F.col("a") > 0) & (F.col("b") > 0)).cast("int"))


@pytest.fixture(scope="module")
def model(training):
    return train_classifier(training, ["a", "b"], **SMALL)


def test_scores_are_better_than_chance_and_in_range(training, model):
    scored = score_events(training, model, ["a", "b"])
    hits = scored.filter(F.col("is_fraud") == F.col("Class")).count()
    assert hits > 0.9 * training.count()
    low, high = scored.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0 <= low < high <= 1


def test_all_columns_stay(training, model):
    """The reports on model quality need label, key and time of a scored event."""
    scored = score_events(training, model, ["a", "b"])
    assert scored.columns == [*training.columns, "is_fraud", "fraud_probability"]


def test_features_are_taken_by_name_and_scaled_alike(training, model):
    shuffled = training.select("b", "Class", "timestamp", "a", "id")
    want = {r.id: r.fraud_probability for r in score_events(training, model, ["a", "b"]).collect()}
    got = {r.id: r.fraud_probability for r in score_events(shuffled, model, ["b", "a"]).collect()}
    assert got == want


def test_unknown_feature_gives_null_and_keeps_the_row(spark, model):
    rows = spark.createDataFrame(
        [(1.0, None), (float("nan"), 1.0), (float("inf"), 1.0), (5.0, 0.5)], "a double, b double"
    )
    got = [(r.is_fraud is None, r.fraud_probability is None) for r in score_events(rows, model, ["a", "b"]).collect()]
    assert got == [(True, True)] * 3 + [(False, False)]


def test_one_class_only(training):
    zeros = training.withColumn("Class", F.lit(0))
    scored = score_events(zeros, train_classifier(zeros, ["a", "b"], **SMALL), ["a", "b"])
    assert scored.select("is_fraud", "fraud_probability").distinct().collect() == [(0.0, None)]


def test_training_needs_the_label(training):
    with pytest.raises(ValueError, match="Class"):
        train_classifier(training.drop("Class"), ["a", "b"], **SMALL)


def test_unknown_rows_do_not_train(training, model):
    dirty = training.unionByName(training.limit(50).withColumn("a", F.lit(None).cast("double")))
    again = train_classifier(dirty.coalesce(2), ["a", "b"], **SMALL)
    assert again.stages[1].mean.toArray().tolist() == pytest.approx(model.stages[1].mean.toArray().tolist())


def test_same_seed_same_scores(training, model):
    again = train_classifier(training, ["a", "b"], **SMALL)
    first = score_events(training, model, ["a", "b"])
    assert first.exceptAll(score_events(training, again, ["a", "b"])).count() == 0


def test_storage_does_not_matter_when_rows_are_spread_by_a_key(training):
    def scores(table):
        fitted = train_classifier(table, ["a", "b"], spread_by=["id"], **SMALL)
        return score_events(training, fitted, ["a", "b"]).select("id", "fraud_probability")

    first = scores(training.coalesce(1))
    assert first.exceptAll(scores(training.repartition(7).orderBy(F.rand(1)))).count() == 0


def test_saved_model_scores_the_same(training, model, tmp_path):
    save_model(model, str(tmp_path / "model"))
    loaded = load_model(str(tmp_path / "model"))
    assert isinstance(loaded, PipelineModel)
    first = score_events(training, model, ["a", "b"])
    assert first.exceptAll(score_events(training, loaded, ["a", "b"])).count() == 0


def test_missing_model(spark, tmp_path):
    with pytest.raises(Exception):
        load_model(str(tmp_path / "none"))
    assert load_model(str(tmp_path / "none"), missing_ok=True) is None


def test_no_python_runs_per_row(training, model):
    text = score_events(training, model, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in text and "Exchange" not in text


def test_default_features_cover_the_event(spark):
    rows = spark.range(40).select(
        *(F.randn(i).alias(n) for i, n in enumerate(FEATURE_COLUMNS)),
        (F.col("id") % 2).cast("int").alias("Class"),
    )
    assert score_events(rows, train_classifier(rows, **SMALL)).count() == 40
