"""Training a classifier and applying a fitted pipeline to every event."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamwatch.functions.values import all_of, finite
from streamwatch.schema import FEATURE_COLUMNS, require_columns

log = logging.getLogger(__name__)

TREES = 100
DEPTH = 20
SEED = 42

# What a pipeline adds to its input; only the prediction and probability are read.
MODEL_COLUMNS = ("__features", "__scaled", "rawPrediction", "probability", "prediction")


def train_classifier(
    df: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    label_col: str = "Class",
    *,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    spread_by: Sequence[str] = (),
    **forest_params,
) -> PipelineModel:
    """Standardise the features and fit a random forest, as one saved pipeline.

    Rows with an unknown label or feature are left out. ``forest_params`` go to
    ``RandomForestClassifier``, e.g. ``subsamplingRate`` on a very large table.

    Training passes over the rows once per tree level. With a unique key in
    ``spread_by`` they are spread evenly first: a table in few files then trains on
    all cores, and the forest does not depend on how the table is stored.
    """
    require_columns(df, [*features, label_col, *spread_by])
    inputs = (*features, label_col)
    known = df.select(*(finite(c).alias(c) for c in inputs), *_unlike(spread_by, inputs))
    known = known.dropna(subset=list(inputs))
    if spread_by:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        known = known.repartition(partitions, *spread_by).sortWithinPartitions(*spread_by)
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="__features", handleInvalid="keep"
    )
    scaler = StandardScaler(inputCol="__features", outputCol="__scaled", withMean=True)
    forest = RandomForestClassifier(
        featuresCol="__scaled",
        labelCol=label_col,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        **forest_params,
    )
    # scaling and preparing the forest read the rows several times before it has its own copy
    rows = known.select(*inputs).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assembler, scaler, forest]).fit(rows)
    finally:
        rows.unpersist()


def _unlike(names: Sequence[str], others: Sequence[str]) -> list[str]:
    return [name for name in names if name not in others]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().save(path)


def load_model(path: str, *, missing_ok: bool = False) -> PipelineModel | None:
    """A saved pipeline. A missing one raises, or gives ``None`` if that is fine."""
    try:
        return PipelineModel.load(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            log.warning("no model at %s", path)
            return None
        raise


def score_events(
    df: DataFrame,
    model: PipelineModel,
    features: Sequence[str] = FEATURE_COLUMNS,
    *,
    prediction_col: str = "is_fraud",
    probability_col: str = "fraud_probability",
) -> DataFrame:
    """Add the predicted label and the probability of the positive class.

    All input columns stay, so that the result can feed the drift reports. A row
    with an unknown feature stays too, with null predictions.
    """
    require_columns(df, features)
    known = all_of([finite(f).isNotNull() for f in features])
    scored = model.transform(df)
    probability = F.col("probability")
    if isinstance(scored.schema["probability"].dataType, VectorUDT):
        # null if the model knows one class only
        probability = F.get(vector_to_array("probability"), 1)
    added = [c for c in MODEL_COLUMNS if c not in df.columns]
    return scored.withColumns(
        {
            prediction_col: F.when(known, F.col("prediction").cast("double")),
            probability_col: F.when(known, probability),
        }
    ).drop(*(c for c in added if c not in (prediction_col, probability_col)))
