"""Tree regressors on Spark ML: fit, score, importances, grids, time-ordered tuning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TARGET
from . import evaluate

SEED = 42
# The two published settings of each family. Spark trees go no deeper than 30.
FOREST = {"numTrees": 300, "maxDepth": 30}
FOREST_FAST = {"numTrees": 100, "maxDepth": 12}
BOOSTED = {"maxIter": 600, "stepSize": 0.05, "maxDepth": 6}
BOOSTED_FAST = {"maxIter": 200, "stepSize": 0.1, "maxDepth": 5}
BOOSTED_SAMPLING = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}


def forest(target: str = TARGET, **params: Any) -> RandomForestRegressor:
    """Random forest; every feature is tried at each split."""
    settings = {**FOREST_FAST, "featureSubsetStrategy": "all", "seed": SEED, **params}
    return RandomForestRegressor(featuresCol="features", labelCol=target, predictionCol="y_pred", **settings)


def boosted(target: str = TARGET, **params: Any) -> GBTRegressor:
    """Gradient-boosted trees on squared error with row and column sampling."""
    settings = {**BOOSTED_FAST, **BOOSTED_SAMPLING, "seed": SEED, **params}
    return GBTRegressor(featuresCol="features", labelCol=target, predictionCol="y_pred", **settings)


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def fit(train: DataFrame, features: Sequence[str], regressor) -> PipelineModel:
    """Fit on a train table; the pipeline carries the assembler, so it scores plain feature rows."""
    stage = assembler(features)
    return PipelineModel([stage, regressor.fit(stage.transform(train))])


def evenly(train: DataFrame) -> DataFrame:
    """A train table in as many equal parts as there are cores, if it has several parts at all.

    A forest waits at every level for its largest part, and each part sends its own statistics of every node, so
    neither uneven parts nor more of them than cores will do. A small table of one part stays as it is.
    """
    if train.rdd.getNumPartitions() == 1:
        return train
    return train.repartition(train.sparkSession.sparkContext.defaultParallelism)


def score(model: PipelineModel, rows: DataFrame, name: str, key: str = "pos", target: str = TARGET) -> DataFrame:
    """(model, key, y_true, y_pred) for every row."""
    return model.transform(rows).select(
        F.lit(name).alias("model"), F.col(key).alias("key"), F.col(target).alias("y_true"), "y_pred"
    )


def importances(model: PipelineModel, features: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """(feature, importance), greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values, strict=True)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered


def fit_with_validation(rows: DataFrame, features: Sequence[str], regressor: GBTRegressor) -> PipelineModel:
    """Boosting that stops when the `validation` rows no longer improve.

    `rows` holds the train and validation sides; test rows are ignored.
    """
    marked = rows.filter(F.col("split") != "test").withColumn("_validate", F.col("split") == "validation")
    return fit(marked, features, regressor.setValidationIndicatorCol("_validate"))


def run_grid(
    train: DataFrame, test: DataFrame, features: Sequence[str], grid: Mapping[str, Any],
) -> tuple[DataFrame, DataFrame, dict[str, PipelineModel]]:
    """(metrics by RMSE, predictions of all models, models) for named regressors."""
    models = {name: fit(train, features, regressor) for name, regressor in grid.items()}
    predictions = None
    for name, model in models.items():
        scored = score(model, test, name)
        predictions = scored if predictions is None else predictions.unionByName(scored)
    return evaluate.metrics(predictions, order_by="RMSE"), predictions, models


def tune_in_time(
    rows: DataFrame, features: Sequence[str], grid: Mapping[str, Any], folds: Sequence[tuple[int, int]],
) -> DataFrame:
    """(model, folds, RMSE): mean over expanding folds, each validated on the rows right after it."""
    scored = None
    for number, (end, until) in enumerate(folds):
        train = rows.filter(F.col("pos") < end)
        after = rows.filter((F.col("pos") >= end) & (F.col("pos") < until))
        for name, regressor in grid.items():
            part = score(fit(train, features, regressor), after, name).withColumn("fold", F.lit(number))
            scored = part if scored is None else scored.unionByName(part)
    per_fold = scored.groupBy("model", "fold").agg(
        F.sqrt(F.avg(F.pow(F.col("y_pred") - F.col("y_true"), 2))).alias("_rmse")
    )
    return per_fold.groupBy("model").agg(
        F.count(F.lit(1)).alias("folds"), F.avg("_rmse").alias("RMSE")
    ).orderBy("RMSE", "model")
