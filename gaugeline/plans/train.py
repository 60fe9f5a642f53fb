"""Feature table to fitted models, metrics and artifacts.

    python -m gaugeline.plans.train --input features --output-dir outputs --add-time-of-day
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, models, prep
from ..schema import LEAKAGE_COLUMNS, TARGET
from ..session import build_session, stage
from ..sources import read_features, read_table, save_model, save_record, save_split, write_report


@dataclass
class TrainingSet:
    """Imputed rows (`pos`, `cut`, `split`, target, features), their feature names and fills."""

    rows: DataFrame
    features: list[str]
    fills: dict[str, float]
    cut: int

    @property
    def train(self) -> DataFrame:
        return self.rows.filter("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter("split = 'test'")


def training_set(
    table: DataFrame,
    target: str = TARGET,
    ts: str = "timestamp_bin",
    drop: Sequence[str] = LEAKAGE_COLUMNS,
    test_size: float = 0.2,
    rule: str = "round",
    time_of_day: bool = True,
    parts: Sequence[str] = (),
) -> TrainingSet:
    """Matrix, time-ordered split and imputation, written once since fitting reads it many times."""
    matrix, features = prep.feature_matrix(table, target, ts, drop, time_of_day=time_of_day, parts=parts)
    split = stage(prep.time_split(matrix, ts, test_size, rule, parts), "split")
    known = split.agg(F.max("cut").alias("cut")).crossJoin(prep.train_medians(split, features)).first().asDict()
    cut = int(known.pop("cut") or 0)
    rows = stage(prep.impute(split, features, known), "train")
    return TrainingSet(rows, features, known, cut)


def default_models(target: str = TARGET, fast: bool = True) -> dict[str, Any]:
    forest = models.FOREST_FAST if fast else models.FOREST
    boosted = models.BOOSTED_FAST if fast else models.BOOSTED
    return {
        "RandomForest": models.forest(target, **forest),
        "GradientBoosted": models.boosted(target, **boosted),
    }


def train(
    data: TrainingSet, regressors: Mapping[str, Any], target: str = TARGET,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """(fitted models, predictions on the test side)."""
    fitted = {name: models.fit(data.train, data.features, r) for name, r in regressors.items()}
    predictions = None
    for name, model in fitted.items():
        part = models.score(model, data.test, name, target=target)
        predictions = part if predictions is None else predictions.unionByName(part)
    return fitted, predictions


def save_artifacts(
    spark: SparkSession, data: TrainingSet, fitted: Mapping[str, PipelineModel], predictions: DataFrame, folder: str,
) -> None:
    """Everything evaluation needs: models, feature order, medians, cut, split; plus the reports."""
    for name, model in fitted.items():
        save_model(model, f"{folder}/models/{name}")
        write_report(models.importances(model, data.features, spark), folder, f"{name}_importances", stamped=False)
    save_record(spark, f"{folder}/feature_list", {"features": data.features})
    save_record(spark, f"{folder}/train_medians", data.fills)
    save_record(spark, f"{folder}/cut", {"cut": data.cut})
    save_split(data.rows, f"{folder}/split")
    write_report(evaluate.metrics(predictions), folder, "metrics", stamped=False)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train tree regressors on a feature table")
    parser.add_argument("--input", required=True)
    parser.add_argument("--target", default=TARGET)
    parser.add_argument("--timestamp-col", default="timestamp_bin")
    parser.add_argument("--drop-cols", nargs="*", default=LEAKAGE_COLUMNS)
    parser.add_argument("--test-size", type=float, default=0.2)
    parser.add_argument("--output-dir", default="outputs")
    parser.add_argument("--add-time-of-day", action="store_true")
    parser.add_argument("--unit-column", default=None, help="key of the unit, kept but never a feature")
    parser.add_argument("--full", action="store_true", help="the large model settings")
    args = parser.parse_args(argv)
    spark = build_session()
    table = read_table(spark, args.input) if args.input.lower().endswith(".csv") else read_features(spark, args.input)
    data = training_set(table, args.target, args.timestamp_col, args.drop_cols, args.test_size,
                        time_of_day=args.add_time_of_day, parts=[args.unit_column] if args.unit_column else [])
    fitted, predictions = train(data, default_models(args.target, fast=not args.full), args.target)
    predictions = stage(predictions, "predictions")
    save_artifacts(spark, data, fitted, predictions, args.output_dir)
    evaluate.metrics(predictions).show(truncate=False)


if __name__ == "__main__":
    main()
