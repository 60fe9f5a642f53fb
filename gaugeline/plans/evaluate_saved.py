"""Saved models on the saved split, to a metrics table and report tables.

    python -m gaugeline.plans.evaluate_saved --data features --artifacts outputs --out reports
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import evaluate, models, prep
from ..schema import TARGET
from ..session import build_session, stage
from ..sources import load_model, load_record, read_features, write_report


def saved_predictions(
    spark: SparkSession, table: DataFrame, folder: str, names: Sequence[str], ts: str = "timestamp_bin",
) -> DataFrame:
    """Test-side predictions of the models in `folder`, on the matrix rebuilt from its artifacts."""
    features = load_record(spark, f"{folder}/feature_list")["features"]
    saved = load_record(spark, f"{folder}/train_medians")
    cut = int(load_record(spark, f"{folder}/cut")["cut"])
    matrix, _ = prep.feature_matrix(table, TARGET, ts, features=features)
    split = prep.split_at(stage(matrix, "matrix"), cut, ts)
    rows = prep.impute(split, features, prep.saved_fills(split, features, saved))
    test = rows.filter("split = 'test'")
    out = None
    for name in names:
        part = models.score(load_model(f"{folder}/models/{name}"), test, name)
        out = part if out is None else out.unionByName(part)
    return out


def evaluate_saved(
    spark: SparkSession, table: DataFrame, folder: str, names: Sequence[str] = ("RandomForest", "GradientBoosted"),
) -> DataFrame:
    """One metrics row per saved model, best RMSE first."""
    return evaluate.metrics(saved_predictions(spark, table, folder, names))


def report_tables(pairs: DataFrame) -> dict[str, DataFrame]:
    """The numbers under each comparison chart."""
    return {
        "metrics": evaluate.metrics(pairs),
        "pred_vs_actual": evaluate.even_sample(pairs, 400),
        "axis_limits": evaluate.axis_limits(pairs),
        "error_histogram": evaluate.error_histogram(pairs, 70),
        "acc_vs_tolerance": evaluate.tolerance_curve(pairs, step=2),
        "mae_by_bin": evaluate.mae_by_bin(pairs),
        "calibration": evaluate.calibration_curve(pairs),
        "residuals": evaluate.residual_sample(pairs, 500),
    }


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Evaluate saved models on the saved test split")
    parser.add_argument("--data", required=True)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--out", default="reports")
    parser.add_argument("--models", nargs="*", default=["RandomForest", "GradientBoosted"])
    args = parser.parse_args(argv)
    spark = build_session()
    pairs = stage(saved_predictions(spark, read_features(spark, args.data), args.artifacts, args.models), "pairs")
    for name, table in report_tables(pairs).items():
        print(write_report(table, args.out, name))
    evaluate.metrics(pairs).show(truncate=False)


if __name__ == "__main__":
    main()
