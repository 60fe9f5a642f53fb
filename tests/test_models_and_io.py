from types import SimpleNamespace

import pytest
from gaugeline import session
from gaugeline.operators import kpi, models, prep
from gaugeline.plans import evaluate_saved, train as train_plan
from gaugeline.plans.etl import run_etl
from gaugeline.sources import (
    load_record, load_split, read_features, read_sensor_csv, read_table, save_record, save_split, write_features,
    write_report, write_table,
)
from helpers import series, table
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def feature_table(spark):
    """Life depends on `a`, so a fitted model must beat a constant."""
    rows = [(i * 2, 0, float(i * 37 % 100), float(i * 37 % 100) / 10, None if i % 9 == 0 else float(i % 5)) for i in range(300)]
    return series(spark, rows, "timestamp_bin ts,failure int,RUL_minutes double,a double,b double")


@pytest.fixture(scope="module")
def data(feature_table):
    return train_plan.training_set(feature_table)


def test_training_set(data):
    assert data.cut == 240 and data.train.count() == 240 and data.test.count() == 60
    assert data.rows.filter(" or ".join(f"{c} is null" for c in data.features)).count() == 0


def test_models_beat_a_constant_and_repeat(spark, data):
    grid = {"forest": models.forest(numTrees=5, maxDepth=5), "boosted": models.boosted(maxIter=5, maxDepth=3)}
    metrics, predictions, fitted = models.run_grid(data.train, data.test, data.features, grid)
    assert predictions.count() == 120
    assert all(r["R2"] > 0.5 for r in metrics.collect())
    again = models.fit(data.train, data.features, models.forest(numTrees=5, maxDepth=5))
    one = models.score(fitted["forest"], data.test, "x")
    assert table(one, "key") == table(models.score(again, data.test, "x"), "key")
    top = models.importances(again, data.features, spark, top=1).first()
    assert top["feature"] == "a"


def test_saved_models_give_the_same_metrics(spark, data, feature_table):
    grid = {"RandomForest": models.forest(numTrees=3, maxDepth=4), "GradientBoosted": models.boosted(maxIter=3, maxDepth=3)}
    fitted, predictions = train_plan.train(data, grid)
    folder = session.new_path(spark, "test-artifacts")
    train_plan.save_artifacts(spark, data, fitted, predictions, folder)
    from gaugeline.operators.evaluate import metrics
    saved = evaluate_saved.evaluate_saved(spark, feature_table, folder)
    assert [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in saved.collect()] == [
        tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in metrics(predictions).collect()]
    tables = evaluate_saved.report_tables(evaluate_saved.saved_predictions(spark, feature_table, folder, list(grid)))
    assert all(t.count() > 0 for t in tables.values())


def test_tuning_and_early_stopping(data):
    grid = {"shallow": models.forest(numTrees=2, maxDepth=1), "deep": models.forest(numTrees=2, maxDepth=6)}
    out = models.tune_in_time(data.train, data.features, grid, prep.time_folds(data.cut, 2)).collect()
    assert [r["model"] for r in out] == ["deep", "shallow"] and {r["folds"] for r in out} == {2}
    marked = prep.validation_tail(data.rows, length=0)
    model = models.fit_with_validation(marked, data.features, models.boosted(maxIter=5, maxDepth=3))
    assert models.score(model, data.test, "x").count() == 60


def test_records_split_and_report(spark, data):
    base = session.new_path(spark, "test-io")
    save_record(spark, f"{base}/cut", {"cut": 3, "names": ["é", "b"]})
    assert load_record(spark, f"{base}/cut") == {"cut": 3, "names": ["é", "b"]}
    save_split(data.rows, f"{base}/split")
    assert load_split(spark, f"{base}/split").count() == 300
    path = write_report(spark.createDataFrame([("m", 1.5)], "model string, MAE double"), base, "metrics")
    assert path != f"{base}/metrics" and spark.read.csv(path, header=True).first()["MAE"] == "1.5"


def test_csv_columns_decide_the_schema(spark):
    path = session.new_path(spark, "test-csv") + ".csv"
    spark.createDataFrame([("2024-01-01 00:00:00", "1.5", "0", "x"), ("bad", "", "1", "y")],
                          "timestamp string, TP2 string, COMP string, note string").write.csv(path, header=True)
    df = read_table(spark, path)
    assert dict(df.dtypes) == {"timestamp": "string", "TP2": "double", "COMP": "int", "note": "string"}
    assert df.filter("TP2 is null").count() == 1
    assert dict(read_sensor_csv(spark, path, infer=True).dtypes)["TP2"] == "double"


def test_features_by_day_prune_folders(spark, feature_table):
    path = session.new_path(spark, "test-days")
    df = series(spark, [(m, float(m)) for m in range(0, 4320, 100)], "timestamp_bin ts,x double")
    write_features(df, path)
    one = read_features(spark, path, "2024-01-02", "2024-01-02")
    assert table(one.agg(F.min("x"), F.max("x"))) == [(1500.0, 2800.0)]
    assert table(read_features(spark, path).select("x"), "x") == table(df.select("x"), "x")
    write_table(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_etl_job_keeps_bad_rows(spark):
    path = session.new_path(spark, "test-log") + ".csv"
    spark.createDataFrame([("2024-01-01 00:00:00", 1.0, 0, 0, 0), ("oops", 2.0, 1, 1, 1), ("2024-01-01 00:02:00", 3.0, 1, 1, 1)],
                          "timestamp string, Motor_current double, COMP int, MPG int, LPS int").write.csv(path, header=True)
    out = run_etl(spark, path, session.new_path(spark, "test-out")).orderBy("timestamp_bin").collect()
    assert [r["Motor_current_avg"] for r in out] == [2.0, 1.0, 3.0]
    assert out[0]["timestamp_bin"] is None and out[1]["RUL_minutes"] == 0.0


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_shared_dir_is_the_setting_or_below_the_warehouse():
    def bare(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    warehouse = {"spark.sql.warehouse.dir": "hdfs:/house"}
    assert session.shared_dir(bare(**warehouse)) == "hdfs:/house/_staged"
    assert session.shared_dir(bare(**warehouse, **{"spark.checkpoint.dir": "s3a://b/c/"})) == "s3a://b/c"


def test_risk_bands_and_actions(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 119.9, 120.0, 480.0, 481.0, 1440.0, 1441.0, None)], "RUL_minutes double")
    out = kpi.add_risk(df).collect()
    assert [r["risk_band"] for r in out] == ["Critical"] * 2 + ["High"] * 2 + ["Medium"] * 2 + ["Low", None]
    assert out[1]["action"] == "swap unit within 119 minutes" and out[-1]["action"] is None


def test_reliability_counts_runs_once(spark):
    rows = [(1, m * 60, f) for m, f in enumerate([0, 1, 1, 0, 1])] + [(2, 0, 0)]
    out = kpi.reliability(series(spark, rows, "unit_id int,timestamp_bin ts,failure int"), 60)
    assert table(out, "unit_id") == [(1, 5.0, 2, 2.5, 400.0), (2, 1.0, 0, None, 0.0)]


def test_worklist_and_history(spark):
    rows = [(1, 0, 50.0), (1, 2, 2000.0), (2, 0, 900.0), (2, 2, 300.0), (3, 2, 10.0)]
    df = series(spark, rows, "unit_id int,timestamp_bin ts,RUL_minutes double")
    work = kpi.worklist(df, rul="RUL_minutes")
    assert [r["unit_id"] for r in work.collect()] == [3, 2]
    assert kpi.unit_history(df, work).count() == 3
    kept = kpi.dashboard_filter(df, {"unit_id": [1, 2]}, "timestamp_bin", "2024-01-01 00:01:00", "2024-01-01 00:03:00")
    assert kept.count() == 2
    assert spark.range(1).select(kpi.savings(F.lit(3), 10.0, 5.0, 2.0)).first()[0] == 43.0
