import numpy as np
import pytest
from gaugeline.operators import prep
from gaugeline.operators.features import sequence_windows
from helpers import series, table
from pyspark.sql import functions as F

TABLE = "timestamp_bin ts,failure int,RUL_minutes double,a double,b double"


def rows_of(spark, n, gap=2):
    rng = np.random.default_rng(n)
    rows = [(i * gap, 0, float(n - i), float(rng.normal()), None if i % 4 == 1 else float(rng.normal())) for i in range(n)]
    return series(spark, rows[::-1], TABLE), rows


def test_matrix_keeps_labelled_rows_and_finite_features(spark):
    df = series(spark, [(0, 0, 1.0, float("nan"), 1.0), (2, 0, None, 1.0, 1.0), (4, 0, 3.0, float("inf"), 1.0)], TABLE)
    rows, names = prep.feature_matrix(df, time_of_day=False)
    assert names == ["a", "b"] and rows.count() == 2
    assert [r["a"] for r in rows.collect()] == [None, None]
    assert prep.feature_matrix(df)[1] == ["a", "b", "tod_sin", "tod_cos"]


def test_matrix_checks(spark):
    df, _ = rows_of(spark, 3)
    with pytest.raises(ValueError, match="RUL_minutes"):
        prep.feature_matrix(df.drop("RUL_minutes"))
    with pytest.raises(ValueError, match="no numeric feature"):
        prep.feature_matrix(df.drop("a", "b"), time_of_day=False)
    with pytest.raises(ValueError, match="zz"):
        prep.feature_matrix(df, features=["a", "zz"])


@pytest.mark.parametrize("n, share, rule, cut", [(6, 0.25, "round", 4), (10, 0.25, "round", 8), (11, 0.2, "ceil", 8), (10, 0.2, "round", 8)])
def test_cut_rules(spark, n, share, rule, cut):
    df, _ = rows_of(spark, n, gap=500)
    out = prep.time_split(df, test_size=share, rule=rule).orderBy("timestamp_bin").collect()
    assert [r["pos"] for r in out] == list(range(n)) and {r["cut"] for r in out} == {cut}
    assert [r["split"] for r in out] == ["train"] * cut + ["test"] * (n - cut)


def test_unknown_rule_and_bad_saved_cut(spark):
    df, _ = rows_of(spark, 5)
    with pytest.raises(ValueError, match="rule"):
        prep.cut_of(F.lit(5), rule="odd")
    for cut in (0, 6):
        with pytest.raises(ValueError, match="cut"):
            prep.split_at(df, cut)
    assert prep.split_at(df, 5).filter("split = 'test'").count() == 0


def test_fills_come_from_the_train_side(spark):
    df, rows = rows_of(spark, 40)
    split = prep.time_split(df)
    fills = prep.train_medians(split, ["a", "b"])
    train = [r for r in rows[:32]]
    assert abs(fills.first()["b"] - np.median([r[4] for r in train if r[4] is not None])) < 1e-12
    one, two = prep.impute(split, ["a", "b"], fills), prep.impute(split, ["a", "b"], fills.first().asDict())
    assert table(one, "pos") == table(two, "pos")
    assert one.filter("b is null").count() == 0
    assert prep.train_medians(split, ["a"], exact=False).first()["a"] is not None


def test_saved_fills_fall_back(spark):
    df, rows = rows_of(spark, 40)
    split = prep.time_split(df).withColumn("c", F.lit(None).cast("double"))
    fills = prep.saved_fills(split, ["a", "b", "c"], {"a": 7.0})
    assert fills["a"] == 7.0 and fills["c"] == 0.0
    assert abs(fills["b"] - np.median([r[4] for r in rows[:32] if r[4] is not None])) < 1e-12


@pytest.mark.parametrize("n, length", [(60, 30), (45, 7), (20, 30)])
def test_sequence_norms_equal_building_the_windows(spark, n, length):
    df, _ = rows_of(spark, n)
    split = prep.time_split(df)
    rows = prep.impute(split, ["a", "b"], {"a": 0.0, "b": 0.5})
    x = np.array([[r["a"], r["b"]] for r in rows.orderBy("pos").collect()])
    cut = rows.first()["cut"]
    windows = np.array([x[t - length:t] for t in range(length, n) if t < cut])
    got = prep.sequence_norms(rows, ["a", "b"], length).first()
    if len(windows) == 0:
        assert got["a__mean"] is None
        return
    assert np.allclose([got["a__mean"], got["b__mean"]], windows.mean(axis=(0, 1)))
    assert np.allclose([got["a__std"], got["b__std"]], windows.std(axis=(0, 1)))
    normed = prep.normalise(rows, ["a", "b"], prep.sequence_norms(rows, ["a", "b"], length))
    assert normed.count() == n


def test_constant_feature_gets_a_small_std(spark):
    df = spark.range(50).selectExpr("id as pos", "40L as cut", "3.0D as a")
    assert prep.sequence_norms(df, ["a"]).first()["a__std"] == 1e-6


def test_sequence_sides_and_validation_tail(spark):
    df, _ = rows_of(spark, 200)
    rows = prep.impute(prep.time_split(df), ["a", "b"], {"a": 0.0, "b": 0.0})
    sides = prep.validation_tail(prep.sequence_split(sequence_windows(rows, ["a", "b"])))
    counts = {r["split"]: r["count"] for r in sides.groupBy("split").count().collect()}
    assert counts == {"train": 117, "validation": 13, "test": 40}
    assert counts["test"] == rows.filter("split = 'test'").count()


def test_tiny_validation_leaves_train_whole(spark):
    df = spark.range(45).selectExpr("id as pos", "39L as cut", "case when id < 39 then 'train' else 'test' end as split")
    sides = prep.validation_tail(df.filter("pos >= 30"))
    assert {r["split"] for r in sides.collect()} == {"train", "test"}


def test_weights_per_range(spark):
    values = [0.0] * 70 + [7.0] * 20 + [2000.0] * 10 + [-5.0]
    df = spark.createDataFrame([(v,) for v in values], "RUL_minutes double")
    out = table(prep.bin_weights(df), "bin")
    raw = [101 / (7 * max(n, 1)) for n in (71, 20, 0, 0, 0, 0, 10)]
    assert [r[1] for r in out] == [71, 20, 0, 0, 0, 0, 10]
    assert np.allclose([r[2] for r in out], np.clip(raw, 0.3, 5.0))
    weighted = prep.add_sample_weight(df, prep.bin_weights(df))
    assert weighted.count() == 101 and weighted.filter("weight is null").count() == 0


def test_weighted_mse_divides_by_rows(spark):
    df = spark.createDataFrame([("m", 1.0, 3.0, 0.5), ("m", 2.0, 2.0, 9.0)], "model string, y_true double, y_pred double, weight double")
    assert prep.weighted_mse(df).first()["weighted_mse"] == 1.0


def test_folds_move_forward():
    assert prep.time_folds(90, 2) == [(30, 60), (60, 90)]
