import pytest
from gaugeline.operators import bins, clean
from gaugeline.plans.hourly import hourly_fused, hourly_labelled
from helpers import minutes, series, table

SIGNALS = "timestamp ts,COMP int,MPG int,LPS int,Motor_current double,gpsLat double,gpsLong double"


def test_null_signal_is_no_failure(spark):
    df = series(spark, [(0, None, 0, 0, 1.0, 1.0, 1.0), (1, 0, 0, 0, 1.0, 1.0, 1.0)], SIGNALS)
    assert [r["failure_raw"] for r in clean.flag_failures(df).collect()] == [0, 1]


def test_missing_signal_column_warns_and_gives_zero(spark):
    df = series(spark, [(0, 0, 0, 0, 1.0, 1.0, 1.0)], SIGNALS).drop("LPS")
    with pytest.warns(UserWarning, match="LPS"):
        assert clean.flag_failures(df).first()["failure_raw"] == 0


def test_gps_filter_is_optional(spark):
    df = series(spark, [(0, 0, 0, 0, 1.0, None, 1.0), (1, 1, 0, 0, 1.0, 1.0, 1.0)], SIGNALS)
    assert clean.prepare_readings(df).count() == 1
    assert clean.prepare_readings(df, require_gps=False).count() == 2
    assert clean.prepare_readings(df.drop("gpsLat")).count() == 2


def test_required_timestamp(spark):
    with pytest.raises(ValueError, match="timestamp"):
        clean.prepare_readings(spark.createDataFrame([(1.0,)], "Motor_current double"))


def test_no_numeric_signal(spark):
    df = clean.flag_failures(series(spark, [(0, 0, 0, 0, 1.0, 1.0, 1.0)], SIGNALS)).drop("Motor_current")
    with pytest.raises(ValueError, match="numeric"):
        bins.bin_readings(df)


def test_bin_statistics(spark):
    rows = [(0, 0, 0, 0, 1.0, 1.0, 1.0), (1, 1, 0, 0, 3.0, 1.0, 1.0), (4, 1, 1, 1, 5.0, 1.0, 1.0)]
    out = bins.bin_readings(clean.prepare_readings(series(spark, rows, SIGNALS)))
    got = {minutes(r["timestamp_bin"]): r for r in out.collect()}
    assert set(got) == {0, 4}
    assert got[0]["Motor_current_avg"] == 2.0 and abs(got[0]["Motor_current_std"] - 2 ** 0.5) < 1e-12
    assert (got[0]["Motor_current_min"], got[0]["Motor_current_max"]) == (1.0, 3.0)
    assert (got[0]["failure"], got[0]["COMP_flag"], got[4]["failure"]) == (1, 1, 0)
    assert got[4]["Motor_current_std"] is None


def test_text_flags_do_not_fail(spark):
    df = series(spark, [(0, 0, 0, 0, 1.0, 1.0, 1.0)], SIGNALS).selectExpr("*", "'odd' as Towers")
    assert bins.bin_readings(clean.prepare_readings(df)).first()["Towers_flag"] is None


def test_hourly_keeps_all_nine_statistics(spark):
    rows = [(0, 0, 0, 0, 1.0, 41.111, -8.6), (30, 1, 1, 1, 4.0, 41.114, -8.6), (61, 1, 1, 1, 4.0, None, -8.6)]
    df = series(spark, rows, SIGNALS).selectExpr(
        "*", "1.0D as TP2", "2.0D as TP3", "3.0D as H1", "4.0D as DV_pressure", "5.0D as Oil_temperature"
    )
    out = bins.hourly_by_place(df)
    assert out.columns[3:] == [n for n, _, _ in bins.HOURLY_STATISTICS]
    row = out.collect()
    assert len(row) == 1 and row[0]["Motor_current_max"] == 4.0 and row[0]["lat_rounded"] == 41.11


def test_fused_labels_equal_joined_labels(spark):
    rows = [(m, m % 2, 0, 0, float(m), 41.1 + (m % 3) / 10, -8.6 if m % 5 else None) for m in range(0, 400, 7)]
    df = series(spark, rows, SIGNALS)
    keys = ["timestamp_hour", "lat_rounded", "lon_rounded"]
    assert table(hourly_labelled(df), *keys) == table(hourly_fused(df), *keys)


def test_rescale_and_melt(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "k int, a double, b double")
    assert table(clean.rescale(df, {"a": (10.0, 1.0)}).select("a")) == [(21.0,)]
    assert table(clean.melt(df, ["a", "b"], ["k"]), "feature") == [(1, "a", 2.0), (1, "b", None)]


def test_distinct_values_are_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (2,), (5,)], "v int")
    assert table(clean.distinct_values(df, "v", 3)) == [(1,), (2,), (3,)]
