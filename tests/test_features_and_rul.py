import numpy as np
import pytest
from gaugeline.operators import features, rul
from gaugeline.plans.etl import labelled_bins, rul_features
from helpers import minutes, same, series, table

BINS = "timestamp_bin ts,Motor_current_avg double,failure int"
READINGS = "timestamp ts,unit_id int,COMP int,MPG int,LPS int,Motor_current double"


def readings(spark, rows):
    """(minute, unit, failing, value)"""
    return series(spark, [(m, u, 0 if f else 1, 0, 0, v) for m, u, f, v in rows], READINGS)


def test_frame_rows():
    assert [features.frame_rows(*a) for a in [(30, 2), (30, 60), (30, 0), (2, 2)]] == [14, 1, 29, 1]


def test_row_frames_stretch_over_gaps_and_missing_is_zero(spark):
    out = rul_features(readings(spark, [(0, 1, 0, 1.0), (2, 1, 0, 3.0), (4, 1, 0, None), (30, 1, 0, 9.0)]), rows_back=2)
    rows = out.orderBy("timestamp_bin").collect()
    name = "Motor_current_avg"
    assert [r[f"{name}_roll_mean_30m"] for r in rows] == [0.0, 1.0, 2.0, 3.0]
    assert [r[f"{name}_lag1"] for r in rows] == [0.0, 1.0, 3.0, 0.0]
    assert [r[f"{name}_delta"] for r in rows] == [0.0, 2.0, 0.0, 0.0]
    assert rows[0][f"{name}_roll_std_30m"] == 0.0 and rows[0]["Motor_current_std"] is None


def test_feature_column_order_and_width(spark):
    signals = ("Motor_current Oil_temperature DV_pressure TP2 TP3 H1 Reservoirs Flowmeter Caudal_impulses gpsSpeed "
               "COMP MPG LPS Pressure_switch DV_eletric Towers Oil_level gpsQuality gpsLat gpsLong").split()
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "timestamp string").selectExpr(
        "timestamp", *[f"1 as {c}" for c in signals])
    out = rul_features(df)
    assert len(out.columns) == 66
    assert out.columns[0] == "timestamp_bin" and out.columns[-4:] == [
        "next_failure_time", "last_failure_time", "RUL_minutes", "minutes_since_last_failure"]


@pytest.mark.parametrize("parts", [[], ["unit_id"]])
def test_life_before_and_after_failures(spark, parts):
    rows = [(0, 1, 0, 1.0), (2, 1, 0, 1.0), (3000, 1, 1, 1.0), (3002, 1, 0, 1.0), (9000, 1, 0, 1.0)]
    out = labelled_bins(readings(spark, rows), parts=parts).orderBy("timestamp_bin").collect()
    assert [r["RUL_minutes"] for r in out] == [3000.0, 2998.0, 0.0, None, None]
    assert [r["minutes_since_last_failure"] for r in out] == [None, None, 0.0, 2.0, 6000.0]
    assert [minutes(r["last_failure_time"]) for r in out] == [None, None, 3000, 3000, 3000]


def test_no_failure_leaves_life_unknown(spark):
    out = labelled_bins(readings(spark, [(m, 1, 0, 1.0) for m in range(0, 10, 2)])).collect()
    assert all(r["RUL_minutes"] is None and r["minutes_since_last_failure"] is None for r in out)


def test_life_is_capped_but_not_invented(spark):
    rows = [(0, 1, 0, 1.0), (500, 1, 1, 1.0), (502, 1, 0, 1.0)]
    out = labelled_bins(readings(spark, rows), rul_cap=60).orderBy("timestamp_bin").collect()
    assert [r["RUL_minutes"] for r in out] == [60.0, 0.0, None]


def test_units_are_separate_series(spark):
    rows = [(0, 1, 0, 1.0), (10, 1, 1, 1.0), (0, 2, 0, 1.0), (20, 2, 1, 1.0), (30, None, 1, 1.0), (0, None, 0, 1.0)]
    out = labelled_bins(readings(spark, rows), parts=["unit_id"])
    life = {(r["unit_id"], minutes(r["timestamp_bin"])): r["RUL_minutes"] for r in out.collect()}
    assert life == {(1, 0): 10, (1, 10): 0, (2, 0): 20, (2, 20): 0, (None, 0): 30, (None, 30): 0}


def test_life_properties(spark):
    rng = np.random.default_rng(1)
    rows = [(int(m), 1, int(rng.random() < 0.05), 1.0) for m in np.cumsum(rng.integers(2, 90, 300))]
    for r in labelled_bins(readings(spark, rows)).collect():
        assert r["RUL_minutes"] is None or r["RUL_minutes"] >= 0
        assert (r["RUL_minutes"] == 0) == (r["failure"] == 1)


def test_rows_of_one_hour_share_their_next_failure(spark):
    rows = [(0, 1.0, 0), (0, 2.0, 1), (60, 1.0, 0), (180, 1.0, 1)]
    out = rul.add_rul_hours(series(spark, rows, "timestamp_hour ts,place double,failure int"))
    got = {(minutes(r["timestamp_hour"]), r["place"]): (minutes(r["next_failure_time"]), r["RUL_hours"])
           for r in out.collect()}
    assert got == {(0, 1.0): (0, 0.0), (0, 2.0): (0, 0.0), (60, 1.0): (180, 2.0), (180, 1.0): (180, 0.0)}


def test_episodes_run_across_days_and_blocks(spark):
    fails = {0: 1, 2: 1, 4: 0, 6: 1, 1438: 1, 1440: 1, 1442: 0, 5000: 1}
    df = series(spark, [(m, 1.0, f) for m, f in fails.items()], BINS)
    out = rul.failure_episodes(df, block_rows=2).orderBy("start_time").collect()
    assert [(r["episode"], minutes(r["start_time"]), minutes(r["end_time"]), r["bins"]) for r in out] == [
        (1, 0, 2, 2), (2, 6, 1440, 3), (3, 5000, 5000, 1)]


@pytest.mark.parametrize("n, expected", [(29, 0), (30, 0), (31, 1), (75, 45)])
def test_sequences_exclude_their_target(spark, n, expected):
    df = spark.range(n).selectExpr("id as pos", "cast(id as double) as a", "cast(-id as double) as b")
    out = features.sequence_windows(df, ["a", "b"], 30, block_rows=32).orderBy("pos").collect()
    assert len(out) == expected
    for r in out:
        assert r["sequence"] == [[float(i), float(-i)] for i in range(r["pos"] - 30, r["pos"])]


def test_latest_row_per_unit(spark):
    df = series(spark, [(1, 0, 1.0), (1, 4, 2.0), (2, 2, 3.0)], "unit int,ts ts,v double")
    assert table(rul.latest_rows(df, "unit", "ts").select("unit", "v"), "unit") == [(1, 2.0), (2, 3.0)]


def test_long_and_short_blocks_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(int(m), u, int(rng.random() < 0.1), float(rng.random())) for u in (1, 2, None)
            for m in np.cumsum(rng.integers(2, 900, 60))]
    df = readings(spark, rows)
    whole = rul_features(df, parts=["unit_id"])
    chunked = rul_features(df, parts=["unit_id"], block_rows=16)
    assert whole.columns == chunked.columns
    same(table(whole, "unit_id", "timestamp_bin"), table(chunked, "unit_id", "timestamp_bin"))
