from datetime import datetime

import pytest
from gaugeline.functions import timebins as tb
from gaugeline.functions.numeric import clip, edge_index_left, edge_index_right, equal_width_bin, finite
from gaugeline.schema import RUL_EDGES_LEFT, RUL_EDGES_RIGHT
from helpers import series, table
from pyspark.sql import functions as F


def test_bins_floor_before_1970_and_keep_null(spark):
    df = spark.createDataFrame(
        [(datetime(1969, 12, 31, 23, 58, 59),), (datetime(2024, 1, 1, 0, 3, 59, 999999),), (None,)], "ts timestamp_ntz"
    )
    out = [r[0] for r in df.select(tb.time_bin("ts", 2)).collect()]
    assert out == [datetime(1969, 12, 31, 23, 58), datetime(2024, 1, 1, 0, 2), None]


def test_bins_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 30),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(tb.time_bin("ts", 2), tb.hour_bucket("ts")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 2))


def test_unreadable_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:05",), ("xx",), (None,)], "timestamp string")
    out = [r[0] for r in tb.parse_time(df).collect()]
    assert out == [datetime(2024, 1, 1, 0, 0, 5), None, None]


def test_zoned_column_becomes_plain(spark):
    df = spark.sql("select timestamp'2024-01-01 01:02:03' as timestamp")
    assert tb.parse_time(df).first()[0] == datetime(2024, 1, 1, 1, 2, 3)


def test_day_chunk_is_never_null(spark):
    df = series(spark, [(None,), (0,), (1440,)], "ts ts")
    a, b, c = [r[0] for r in df.select(tb.day_chunk("ts")).collect()]
    assert a < b and c == b + 1


def test_time_of_day_skips_unusable_columns(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.warns(UserWarning):
        assert tb.add_time_of_day(df, "timestamp_bin").columns == ["x"]
    with pytest.warns(UserWarning):
        assert tb.add_time_of_day(df, "x").columns == ["x"]


def test_time_of_day_ignores_seconds(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 6, 0, 59),)], "timestamp_bin timestamp_ntz")
    row = tb.add_time_of_day(df).first()
    assert abs(row["tod_sin"] - 1) < 1e-12 and abs(row["tod_cos"]) < 1e-12


def test_edges(spark):
    values = [-1.0, 0.0, 4.9, 5.0, 10.0, 160.0, 9999.0, 10000.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    left = [r[0] for r in df.select(edge_index_left("x", RUL_EDGES_LEFT)).collect()]
    right = [r[0] for r in df.select(edge_index_right("x", RUL_EDGES_RIGHT)).collect()]
    assert left == [-1, 0, 0, 1, 2, 6, 6, 6, 7, None]
    assert right == [-1, -1, 0, 0, 1, 5, 6, 7, 7, None]


def test_finite_and_clip(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    out = table(df.select(finite("x"), clip(finite("x"), 0.0, 1.0)))
    assert out == [(None, None)] * 4 + [(2.0, 1.0)]


def test_equal_width_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (10.0,), (None,)], "x double")
    out = [r[0] for r in df.select(equal_width_bin("x", F.lit(0.0), F.lit(10.0), 10)).collect()]
    assert out == [0, 0, 1, 9, None]
    flat = [r[0] for r in df.select(equal_width_bin("x", F.lit(1.0), F.lit(1.0), 10)).collect()]
    assert flat == [5, 5, 5, 5, None]
