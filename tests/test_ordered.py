"""Chunked windows must give exactly what one plain window over the series gives."""

import random

import pytest
from gaugeline.functions.timebins import day_chunk
from gaugeline.operators.features import time_range_rolling
from gaugeline.operators.ordered import running, with_halo
from helpers import same, series, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F


@st.composite
def a_series(draw):
    seed = draw(st.integers(0, 10_000))
    rng = random.Random(seed)
    rows = []
    for unit in ([None, 1, 2] if draw(st.booleans()) else [1]):
        minute = rng.randint(0, 5000)
        for _ in range(draw(st.integers(0, 60))):
            minute += rng.choice([2, 2, 2, 4, 30, 1440, 4000])
            rows.append((unit, minute, rng.choice([None, rng.random() * 100]), int(rng.random() < 0.15)))
    return rows


SCHEMA = "unit int,ts ts,v double,failure int"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=a_series(), block=st.integers(3, 9))
def test_running_and_halo_equal_plain_windows(spark, rows, block):
    df = series(spark, rows, SCHEMA)
    failing = F.when(F.col("failure") == 1, F.col("ts"))
    chunked = running(
        df, "ts", day_chunk("ts"), ["unit"], position="pos", total="n",
        sums={"fails": F.col("failure")}, last={"last": failing}, following={"next": failing},
    )
    frame = lambda w: [
        F.avg("v").over(w.rowsBetween(-3, -1)).alias("mean"), F.stddev("v").over(w.rowsBetween(-3, -1)).alias("std"),
        F.lag("v", 1).over(w).alias("lag"),
    ]
    chunked = with_halo(chunked, "pos", 3, frame, ["unit"], block)

    w = Window.partitionBy("unit").orderBy("ts")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    onward = w.rowsBetween(0, Window.unboundedFollowing)
    plain = df.select(
        "*", (F.row_number().over(w) - 1).cast("bigint").alias("pos"),
        F.count("*").over(Window.partitionBy("unit")).alias("n"), F.sum("failure").over(upto).alias("fails"),
        F.last(failing, ignorenulls=True).over(upto).alias("last"),
        F.first(failing, ignorenulls=True).over(onward).alias("next"), *frame(w),
    )
    same(table(chunked.select(*plain.columns), "unit", "ts"), table(plain, "unit", "ts"))


def test_null_time_is_the_first_row(spark):
    df = series(spark, [(1, None, 1.0, 1), (1, 0, 2.0, 0), (1, 3000, 3.0, 1)], SCHEMA)
    out = running(df, "ts", day_chunk("ts"), position="pos").orderBy("pos")
    assert [(r["pos"], r["v"]) for r in out.collect()] == [(0, 1.0), (1, 2.0), (2, 3.0)]


def test_halo_takes_any_frame(spark):
    from pyspark.sql import functions as F
    out = with_halo(spark.range(40), "id", 9, lambda w: [F.count("id").over(w.rowsBetween(-9, -1)).alias("n")], block_rows=4)
    assert {r["id"]: r["n"] for r in out.collect()} == {i: min(i, 9) for i in range(40)}


def test_positions_split_a_day_of_ties(spark):
    from gaugeline.operators.ordered import positions
    df = spark.range(5000).selectExpr("id % 7 as t", "id as u")
    placed, n = positions(df, ["t", "u"], "pos")
    got = [(r["t"], r["u"]) for r in placed.orderBy("pos").collect()]
    assert n == 5000 and got == sorted(got)


def test_time_range_frames_shrink_at_gaps(spark):
    rows = [(1, m, float(v), 0) for m, v in [(0, 1), (2, 2), (4, 4), (30, 8), (1439, 16), (1441, 32), (1500, 64)]]
    df = series(spark, rows, SCHEMA)
    out = time_range_rolling(df, ["v"], 30, ts="ts").orderBy("ts").collect()
    assert [r["v_range_mean"] for r in out] == [None, 1.0, 1.5, 7 / 3, None, 16.0, None]
    assert abs(out[3]["v_range_rms"] - ((1 + 4 + 16) / 3) ** 0.5) < 1e-12
    assert abs(out[3]["v_range_var"] - out[3]["v_range_std"] ** 2) < 1e-12
