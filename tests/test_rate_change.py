import math

from gaugeline.operators import bins, kpi
from gaugeline.plans import hourly
from helpers import minutes, series
from pyspark.sql import functions as F


def test_ratio_and_limits(spark):
    rows = [(unit, 60 * n, int(n in fails)) for unit, fails in ((1, {3, 4, 30, 32, 34, 36}), (2, {1, 5}), (3, set())) for n in range(48)]
    df = series(spark, rows, "unit_id int,timestamp_bin ts,failure int")
    got = {r["unit_group"]: r for r in kpi.rate_change(df, 60, "2024-01-02", F.col("unit_id") % 2).collect()}
    one = got[1]  # units 1 and 3: one run before (two bins), four after, 48 hours on each side
    assert (one["failures_before"], one["failures_after"], one["hours_before"], one["hours_after"]) == (1, 4, 48.0, 48.0)
    reach = math.exp(1.959964 * math.sqrt(1 + 1 / 4))
    assert abs(one["rate_ratio"] - 4) < 1e-12 and abs(one["ratio_low"] - 4 / reach) < 1e-9 and abs(one["ratio_high"] - 4 * reach) < 1e-9
    assert got[0]["failures_after"] == 0 and got[0]["rate_ratio"] is None and got[0]["ratio_low"] is None


def test_hour_labels_come_from_one_scan(spark):
    rows = [(0, 1, 41.0, -8.0, 1.0), (1, 0, None, None, 5.0), (2, 1, 42.0, -8.0, 2.0), (61, 1, 41.0, -8.0, 3.0), (None, 0, 41.0, -8.0, 4.0),
            (62, 0, 41.0, None, 1.0), (130, 1, 41.0, -8.0, 1.0)]
    df = series(spark, [(m, f, 0, 0, a, o, v) for m, f, a, o, v in rows],
                "timestamp ts,COMP int,MPG int,LPS int,gpsLat double,gpsLong double,Motor_current double")
    table = hourly.hourly_failure(df)
    got = {(minutes(r["timestamp_hour"]), r["lat_rounded"]): (r["failure"], r["Motor_current_avg"]) for r in table.collect()}
    assert got == {(0, 41.0): (1, 1.0), (0, 42.0): (1, 2.0), (60, 41.0): (1, 3.0), (120, 41.0): (0, 1.0), (None, 41.0): (None, 4.0)}
    labels = bins.failures_by_hour(df).collect()
    assert {minutes(r["timestamp_hour"]): r["failure"] for r in labels} == {0: 1, 60: 1, 120: 0, None: 1}
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
