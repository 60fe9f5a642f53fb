from gaugeline.session import new_path
from gaugeline.streaming import live
from helpers import minutes, series, table

READINGS = "timestamp ts,unit_id bigint,COMP int,MPG int,LPS int,Motor_current double"


def readings(spark, rows):
    return series(spark, [(m, u, 0 if f else 1, 0, 0, v) for m, u, f, v in rows], READINGS)


def add(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_bins_wait_for_the_watermark_and_drop_late_rows(spark):
    source, out, progress = (new_path(spark, f"test-{n}") for n in ("in", "bins", "progress"))
    first = readings(spark, [(0, 1, 0, 1.0), (1, 1, 1, 3.0), (2, 1, 0, 5.0), (30, 1, 0, 7.0)])
    add(first, source)
    run = lambda: live.run_to_table(live.live_bins(live.read_stream(spark, first, source)), out, progress)
    run()
    rows = lambda: {minutes(r["timestamp_bin"]): (r["Motor_current_avg"], r["failure"])
                    for r in spark.read.parquet(out).collect()}
    assert rows() == {0: (2.0, 1), 2: (5.0, 0)}
    # Minute 1 is behind the watermark now; minute 25 is not.
    add(readings(spark, [(1, 1, 0, 100.0), (25, 1, 0, 9.0), (60, 1, 0, 1.0)]), source)
    run()
    assert rows() == {0: (2.0, 1), 2: (5.0, 0), 24: (9.0, 0), 30: (7.0, 0)}


def test_state_carries_the_last_failure_over_restarts(spark):
    source, out, progress = (new_path(spark, f"test-{n}") for n in ("bins-in", "since", "since-progress"))
    schema = "unit_id bigint,timestamp_bin ts,failure int"
    first = series(spark, [(1, 0, 0), (1, 2, 1), (1, 4, 0), (2, 0, 0)], schema)
    add(first, source)
    run = lambda: live.run_to_table(live.live_since_failure(live.read_stream(spark, first, source)), out, progress)
    run()
    add(series(spark, [(1, 10, 0), (1, 12, 1), (2, 6, 1)], schema), source)
    run()
    got = {(r["unit_id"], minutes(r["timestamp_bin"])): r["minutes_since_last_failure"] for r in spark.read.parquet(out).collect()}
    assert got == {(1, 0): None, (1, 2): 0.0, (1, 4): 2.0, (2, 0): None, (1, 10): 8.0, (1, 12): 0.0, (2, 6): 0.0}


def test_state_never_falls(spark):
    source, out, progress = (new_path(spark, f"test-{n}") for n in ("late-in", "late", "late-progress"))
    schema = "unit_id string,timestamp_bin ts,failure int"
    batches = [[("a", 10, 1), ("a", 12, 0)], [("a", 5, 0), ("a", 4, 1)], [("a", 14, 0), ("a", 11, 0)]]
    for rows in batches:
        first = series(spark, rows, schema)
        add(first, source)
        live.run_to_table(live.live_since_failure(live.read_stream(spark, first, source)), out, progress)
    got = {minutes(r["timestamp_bin"]): r["minutes_since_last_failure"] for r in spark.read.parquet(out).collect()}
    assert got == {10: 0.0, 12: 2.0, 4: 0.0, 5: 1.0, 14: 4.0, 11: 1.0}


def test_drift_of_unchanged_data_is_zero(spark):
    rows = [(m, float(m % 10)) for m in range(0, 1000)]
    train = series(spark, rows, "timestamp_bin ts,x double")
    same = live.feature_drift(train, train, ["x"]).collect()
    assert sum(r["n"] for r in same) == 1000 and all(abs(r["psi"]) < 1e-9 and abs(r["mean_shift"]) < 1e-9 for r in same)
    moved = live.feature_drift(train.selectExpr("timestamp_bin", "x + 100 as x"), train, ["x"]).first()
    assert moved["psi"] > 1 and moved["mean_shift"] > 5


def test_scoring_a_replayed_batch_writes_once(spark):
    from gaugeline.operators import models

    source, out = new_path(spark, "test-score-in"), new_path(spark, "test-score-out")
    bins = series(spark, [(1, m, 0, float(m)) for m in range(0, 40, 2)], "unit_id bigint,timestamp_bin ts,failure int,Motor_current_avg double")
    add(bins, source)
    names = ["Motor_current_avg", "Motor_current_avg_lag1"]
    train = bins.selectExpr("Motor_current_avg", "Motor_current_avg - 2 as Motor_current_avg_lag1", "Motor_current_avg as RUL_minutes")
    model = models.fit(train, names, models.forest(numTrees=2, maxDepth=3))
    for attempt in ("a", "b"):
        live.score_bins(live.read_stream(spark, bins, source), model, names, out, new_path(spark, f"test-{attempt}"), {})
    assert table(spark.read.parquet(out).groupBy("unit_id").count()) == [(1, 20)]


def test_one_unit_holding_all_rows_waits_in_the_store(spark, monkeypatch):
    """Rows in falling order over many frames: each is measured against a failure that comes after it."""
    frames = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    source, out, progress = (new_path(spark, f"test-{n}") for n in ("one-in", "one", "one-progress"))
    schema = "unit_id bigint,timestamp_bin ts,failure int"
    rows = [(7, 2 * m, int(m % 37 == 5)) for m in reversed(range(700))]
    first = series(spark, rows, schema)
    add(first, source)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        live.run_to_table(live.live_since_failure(live.read_stream(spark, first, source)), out, progress)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", frames)
    got = {minutes(r["timestamp_bin"]): r["minutes_since_last_failure"] for r in spark.read.parquet(out).collect()}
    failed = [m for _, m, f in rows if f]
    assert got == {m: min((float(m - e) for e in failed if e <= m), default=None) for _, m, _ in rows}


def test_at_most_two_frames_are_held():
    """The processor asks for the next frame only after it has put the one before the last away."""
    import pandas as pd
    from gaugeline.streaming.keyed import SinceFailure

    class Value:
        now = None
        def get(self): return self.now
        def update(self, v): self.now = v

    class Rows:
        def __init__(self): self.rows = []
        def appendList(self, part): self.rows += part
        def get(self): return iter(list(self.rows))
        def clear(self): self.rows = []

    processor = SinceFailure()
    processor.last, processor.waiting = Value(), Rows()
    given = []

    def frames():
        for i in range(20):
            assert len(processor.waiting.rows) >= 10 * (i - 1)
            given.append(i)
            yield pd.DataFrame({"second": range(i * 10, i * 10 + 10), "failure": [1] + [0] * 9})

    out = pd.concat(list(processor.handleInputRows((1,), frames(), None)))
    assert len(out) == 200 and processor.waiting.rows == [] and processor.last.now == (190,)
    assert (out["minutes_since_last_failure"] * 60 == out["second"] % 10).all()


def test_newest_bins_come_back_for_units_with_fresh_rows_only(spark):
    from gaugeline.streaming import keyed

    source, out, progress = (new_path(spark, f"test-{n}") for n in ("tail-in", "tail", "tail-progress"))
    schema = "unit_id string,timestamp_bin ts,x double,n int,at ts"
    nan = float("nan")
    first = series(spark, [("a", 0, 1.5, 1, 3), ("a", 2, nan, None, None), ("a", 4, None, 3, 5), ("b", 0, 9.0, 4, 0), (None, 0, 0.1, 5, 1)], schema)
    add(first, source)
    run = lambda: live.run_to_table(keyed.with_newest(live.read_stream(spark, first, source), ["unit_id"], "timestamp_bin", 2), out, progress)
    run()
    add(series(spark, [("a", 6, 2.5, 7, 9), (None, 2, 0.2, 6, 2)], schema), source)
    run()
    got = sorted((str(r["unit_id"]), minutes(r["timestamp_bin"]), str(r["x"]), r["n"], minutes(r["at"]), r["_fresh"])
                 for r in spark.read.parquet(out).collect() if not r["_fresh"])
    assert got == [("None", 0.0, "0.1", 5, 1.0, False), ("a", 2.0, "nan", None, None, False), ("a", 4.0, "None", 3, 5.0, False)]
    assert spark.read.parquet(out).filter("_fresh").count() == 7
