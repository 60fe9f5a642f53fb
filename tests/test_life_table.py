import numpy as np
from gaugeline.operators import kpi, rul
from helpers import series

SCHEMA = "unit_id int,timestamp_bin ts,RUL_minutes double,minutes_since_last_failure double"


def test_newest_rows_get_a_prediction(spark):
    rows = [(1, 0, 60.0, None), (1, 60, 0.0, 0.0), (1, 120, None, 60.0), (2, 0, None, None), (2, 60, None, None), (3, 0, 100.0, 1e6)]
    df = series(spark, rows, SCHEMA)
    predicted = rul.predict_life(df, rul.life_table(df))
    board = {r["unit_id"]: (r["predicted_minutes"], r["risk_band"]) for r in kpi.status_board(predicted).collect()}
    # Unknown age: one failure at 60, others censored at 60 and 0. Unit 1's age saw no failure, so it gets the mean of 60 and 100.
    assert board == {1: (80.0, "Critical"), 2: (60.0, "Critical"), 3: (100.0, "Critical")}
    assert [r["unit_id"] for r in kpi.worklist(predicted).collect()] == [2, 1, 3]


def test_an_empty_table_predicts_nothing(spark):
    df = series(spark, [(1, 0, None, None)], SCHEMA)
    assert rul.predict_life(df, rul.life_table(df)).first()["predicted_minutes"] is None


def test_censored_rows_lengthen_lives(spark):
    """Against the product-limit estimate written out, with ties of failures and censored rows."""
    rng = np.random.default_rng(8)
    rows, seen = [], []
    for unit in range(200):
        life, end = int(rng.integers(1, 30)) * 10, int(rng.integers(1, 30)) * 10
        known = life <= end
        rows += [(unit, 0, float(life) if known else None, 400.0), (unit, end, None, None)]  # the second row ends the unit's log
        seen.append((life if known else end, known))
    alive, want, last = 1.0, 0.0, 0
    for t in sorted({t for t, _ in seen}):
        want, last = want + alive * (t - last), t
        alive *= 1 - sum(k for x, k in seen if x == t) / sum(x >= t for x, _ in seen)
    table = {r["age"]: r["mean_minutes"] for r in rul.life_table(series(spark, rows, SCHEMA)).collect()}
    assert set(table) == {2} and abs(table[2] - want) < 1e-9
    assert want > np.mean([t for t, k in seen if k])
