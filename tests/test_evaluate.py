import math

import numpy as np
import pandas as pd
import pytest
from gaugeline.operators import clean, eda
from gaugeline.operators import evaluate as ev
from helpers import table
from pyspark.sql import functions as F

PAIR = "model string, key bigint, y_true double, y_pred double"


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(11)
    t = np.round(rng.lognormal(3, 1.5, 700))
    t[:5] = [0, 5, 10, 160, 10000]
    return {"m": (t, t + rng.normal(0, 9, 700)), "k": (t[:90], np.full(90, 20.0))}


@pytest.fixture(scope="module")
def pairs(spark, arrays):
    rows = [(m, i * 3, float(a), float(b)) for m, (t, p) in arrays.items() for i, (a, b) in enumerate(zip(t, p))]
    rows += [("m", 9000, None, 1.0), ("m", 9001, 1.0, float("nan")), ("m", 9002, float("inf"), 1.0)]
    return spark.createDataFrame(rows, PAIR)


def test_metrics(pairs, arrays):
    out = {r["model"]: r for r in ev.metrics(pairs).collect()}
    for m, (t, p) in arrays.items():
        e, ae = p - t, np.abs(p - t)
        expected = {
            "MAE": ae.mean(), "RMSE": math.sqrt((e ** 2).mean()), "Bias": e.mean(),
            "R2": 1 - (e ** 2).sum() / ((t - t.mean()) ** 2).sum(),
            "sMAPE_pct": 100 * np.mean(2 * ae / (np.abs(t) + np.abs(p) + 1e-9)),
            "Pct_within_5min": 100 * np.mean(ae <= 5), "Pct_within_10min": 100 * np.mean(ae <= 10), "N": len(t),
        }
        for name, value in expected.items():
            assert abs(out[m][name] - value) < 1e-8, (m, name)
    rmse = [r["RMSE"] for r in ev.metrics(pairs).collect()]
    assert rmse == sorted(rmse)


def test_dropped_pairs_are_counted(pairs):
    assert table(ev.dropped_pairs(pairs), "model") == [("k", 0), ("m", 3)]


def test_constant_target(spark):
    df = spark.createDataFrame([("off", i, 2.0, 3.0) for i in range(4)] + [("exact", i, 2.0, 2.0) for i in range(4)], PAIR)
    assert {r["model"]: r["R2"] for r in ev.metrics(df).collect()} == {"off": 0.0, "exact": 1.0}
    assert ev.metrics(df, r2_eps=1e-12).filter("model = 'off'").first()["R2"] < -1e10


def test_rounded_table(pairs):
    row = ev.metrics(pairs, digits=3).filter("model = 'm'").first()
    assert row["MAE"] == round(row["MAE"], 3) and row["N"] == 700


def test_best_model(pairs):
    assert ev.best_model(ev.metrics(pairs)).first()["model"] == ev.metrics(pairs).first()["model"]


def test_tolerance_curve(pairs, arrays):
    for step in (1, 2):
        out = {(r["model"], r["tolerance"]): r["accuracy_pct"] for r in ev.tolerance_curve(pairs, step).collect()}
        assert len(out) == 2 * len(range(0, 61, step))
        for m, (t, p) in arrays.items():
            for tol in range(0, 61, step):
                assert abs(out[(m, tol)] - 100 * np.mean(np.abs(p - t) <= tol)) < 1e-9


@pytest.mark.parametrize("closed", ["left", "right"])
def test_mae_by_range(pairs, arrays, closed):
    last = 1e9 if closed == "left" else 9999
    edges = np.array([0, 5, 10, 20, 40, 80, 160, last])
    out = {(r["model"], r["bin"]): (r["mae"], r["n"]) for r in ev.mae_by_bin(pairs, closed).collect()}
    assert len(out) == 14
    for m, (t, p) in arrays.items():
        where = np.digitize(t, edges, right=closed == "right") - 1
        for b in range(7):
            inside = where == b
            assert out[(m, b)][1] == inside.sum()
            if inside.any():
                assert abs(out[(m, b)][0] - np.abs(p - t)[inside].mean()) < 1e-9
            else:
                assert out[(m, b)][0] is None


@pytest.mark.parametrize("points", [1, 2, 40, 400, 5000])
def test_even_sample_equals_linspace(pairs, arrays, points):
    out = {}
    for r in ev.even_sample(pairs, points).collect():
        out.setdefault(r["model"], set()).add(r["pos"])
    for m, (t, _) in arrays.items():
        n = len(t)
        assert out[m] == set(np.linspace(0, n - 1, min(n, points)).astype(int))


def test_calibration_curve_equals_quantile_cut(pairs, arrays):
    out = {}
    for r in ev.calibration_curve(pairs).orderBy("bin").collect():
        out.setdefault(r["model"], []).append((r["y_mean"], r["yp_mean"], r["n"]))
    for m, (t, p) in arrays.items():
        q = min(40, max(2, int(len(t) ** 0.5)))
        edges = np.unique(np.quantile(t, np.arange(q + 1) / q))
        where = np.maximum(np.searchsorted(edges, t, side="left"), 1)
        expected = [(t[where == b].mean(), p[where == b].mean(), (where == b).sum()) for b in np.unique(where)]
        assert np.allclose(out[m], expected)


def test_calibration_line(pairs, arrays):
    row = ev.calibration_fit(pairs).filter("model = 'm'").first()
    slope, intercept = np.polyfit(*arrays["m"], 1)
    assert abs(row["slope"] - slope) < 1e-9 and abs(row["intercept"] - intercept) < 1e-6


def test_axis_limits(pairs, arrays):
    out = {r["axis"]: (r["low"], r["high"]) for r in ev.axis_limits(pairs).collect()}
    truth = np.concatenate([t for t, _ in arrays.values()])
    lo, hi = np.percentile(truth, [1, 99])
    pad = 0.05 * (hi - lo + 1e-6)
    assert np.allclose(out["truth"], (lo - pad, hi + pad))


def test_error_histogram_keeps_all_errors(pairs):
    for clipped in (False, True):
        out = ev.error_histogram(pairs, 70, clipped).collect()
        assert sum(r["n"] for r in out) == 790 and max(r["bin"] for r in out) == 69


def test_slices_and_residuals(pairs):
    assert [r["key"] for r in ev.time_slice(pairs, 3).filter("model = 'k'").orderBy("key").collect()] == [0, 3, 6]
    assert ev.residual_sample(pairs, 50).count() == 100


def test_both_correlations_from_one_pass(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(300, 3))
    data[:, 1] += data[:, 0]
    data[rng.random((300, 3)) < 0.1] = np.nan
    frame = pd.DataFrame(data, columns=list("xyz"))
    found = {(r["rows"], r["a"], r["b"]): r["r"] for r in eda.correlation_tables(spark.createDataFrame(frame), list("xyz")).collect()}
    assert len(found) == 12
    for rule, rows in (("pairwise", frame), ("listwise", frame.dropna())):
        want = rows.corr()
        for i, a in enumerate("xyz"):
            for b in "xyz"[i:]:
                assert abs(found[rule, a, b] - want.loc[a, b]) < 1e-12


def test_complete_rows_of_many_computed_columns(spark):
    wide = spark.range(40).select("id", *[F.when(F.col("id") % (n + 2) != 0, F.col("id") / 2.0).alias(f"c{n}") for n in range(40)])
    kept = {r["id"] for r in clean.complete_rows(wide, [f"c{n}" for n in range(40)]).collect()}
    assert kept == {i for i in range(1, 40) if all(i % (n + 2) for n in range(40))}
