"""Model queries return predictions, metrics and importances; smaller models than the queries' own keep this short."""

import os

import __spark_entry__ as contract
import numpy as np
import pytest
from gaugeline.operators import models

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


@pytest.fixture(autouse=True)
def small_models(monkeypatch):
    forest, boosted = models.forest, models.boosted
    monkeypatch.setattr(models, "forest", lambda **p: forest(**{**p, "numTrees": 5, "maxDepth": min(p.get("maxDepth", 6), 6)}))
    monkeypatch.setattr(models, "boosted", lambda **p: boosted(**{**p, "maxIter": 5}))


def result(spark, name):
    return contract.queries()[name](spark, SMALL).toPandas()


@pytest.mark.parametrize("name", ["rf_rul", "gbt_rul", "early_stopping", "sequence_gbt", "stream_scoring"])
def test_predictions_are_returned_and_vary(spark, name):
    out = result(spark, name)
    assert np.isfinite(out["y_pred"]).all() and out["y_pred"].nunique() > 1
    assert name not in contract.oracle_sql() and f"{name}_check" in contract.oracle_sql()


def test_metrics_equal_those_of_the_predictions(spark):
    rf = result(spark, "rf_rul")
    want = np.sqrt(((rf["y_pred"] - rf["y_true"])**2).mean()), (rf["y_pred"] - rf["y_true"]).abs().mean()
    for name, model in (("saved_model_eval", "RandomForest"), ("model_grid", "forest-100x12")):
        out = result(spark, name)
        out.columns = out.columns.str.lower()
        assert out["rmse"].is_monotonic_increasing
        row = out[out["model"] == model].iloc[0]
        assert np.allclose([row["rmse"], row["mae"]], want)


def test_tuning_and_importances(spark):
    tuned = result(spark, "tuned_in_time")
    assert set(tuned["model"]) == {"depth-8", "depth-12"} and (tuned["RMSE"] > 0).all()
    ranked = result(spark, "feature_importance")
    assert ranked["importance"].is_monotonic_decreasing and abs(ranked["importance"].sum() - 1) < 1e-9
    assert ranked["feature"].is_unique and len(ranked) > 15
