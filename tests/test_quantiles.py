import numpy as np
import pytest
from gaugeline.functions.quantiles import exact_percentiles, medians, percentile_arrays
from gaugeline.operators import eda
from pyspark.sql import functions as F


def frame(spark, seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        skewed = 0.0 if rng.random() < 0.35 else float(rng.lognormal(3, 2))
        rows.append((int(i % 3 == 0), skewed, float(rng.integers(0, 5)), None if rng.random() < 0.3 else float(rng.normal())))
    return rows, spark.createDataFrame(rows, "g int, a double, b double, c double")


@pytest.mark.parametrize("n", [1, 2, 7, 500, 4000])
def test_equals_linear_percentiles(spark, n):
    rows, df = frame(spark, n, n)
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    out = {(r["feature"], r["idx"]): r["value"] for r in exact_percentiles(df, ["a", "b", "c"], probs).collect()}
    for k, name in enumerate("abc", 1):
        values = [r[k] for r in rows if r[k] is not None]
        for i, p in enumerate(probs):
            if values:
                assert abs(out[(name, i)] - np.percentile(values, p * 100)) < 1e-9
            else:
                assert (name, i) not in out


def test_brackets_hold_on_large_sorted_and_tied_columns(spark):
    """Far more rows than the sketch keeps, in order, with ties and infinities, in many tasks."""
    n = 300_000
    df = spark.range(0, n, 1, 16).select(
        (F.col("id") * 1.0).alias("up"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) * 1.0).alias("tied"),
        F.when(F.col("id") < 5, F.lit(float("-inf"))).when(F.col("id") > n - 3, F.lit(float("inf"))).when(
            F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(9973)) / 700.0)).alias("wide"))
    pdf = df.toPandas()
    probs = [0.0, 0.0001, 0.25, 0.5, 0.9, 0.9999, 1.0]
    for r in exact_percentiles(df, ["up", "tied", "wide"], probs).collect():
        values = np.sort(pdf[r["feature"]].dropna().to_numpy())
        at = r["p"] * (len(values) - 1)
        low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
        want = low if low == high else low + (high - low) * (at - np.floor(at))
        assert r["n_values"] == len(values) and (r["value"] == want or abs(r["value"] - want) < 1e-9 * abs(want)), (r["feature"], r["p"])


def test_groups_and_points_that_depend_on_the_count(spark):
    rows, df = frame(spark, 3, 900)
    marks = lambda n: F.transform(F.sequence(F.lit(0), F.floor(F.sqrt(n)).cast("int")), lambda i: i / F.floor(F.sqrt(n)))
    for r in percentile_arrays(df, ["a"], marks, ["g"]).collect():
        values = [x[1] for x in rows if x[0] == r["g"]]
        q = int(len(values) ** 0.5)
        assert np.allclose(r["q"], np.percentile(values, np.arange(q + 1) / q * 100)) and r["n_values"] == len(values)


def test_medians_of_empty_columns_are_null(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None)], "a double, b double")
    assert tuple(medians(df, ["a", "b"]).first()) == (2.5, None)


def test_box_and_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    r = eda.box_stats(df, ["x"]).first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"]) == (2.25, 3.5, 4.75, 1, 5, 1)
    assert tuple(eda.missing_and_outliers(df, ["x"]).first()) == ("x", 1, 1)


@pytest.mark.parametrize("listwise", [False, True])
def test_correlations_equal_pandas(spark, listwise):
    rows, df = frame(spark, 5, 400)
    pdf = df.toPandas().assign(flat=7.1, near=lambda d: d["a"] * 2 + 1e6)
    df = df.selectExpr("*", "7.1D as flat", "a * 2 + 1e6 as near")
    expected = (pdf.dropna() if listwise else pdf).corr()
    got = {(r["a"], r["b"]): r["r"] for r in eda.correlations(df, listwise=listwise).collect()}
    assert len(got) == 21
    for (a, b), r in got.items():
        if "flat" in (a, b):
            assert r is None
        else:
            assert abs(r - expected.loc[a, b]) < 1e-9


def test_histogram_counts_every_value(spark):
    rows, df = frame(spark, 9, 300)
    out = eda.histogram(df, ["a", "c"], 10, ["g"]).collect()
    assert sum(r["n"] for r in out) == 300 + sum(r[3] is not None for r in rows)
    for g in (0, 1):
        values = [r[1] for r in rows if r[0] == g]
        expected = np.histogram(values, 10)[0]
        got = {r["bin"]: r["n"] for r in out if r["feature"] == "a" and r["g"] == g}
        assert [got.get(i, 0) for i in range(10)] == list(expected)
