"""Registered queries: exploratory reports, training sets, models, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import edge_index_left
from ..functions.quantiles import medians
from ..operators import clean, eda, enrich, evaluate, models, prep
from ..plans.evaluate_saved import evaluate_saved
from ..plans.etl import rul_features
from ..plans.train import save_artifacts, train, training_set
from ..schema import LEAKAGE_COLUMNS, RUL_EDGES_LEFT, RUL_EDGES_RIGHT, RUL_LABELS
from ..session import new_path, stage
from ..sources import load_record, load_split, read_table, save_record, save_split, write_report
from ..sources.fixtures import sensor_view
from ..streaming import live
from .common import (
    FLAGS, HOURLY, HOURLY_COLUMNS, PAIRS, SENSOR, SIGNALS, bins_sql, features_sql, features_view,
    hourly_view, pairs_view, q6, r6, rolled_names, rounded, rul_sql, with_,
)

CATALOG: dict = {}


def entry(name: str, sql: str | None = None):
    def keep(f):
        CATALOG[name] = (f, sql)
        return f
    return keep


FEAT = with_(SENSOR, bins_sql(), rul_sql(), features_sql())
FEAT_BASE = ",".join([SENSOR, bins_sql(), rul_sql(), features_sql()])
HF = with_(SENSOR, HOURLY)
HF_BASE = ",".join([SENSOR, HOURLY])
STATS = [f"{c}_{s}" for c in SIGNALS for s in ("avg", "std", "min", "max")]
TREND = ["Motor_current_avg", "Oil_temp_avg", "DV_pressure_avg"]


def sql_unpivot(table: str, columns: list[str], keys: str = "") -> str:
    """(keys, feature, value) of the given columns, missing values left out."""
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, {c}::DOUBLE AS value FROM {table} WHERE {c} IS NOT NULL" for c in columns
    )


# ---- exploratory reports -----------------------------------------------------

@entry("signal_value_counts", with_(SENSOR) + " UNION ALL ".join(
    f"SELECT '{c}' AS signal, {c} AS value, count(*) AS n FROM sensor GROUP BY {c}" for c in FLAGS))
def signal_value_counts(spark, sf_dir):
    return eda.signal_value_counts(sensor_view(spark, sf_dir))


@entry("class_balance", with_(SENSOR) + "SELECT failure_raw AS failure, count(*) AS n FROM flagged GROUP BY 1")
def class_balance(spark, sf_dir):
    return eda.class_balance(clean.flag_failures(sensor_view(spark, sf_dir), "failure"))


@entry("summary_stats", HF + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, {q6(f'avg({c})')} AS mean, {q6(f'stddev_samp({c})')} AS stddev, "
    f"min({c}) AS min, max({c}) AS max FROM hf" for c in HOURLY_COLUMNS))
def summary_stats(spark, sf_dir):
    table = eda.summary_stats(hourly_view(spark, sf_dir), HOURLY_COLUMNS)
    return table.withColumn("mean", r6("mean")).withColumn("stddev", r6("stddev"))


@entry("summary_export", HF + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, {q6(f'avg({c})')} AS mean, {q6(f'stddev_samp({c})')} AS stddev, "
    f"min({c}) AS min, max({c}) AS max FROM hf" for c in HOURLY_COLUMNS))
def summary_export(spark, sf_dir):
    """The whole summary written as CSV for dashboards and read back with its types."""
    table = eda.summary_stats(hourly_view(spark, sf_dir), HOURLY_COLUMNS)
    path = write_report(table, new_path(spark, "summary"), "summary")
    back = spark.read.schema(table.schema).csv(path, header=True)
    return back.withColumn("mean", r6("mean")).withColumn("stddev", r6("stddev"))


@entry("missingness", FEAT + " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing,
  count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS outliers
FROM feat, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM feat)""" for c in STATS))
def missingness(spark, sf_dir):
    return eda.missing_and_outliers(features_view(spark, sf_dir), STATS)


@entry("table_profile", FEAT + "SELECT 'features' AS name, count(*) AS row_count, 33 - 1 + 1 - 0 AS column_count FROM feat"
       .replace("33 - 1 + 1 - 0", str(2 + len(STATS) + len(FLAGS) + len(rolled_names()) + 4)))
def table_profile(spark, sf_dir):
    return eda.table_profile(rul_features(sensor_view(spark, sf_dir)), "features")


@entry("zscores", HF + "SELECT timestamp_hour, lat_rounded, lon_rounded, " + ", ".join(
    q6(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()") + f" AS {c}_norm" for c in TREND) + " FROM hf")
def zscores(spark, sf_dir):
    keys = ["timestamp_hour", "lat_rounded", "lon_rounded"]
    table = eda.zscores(hourly_view(spark, sf_dir), TREND)
    return rounded(table.select(*keys, *[f"{c}_norm" for c in TREND]))


@entry("failure_window_trend", "WITH " + HF_BASE + ", " + f"""
times AS (SELECT DISTINCT timestamp_hour AS failure_time FROM hf WHERE failure = 1),
normed AS (SELECT *, {', '.join(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}_norm' for c in TREND)} FROM hf)
SELECT failure_time, timestamp_hour, {', '.join(q6(f'avg({c}_norm)') + f' AS {c}_norm' for c in TREND)}
FROM normed JOIN times ON timestamp_hour BETWEEN failure_time - INTERVAL 12 hours AND failure_time + INTERVAL 12 hours
GROUP BY 1, 2""")
def failure_window_trend(spark, sf_dir):
    return rounded(eda.failure_window_trend(hourly_view(spark, sf_dir)))


_AGG = ", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in TREND)
_AGG_COLUMNS = [f"{c}_{s}" for c in TREND for s in ("mean", "std")]


@entry("prefailure_trend", "WITH " + HF_BASE + f""",
aligned AS (
  SELECT p.*, epoch(p.timestamp_hour - e.timestamp_hour) / 3600.0 AS hours_to_failure
  FROM hf p JOIN (SELECT timestamp_hour FROM hf WHERE failure = 1) e
    ON p.timestamp_hour BETWEEN e.timestamp_hour - INTERVAL 12 hours AND e.timestamp_hour
),
agg AS (SELECT hours_to_failure, {_AGG} FROM aligned GROUP BY 1)
SELECT {q6('hours_to_failure')} AS hours_to_failure, {', '.join(f'{q6(c)} AS {c}' for c in _AGG_COLUMNS)},
  {', '.join(q6(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()') + f' AS {c}_norm' for c in _AGG_COLUMNS)}
FROM agg""")
def prefailure_trend(spark, sf_dir):
    return rounded(eda.pre_failure_trend(hourly_view(spark, sf_dir)))


@entry("prefailure_rows", "WITH " + HF_BASE + f"""
SELECT p.timestamp_hour, p.lat_rounded, p.lon_rounded, e.timestamp_hour AS failure_time, e.failing_places,
       {q6('epoch(p.timestamp_hour - e.timestamp_hour) / 3600.0')} AS hours_to_failure
FROM hf p JOIN (SELECT timestamp_hour, count(*) AS failing_places FROM hf WHERE failure = 1 GROUP BY 1) e
  ON p.timestamp_hour BETWEEN e.timestamp_hour - INTERVAL 12 hours AND e.timestamp_hour""")
def prefailure_rows(spark, sf_dir):
    rows = eda.pre_failure_rows(hourly_view(spark, sf_dir))
    return rounded(rows.select(
        "timestamp_hour", "lat_rounded", "lon_rounded", "failure_time", "failing_places", "hours_to_failure"))


NUMERIC = [*STATS, *[f"{c}_flag" for c in FLAGS], "failure", *rolled_names(),
           "RUL_minutes", "minutes_since_last_failure"]
PAIRWISE = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]


def corr_sql(table: str) -> str:
    r = ", ".join(f"corr({a}::DOUBLE, {b}::DOUBLE) AS r{i}" for i, (a, b) in enumerate(PAIRWISE))
    rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': r{i}}}" for i, (a, b) in enumerate(PAIRWISE))
    return f"""SELECT s.a AS a, s.b AS b, {q6("CASE WHEN isfinite(s.r) THEN s.r END")} AS r
FROM (SELECT unnest([{rows}]) AS s FROM (SELECT {r} FROM {table}))"""


@entry("correlation_pairwise", FEAT + corr_sql("feat"))
def correlation_pairwise(spark, sf_dir):
    return rounded(eda.correlations(features_view(spark, sf_dir)))


@entry("correlation_listwise", "WITH " + FEAT_BASE + ", full_rows AS (SELECT * FROM feat WHERE "
       + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC) + ")\n" + corr_sql("full_rows"))
def correlation_listwise(spark, sf_dir):
    return rounded(eda.correlations(features_view(spark, sf_dir), listwise=True))


def histogram_sql(long: str, bins: int, key: str = "") -> str:
    k = f"{key}, " if key else ""
    using = f"USING ({k}feature)"
    return f"""
SELECT {k}feature, bin, {q6(f'lo + bin * ((hi - lo) / {bins}e0)')} AS low,
       {q6(f'lo + (bin + 1) * ((hi - lo) / {bins}e0)')} AS high, n
FROM (
  SELECT {k}feature, lo, hi, CASE WHEN hi > lo
      THEN least(greatest(floor((value - lo) / nullif((hi - lo) / {bins}e0, 0)), 0), {bins - 1})::INTEGER
      ELSE {bins // 2} END AS bin, count(*) AS n
  FROM ({long}) JOIN (SELECT {k}feature, min(value) AS lo, max(value) AS hi FROM ({long}) GROUP BY ALL) {using}
  GROUP BY ALL
)"""


@entry("histogram_by_class", HF + histogram_sql(sql_unpivot("hf", TREND, "failure"), 50, "failure"))
def histogram_by_class(spark, sf_dir):
    return rounded(eda.histogram(hourly_view(spark, sf_dir), TREND, 50, ["failure"]))


@entry("histogram_columns", FEAT + histogram_sql(sql_unpivot("feat", NUMERIC), 40))
def histogram_columns(spark, sf_dir):
    return rounded(eda.histogram(features_view(spark, sf_dir), NUMERIC, 40))


def box_sql(long: str, key: str = "") -> str:
    k = f"{key}, " if key else ""
    return f"""
SELECT {k}feature, {q6('q1')} AS q1, {q6('median')} AS median, {q6('q3')} AS q3,
  {q6('least(min(value) FILTER (WHERE value >= q1 - (q3 - q1) * 1.5e0), q1)')} AS whisker_low,
  {q6('greatest(max(value) FILTER (WHERE value <= q3 + (q3 - q1) * 1.5e0), q3)')} AS whisker_high,
  count(*) FILTER (WHERE value < q1 - (q3 - q1) * 1.5e0 OR value > q3 + (q3 - q1) * 1.5e0) AS outliers,
  {q6('avg(value)')} AS mean, count(*) AS n
FROM ({long}) JOIN (
  SELECT {k}feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3 FROM ({long}) GROUP BY ALL
) USING ({k}feature)
GROUP BY {k}feature, q1, median, q3"""


@entry("box_stats_by_class", HF + box_sql(sql_unpivot("hf", TREND, "failure"), "failure"))
def box_stats_by_class(spark, sf_dir):
    return rounded(eda.box_stats(hourly_view(spark, sf_dir), TREND, ["failure"]))


KEY_SENSORS = ["Motor_current_avg", "Oil_temperature_avg", "DV_pressure_avg"]


@entry("box_stats", FEAT + box_sql(sql_unpivot("feat", KEY_SENSORS)))
def box_stats(spark, sf_dir):
    return rounded(eda.box_stats(features_view(spark, sf_dir), KEY_SENSORS))


# ---- training sets -----------------------------------------------------------

FEATURES = [c for c in NUMERIC if c not in LEAKAGE_COLUMNS] + ["tod_sin", "tod_cos"]
_ANGLE = "2 * pi() * (hour(timestamp_bin) * 60 + minute(timestamp_bin)) / 1440.0"


def prepared_sql(features: list[str], rule: str = "round") -> str:
    """CTEs `split` (with NULLs) and `filled` (medians of the train side in place)."""
    cut = "round_even(n * (1.0::DOUBLE - 0.2::DOUBLE), 0)::BIGINT" if rule == "round" else \
        "n - ceil(n * 0.2::DOUBLE)::BIGINT"
    fill = ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM split WHERE split = 'train')) AS {c}"
                     for c in features)
    return f"""{FEAT_BASE},
matrix AS (
  SELECT *, {q6(f'sin({_ANGLE})')} AS tod_sin, {q6(f'cos({_ANGLE})')} AS tod_cos,
         row_number() OVER (ORDER BY timestamp_bin) - 1 AS pos, count(*) OVER () AS n
  FROM feat WHERE RUL_minutes IS NOT NULL
),
split AS (
  SELECT * EXCLUDE (n), {cut} AS cut, CASE WHEN pos < {cut} THEN 'train' ELSE 'test' END AS split FROM matrix
),
filled AS (SELECT timestamp_bin, RUL_minutes, pos, cut, split, {fill} FROM split)"""


def _split(spark, sf_dir, rule="round"):
    matrix, names = prep.feature_matrix(features_view(spark, sf_dir, staged=False))
    matrix = matrix.withColumn("tod_sin", r6("tod_sin")).withColumn("tod_cos", r6("tod_cos"))
    return prep.time_split(matrix, rule=rule), names


def _filled(spark, sf_dir, names=None):
    split, every = _split(spark, sf_dir)
    names = names or every
    rows = stage(split.select("timestamp_bin", "RUL_minutes", "pos", "cut", "split", *names), "split")
    return prep.impute(rows, names, prep.train_medians(rows, names).first().asDict()), names


@entry("split_positions", "WITH " + prepared_sql(["Motor_current_std"])
       + "\nSELECT timestamp_bin, pos, cut, split FROM split")
def split_positions(spark, sf_dir):
    return _split(spark, sf_dir)[0].select("timestamp_bin", "pos", "cut", "split")


@entry("split_positions_ceil", "WITH " + prepared_sql(["Motor_current_std"], "ceil")
       + "\nSELECT timestamp_bin, pos, cut, split FROM split")
def split_positions_ceil(spark, sf_dir):
    return _split(spark, sf_dir, "ceil")[0].select("timestamp_bin", "pos", "cut", "split")


@entry("train_medians", "WITH " + prepared_sql(["Motor_current_std"]) + "\nSELECT " + ", ".join(
    q6(f"quantile_cont({c}::DOUBLE, 0.5)") + f" AS {c}" for c in FEATURES) + " FROM split WHERE split = 'train'")
def train_medians(spark, sf_dir):
    split, names = _split(spark, sf_dir)
    return rounded(prep.train_medians(stage(split, "split"), names))


@entry("median_impute", "WITH " + prepared_sql(FEATURES) + "\nSELECT pos, split, "
       + ", ".join(f"{q6(c)} AS {c}" for c in FEATURES) + " FROM filled")
def median_impute(spark, sf_dir):
    rows, names = _filled(spark, sf_dir)
    return rounded(rows.select("pos", "split", *names))


@entry("saved_split", "WITH " + prepared_sql(["Motor_current_std"])
       + f"\nSELECT timestamp_bin, pos, cut, split, {q6('RUL_minutes')} AS RUL_minutes FROM split")
def saved_split(spark, sf_dir):
    """Cut and positions saved, loaded, and applied again: every row's place and side."""
    split = stage(_split(spark, sf_dir)[0], "split")
    folder = new_path(spark, "artifacts")
    save_record(spark, f"{folder}/cut", {"cut": split.agg(F.max("cut").alias("cut")).first()["cut"]})
    save_split(split, f"{folder}/split")
    cut = load_record(spark, f"{folder}/cut")["cut"]
    again = prep.split_at(split.drop("pos", "cut", "split"), cut)
    both = again.drop("cut").join(load_split(spark, f"{folder}/split").select("pos", "split"), ["pos", "split"])
    return rounded(both.select("timestamp_bin", "pos", F.lit(cut).cast("bigint").alias("cut"), "split", "RUL_minutes"))


SAVED_MEDIANS = {"Motor_current_avg": 12.5, "Oil_temperature_max": -3.0}


@entry("saved_fills", "WITH " + prepared_sql(["Motor_current_std"]) + "\nSELECT " + ", ".join(
    f"{SAVED_MEDIANS[c]!r}::DOUBLE AS {c}" if c in SAVED_MEDIANS
    else f"coalesce({q6(f'quantile_cont({c}::DOUBLE, 0.5)')}, 0e0) AS {c}" for c in FEATURES)
       + " FROM split WHERE split = 'train'")
def saved_fills(spark, sf_dir):
    """Saved medians of two features, completed from the train rows for those the record lacks."""
    path = f"{new_path(spark, 'artifacts')}/medians"
    save_record(spark, path, SAVED_MEDIANS)
    split, names = _split(spark, sf_dir)
    fills = prep.saved_fills(stage(split, "split"), names, load_record(spark, path))
    return rounded(spark.createDataFrame([tuple(float(fills[c]) for c in names)], ", ".join(f"{c} double" for c in names)))


WINDOW = "OVER (ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
SEQ = prepared_sql(KEY_SENSORS)


@entry("sequence_windows", "WITH " + SEQ + f"""
SELECT pos, RUL_minutes, 30 AS steps, {q6('s')} AS total, {q6('f')} AS first_motor, {q6('l')} AS last_motor FROM (
  SELECT pos, RUL_minutes,
    sum({' + '.join(KEY_SENSORS)}) {WINDOW} AS s,
    first_value(Motor_current_avg) {WINDOW} AS f, last_value(Motor_current_avg) {WINDOW} AS l FROM filled
) WHERE pos >= 30""")
def sequence_windows(spark, sf_dir):
    from ..operators.features import sequence_windows as windows

    rows, names = _filled(spark, sf_dir, KEY_SENSORS)
    sequences = windows(rows, names)
    total = F.aggregate(F.flatten("sequence"), F.lit(0.0), lambda a, x: a + x)
    return rounded(sequences.select(
        "pos", "RUL_minutes", F.size("sequence").alias("steps"), total.alias("total"),
        F.col("sequence")[0][0].alias("first_motor"), F.col("sequence")[29][0].alias("last_motor"),
    ))


@entry("sequence_split", "WITH " + SEQ + """
SELECT side AS split, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos FROM (
  SELECT pos, CASE WHEN pos >= cut THEN 'test'
    WHEN pos >= cut - floor(greatest(cut - 30, 0) * 0.1::DOUBLE) THEN 'validation' ELSE 'train' END AS side
  FROM filled WHERE pos >= 30) GROUP BY 1""")
def sequence_split(spark, sf_dir):
    from ..operators.features import sequence_windows as windows

    rows, names = _filled(spark, sf_dir, KEY_SENSORS)
    sides = prep.validation_tail(prep.sequence_split(windows(rows, names)))
    return sides.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"),
                                      F.max("pos").alias("last_pos"))


_CELLS = "cells AS (SELECT r.* FROM filled t JOIN filled r ON r.pos BETWEEN t.pos - 30 AND t.pos - 1 " \
         "WHERE t.pos >= 30 AND t.pos < t.cut)"


@entry("sequence_norm", "WITH " + SEQ + ", " + _CELLS + "\nSELECT " + ", ".join(
    f"{q6(f'avg({c})')} AS {c}__mean, {q6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1e-6 ELSE stddev_pop({c}) END')} AS {c}__std"
    for c in KEY_SENSORS) + " FROM cells")
def sequence_norm(spark, sf_dir):
    rows, names = _filled(spark, sf_dir, KEY_SENSORS)
    return rounded(prep.sequence_norms(rows, names))


_BIN_SQL = "least(greatest(" + " + ".join(f"(RUL_minutes >= {e!r})::INTEGER" for e in RUL_EDGES_LEFT) + " - 1, 0), 6)"
_WEIGHTS = f"""
train_bins AS (SELECT {_BIN_SQL} AS bin, count(*) AS n FROM filled WHERE split = 'train' GROUP BY 1),
weights AS (
  SELECT b.bin::INTEGER AS bin, coalesce(n, 0) AS n,
    least(greatest((SELECT sum(n) FROM train_bins) / (7e0 * greatest(coalesce(n, 0), 1)), 0.3e0), 5e0) AS weight
  FROM range(7) b(bin) LEFT JOIN train_bins t ON b.bin = t.bin
)"""


@entry("sample_weights", "WITH " + SEQ + "," + _WEIGHTS + f"\nSELECT bin, n, {q6('weight')} AS weight FROM weights")
def sample_weights(spark, sf_dir):
    rows, _ = _filled(spark, sf_dir, KEY_SENSORS)
    return rounded(prep.bin_weights(rows.filter("split = 'train'")))


@entry("weighted_mse", "WITH " + SEQ + "," + _WEIGHTS + f"""
SELECT 'lag' AS model, {q6('avg(weight * (y_pred - y_true) * (y_pred - y_true))')} AS weighted_mse FROM (
  SELECT *, RUL_minutes AS y_true, lag(RUL_minutes) OVER (ORDER BY pos) AS y_pred, {_BIN_SQL} AS bin FROM filled
) r JOIN weights w ON r.bin = w.bin WHERE split = 'test'""")
def weighted_mse(spark, sf_dir):
    from ..operators.ordered import with_halo

    rows, _ = _filled(spark, sf_dir, KEY_SENSORS)
    weights = prep.bin_weights(rows.filter("split = 'train'"))
    lagged = with_halo(rows, "pos", 1, lambda w: [F.lag("RUL_minutes", 1).over(w).alias("y_pred")])
    test = prep.add_sample_weight(lagged.filter("split = 'test'"), weights)
    return rounded(prep.weighted_mse(test.select(F.lit("lag").alias("model"), F.col("RUL_minutes").alias("y_true"),
                                                 "y_pred", "weight")))


# ---- models: trees differ between libraries, so their results have no twin; `_check` tables hold what SQL can state ----

HELD = "WITH " + prepared_sql(["Motor_current_std"]) + "\n"


def _held_sql(model: str, fact: str) -> str:
    return HELD + f"SELECT '{model}' AS model, pos AS key, {q6('RUL_minutes')} AS y_true, true AS {fact} FROM split WHERE split = 'test'"


def _training(spark, sf_dir):
    return training_set(rul_features(sensor_view(spark, sf_dir)))


def _within(scored, train):
    """Predictions of a forest are means of train labels."""
    low, high = train.agg(F.min("RUL_minutes"), F.max("RUL_minutes")).first()
    inside = F.col("y_pred").between(low - 1e-6, high + 1e-6)
    return rounded(scored.select("model", "key", "y_true", inside.alias("in_train_range")))


def _finite(scored):
    ok = F.col("y_pred").isNotNull() & ~F.isnan("y_pred") & (F.abs("y_pred") < 1e12)
    return rounded(scored.select("model", "key", "y_true", ok.alias("is_finite")))


def _figures(table):
    """Rows counted per model, and whether every figure is a finite number."""
    figures = [c for c in table.columns if c.lower() not in ("model", "n", "folds")]
    ok = [F.col(c).isNotNull() & ~F.isnan(c) for c in figures]
    counted = next(c for c in table.columns if c.lower() in ("n", "folds"))
    name = next(c for c in table.columns if c.lower() == "model")
    return table.select(F.col(name).alias("model"), F.col(counted).cast("long").alias("counted"),
                        F.array_min(F.array(*ok)).alias("all_finite"))


@entry("rf_rul")
def rf_rul(spark, sf_dir):
    data = _training(spark, sf_dir)
    model = models.fit(data.train, data.features, models.forest())
    return models.score(model, data.test, "RandomForest")


@entry("rf_rul_check", _held_sql("RandomForest", "in_train_range"))
def rf_rul_check(spark, sf_dir):
    return _within(rf_rul(spark, sf_dir), _training(spark, sf_dir).train)


@entry("gbt_rul")
def gbt_rul(spark, sf_dir):
    data = _training(spark, sf_dir)
    model = models.fit(data.train, data.features, models.boosted())
    return models.score(model, data.test, "GradientBoosted")


@entry("gbt_rul_check", _held_sql("GradientBoosted", "is_finite"))
def gbt_rul_check(spark, sf_dir):
    return _finite(gbt_rul(spark, sf_dir))


@entry("feature_importance")
def feature_importance(spark, sf_dir):
    data = _training(spark, sf_dir)
    model = models.fit(data.train, data.features, models.forest())
    return models.importances(model, data.features, spark)


@entry("feature_importance_check", f"SELECT {len(FEATURES)} AS features, 1e0 AS total, true AS none_negative, true AS ordered")
def feature_importance_check(spark, sf_dir):
    every = feature_importance(spark, sf_dir)
    top = [r["importance"] for r in every.limit(15).collect()]  # 15 rows
    return rounded(every.agg(F.count(F.lit(1)).alias("features"), F.sum("importance").alias("total"),
                             (F.min("importance") >= 0).alias("none_negative"))
                   .withColumn("ordered", F.lit(top == sorted(top, reverse=True) and len(top) == 15)))


@entry("model_grid")
def model_grid(spark, sf_dir):
    data = _training(spark, sf_dir)
    grid = {"forest-100x12": models.forest(), "boosted-200x5": models.boosted()}
    return models.run_grid(data.train, data.test, data.features, grid)[0]


@entry("model_grid_check", HELD + """
SELECT m.model, count(*) AS counted, true AS all_finite
FROM split, (VALUES ('forest-100x12'), ('boosted-200x5')) m(model) WHERE split = 'test' GROUP BY 1""")
def model_grid_check(spark, sf_dir):
    return _figures(model_grid(spark, sf_dir))


@entry("tuned_in_time")
def tuned_in_time(spark, sf_dir):
    data = _training(spark, sf_dir)
    grid = {"depth-8": models.forest(maxDepth=8), "depth-12": models.forest()}
    return models.tune_in_time(data.train, data.features, grid, prep.time_folds(data.cut, 2))


@entry("tuned_in_time_check", "SELECT model, 2::BIGINT AS counted, true AS all_finite FROM (VALUES ('depth-8'), ('depth-12')) m(model)")
def tuned_in_time_check(spark, sf_dir):
    return _figures(tuned_in_time(spark, sf_dir))


@entry("sequence_gbt")
def sequence_gbt(spark, sf_dir):
    """Boosting on flattened, normalised 30-step windows, weighted by life range, with early stopping."""
    from ..operators.features import sequence_windows as windows

    data = _training(spark, sf_dir)
    rows = data.rows.select("timestamp_bin", "RUL_minutes", "pos", "cut", "split", *KEY_SENSORS)
    normed = prep.normalise(rows, KEY_SENSORS, prep.sequence_norms(rows, KEY_SENSORS))
    sides = prep.validation_tail(prep.sequence_split(windows(normed, KEY_SENSORS)))
    weights = prep.bin_weights(sides.filter("split = 'train'"))
    flat = prep.flatten_sequence(prep.add_sample_weight(sides, weights)).drop("sequence")
    ready = stage(flat, "sequences")
    learner = models.boosted().setWeightCol("weight").setValidationIndicatorCol("held_out")
    marked = ready.filter("split <> 'test'").withColumn("held_out", F.col("split") == "validation")
    return learner.fit(marked).transform(ready.filter("split = 'test'")).select(
        F.lit("SequenceBoosted").alias("model"), F.col("pos").alias("key"), F.col("RUL_minutes").alias("y_true"), "y_pred"
    )


@entry("sequence_gbt_check", "WITH " + SEQ + f"""
SELECT 'SequenceBoosted' AS model, pos AS key, {q6('RUL_minutes')} AS y_true, true AS is_finite
FROM filled WHERE pos >= 30 AND pos >= cut""")
def sequence_gbt_check(spark, sf_dir):
    return _finite(sequence_gbt(spark, sf_dir))


@entry("early_stopping")
def early_stopping(spark, sf_dir):
    data = _training(spark, sf_dir)
    marked = prep.validation_tail(data.rows, length=0)
    model = models.fit_with_validation(marked, data.features, models.boosted())
    return models.score(model, data.test, "GradientBoosted")


@entry("early_stopping_check", _held_sql("GradientBoosted", "is_finite"))
def early_stopping_check(spark, sf_dir):
    return _finite(early_stopping(spark, sf_dir))


@entry("saved_model_eval")
def saved_model_eval(spark, sf_dir):
    table = stage(rul_features(sensor_view(spark, sf_dir)), "features")
    data = training_set(table)
    fitted, predictions = train(data, {"RandomForest": models.forest(), "GradientBoosted": models.boosted()})
    folder = new_path(spark, "artifacts")
    save_artifacts(spark, data, fitted, predictions, folder)
    return evaluate_saved(spark, table, folder)


@entry("saved_model_eval_check", HELD + """
SELECT m.model, count(*) AS counted, true AS all_finite
FROM split, (VALUES ('RandomForest'), ('GradientBoosted')) m(model) WHERE split = 'test' GROUP BY 1""")
def saved_model_eval_check(spark, sf_dir):
    return _figures(saved_model_eval(spark, sf_dir))


# ---- the same per unit -------------------------------------------------------

UNIT_STEPS = prep.SEQUENCE_LENGTH
_UNIT = ",".join([SENSOR, bins_sql(60, True), rul_sql(True), features_sql(True, 1, 60)])
_UNIT_FILL = ", ".join(
    f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM split WHERE split = 'train')) AS {c}"
    for c in ["Motor_current_std", *KEY_SENSORS])
UNIT_SPLIT = f"""WITH {_UNIT},
matrix AS (SELECT *, row_number() OVER (ORDER BY timestamp_bin, unit_id) - 1 AS pos, count(*) OVER () AS n
           FROM feat WHERE RUL_minutes IS NOT NULL),
split AS (SELECT *, CASE WHEN pos < round_even(n * (1.0::DOUBLE - 0.2::DOUBLE), 0)::BIGINT THEN 'train' ELSE 'test' END AS split FROM matrix),
filled AS (
  SELECT unit_id, timestamp_bin, RUL_minutes, split, {_UNIT_FILL},
         row_number() OVER (PARTITION BY unit_id ORDER BY timestamp_bin) - 1 AS pos,
         count(*) FILTER (WHERE split = 'train') OVER (PARTITION BY unit_id) AS cut
  FROM split
)
"""


def _unit_split(spark, sf_dir):
    table = rounded(rul_features(sensor_view(spark, sf_dir), 60, 60, ["unit_id"]))
    matrix, names = prep.feature_matrix(table, parts=["unit_id"])
    return prep.time_split(matrix, parts=["unit_id"]), names


def _unit_filled(spark, sf_dir, names):
    split, every = _unit_split(spark, sf_dir)
    assert "unit_id" not in every
    rows = stage(split, "split")
    return prep.per_series(prep.impute(rows, names, prep.train_medians(rows, names).first().asDict()), ["unit_id"])


@entry("split_by_unit", UNIT_SPLIT + "SELECT unit_id, timestamp_bin, pos, split FROM split")
def split_by_unit(spark, sf_dir):
    return _unit_split(spark, sf_dir)[0].select("unit_id", "timestamp_bin", "pos", "split")


@entry("median_impute_by_unit", UNIT_SPLIT + f"SELECT unit_id, pos, split, {q6('Motor_current_std')} AS Motor_current_std, "
       + ", ".join(f"{q6(c)} AS {c}" for c in KEY_SENSORS) + " FROM filled")
def median_impute_by_unit(spark, sf_dir):
    names = ["Motor_current_std", *KEY_SENSORS]
    return rounded(_unit_filled(spark, sf_dir, names).select("unit_id", "pos", "split", *names))


@entry("sequence_windows_by_unit", UNIT_SPLIT + f"""
SELECT unit_id, pos, {q6('s')} AS total, {q6('f')} AS first_motor FROM (
  SELECT unit_id, pos, sum({' + '.join(KEY_SENSORS)}) OVER w AS s, first_value(Motor_current_avg) OVER w AS f FROM filled
  WINDOW w AS (PARTITION BY unit_id ORDER BY pos ROWS BETWEEN {UNIT_STEPS} PRECEDING AND 1 PRECEDING)
) WHERE pos >= {UNIT_STEPS}""")
def sequence_windows_by_unit(spark, sf_dir):
    from ..operators.features import sequence_windows as windows

    made = windows(_unit_filled(spark, sf_dir, KEY_SENSORS), KEY_SENSORS, UNIT_STEPS, parts=["unit_id"])
    total = F.aggregate(F.flatten("sequence"), F.lit(0.0), lambda a, x: a + x)
    return rounded(made.select("unit_id", "pos", total.alias("total"), F.col("sequence")[0][0].alias("first_motor")))


@entry("sequence_norm_by_unit", UNIT_SPLIT.rstrip() + f""", cells AS (
  SELECT r.* FROM filled t JOIN filled r ON r.unit_id = t.unit_id AND r.pos BETWEEN t.pos - {UNIT_STEPS} AND t.pos - 1
  WHERE t.pos >= {UNIT_STEPS} AND t.pos < t.cut)
SELECT """ + ", ".join(
    f"{q6(f'avg({c})')} AS {c}__mean, {q6(f'stddev_pop({c})')} AS {c}__std" for c in KEY_SENSORS) + " FROM cells")
def sequence_norm_by_unit(spark, sf_dir):
    return rounded(prep.sequence_norms(_unit_filled(spark, sf_dir, KEY_SENSORS), KEY_SENSORS, UNIT_STEPS))


# ---- NaN and infinity --------------------------------------------------------

GAPPY = """gappy AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE WHEN event_id % 13 = 0 THEN 'inf'::DOUBLE ELSE value END AS x,
  CASE WHEN event_id % 17 = 0 THEN '-inf'::DOUBLE ELSE (event_id % 100)::DOUBLE END AS y FROM events),
clean AS (SELECT event_id, CASE WHEN isfinite(x) THEN x END AS x, CASE WHEN isfinite(y) THEN y END AS y FROM gappy)"""


def _gappy(spark, sf_dir):
    bad = {n: F.lit(float(n)) for n in ("nan", "inf", "-inf")}
    i = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.when(i % 11 == 0, bad["nan"]).when(i % 13 == 0, bad["inf"]).otherwise(F.col("value")).alias("x"),
        F.when(i % 17 == 0, bad["-inf"]).otherwise((i % 100).cast("double")).alias("y"))


@entry("correlation_with_gaps", f"WITH {GAPPY} SELECT 'x' AS a, 'y' AS b, {q6('corr(x, y)')} AS r FROM clean")
def correlation_with_gaps(spark, sf_dir):
    return rounded(eda.correlations(_gappy(spark, sf_dir), ["x", "y"]).filter("a = 'x' AND b = 'y'"))


@entry("zscores_with_gaps", f"WITH {GAPPY} SELECT event_id, "
       + ", ".join(f"{q6(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} AS {c}_norm" for c in "xy") + " FROM clean")
def zscores_with_gaps(spark, sf_dir):
    return rounded(eda.zscores(_gappy(spark, sf_dir), ["x", "y"]).select("event_id", "x_norm", "y_norm"))


@entry("summary_with_gaps", f"WITH {GAPPY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, {q6(f'avg({c})')} AS mean, {q6(f'stddev_samp({c})')} AS stddev, "
    f"{q6(f'min({c})')} AS min, {q6(f'max({c})')} AS max FROM clean" for c in "xy"))
def summary_with_gaps(spark, sf_dir):
    return rounded(eda.summary_stats(_gappy(spark, sf_dir), ["x", "y"]))


@entry("csv_feature_training_set", "WITH " + prepared_sql(FEATURES) + "\nSELECT pos, split, "
       + ", ".join(f"{q6(c)} AS {c}" for c in ["RUL_minutes", *FEATURES]) + " FROM filled")
def csv_feature_training_set(spark, sf_dir):
    """A feature table written as CSV, read back with its types, split and imputed for training."""
    path = new_path(spark, "features") + ".csv"
    features_view(spark, sf_dir).write.option("header", True).csv(path)
    return rounded(training_set(read_table(spark, path)).rows.select("pos", "split", "RUL_minutes", *FEATURES))


# ---- evaluation --------------------------------------------------------------

P = "WITH " + PAIRS + "\n"
R2 = "1 - sum(err * err) / (var_pop(y_true) * count(*))"


def metrics_sql(digits: int | None = None, factor: str = "2e0", eps: str = "1e-9", source: str = "good") -> str:
    def out(expr: str) -> str:
        return q6(expr) if digits is None else f"(round({expr} + 3e-9, {digits}) + 0e0)"
    return f"""SELECT model, {out('avg(ae)')} AS MAE, {out('sqrt(avg(err * err))')} AS RMSE, {out(R2)} AS R2,
  {out('avg(err)')} AS Bias, {out(f'100 * avg({factor} * ae / (abs(y_true) + abs(y_pred) + {eps}))')} AS sMAPE_pct,
  {out('100 * avg((ae <= 5)::INTEGER)')} AS Pct_within_5min, {out('100 * avg((ae <= 10)::INTEGER)')} AS Pct_within_10min,
  count(*) AS N FROM {source} GROUP BY model"""


@entry("metrics_table", P + metrics_sql())
def metrics_table(spark, sf_dir):
    return rounded(evaluate.metrics(pairs_view(spark, sf_dir)))


@entry("metrics_rounded", P + metrics_sql(3))
def metrics_rounded(spark, sf_dir):
    return evaluate.metrics(pairs_view(spark, sf_dir), order_by="MAE", digits=3)


@entry("best_model", P + "SELECT arg_min(model, RMSE) AS model, min(RMSE) AS RMSE FROM (" + metrics_sql() + ")")
def best_model(spark, sf_dir):
    return evaluate.best_model(rounded(evaluate.metrics(pairs_view(spark, sf_dir), order_by=None)))


@entry("smape_variants", P + f"""
SELECT model, {q6('100 * avg(2e0 * ae / (abs(y_true) + abs(y_pred) + 1e-9))')} AS smape_fine,
  {q6('100 * avg(2e0 * ae / (abs(y_true) + abs(y_pred) + 1e-6))')} AS smape_coarse,
  {q6('100 * avg(ae / (abs(y_true) + abs(y_pred) + 1e-6))')} AS smape_half FROM good GROUP BY 1""")
def smape_variants(spark, sf_dir):
    return rounded(evaluate.smape_variants(pairs_view(spark, sf_dir)))


@entry("r2_guarded", P + f"""
SELECT model, {q6('1 - sum(err * err) / (var_pop(y_true) * count(*) + 1e-12)')} AS R2 FROM good GROUP BY 1""")
def r2_guarded(spark, sf_dir):
    return rounded(evaluate.metrics(pairs_view(spark, sf_dir), r2_eps=1e-12, order_by=None).select("model", "R2"))


BROKEN = """, broken AS (
  SELECT model, key, y_true, CASE WHEN key % 11 = 0 THEN 'nan'::DOUBLE WHEN key % 13 = 0 THEN 'inf'::DOUBLE ELSE y_pred END AS y_pred
  FROM pairs
)
"""


@entry("pair_mask", "WITH " + PAIRS + BROKEN + """
SELECT model, count(*) FILTER (WHERE y_pred IS NULL OR NOT isfinite(y_pred)) AS dropped FROM broken GROUP BY 1""")
def pair_mask(spark, sf_dir):
    bad = F.when(F.col("key") % 11 == 0, float("nan")).when(F.col("key") % 13 == 0, float("inf")).otherwise(F.col("y_pred"))
    return evaluate.dropped_pairs(pairs_view(spark, sf_dir).withColumn("y_pred", bad))


def _halves(spark, sf_dir):
    pairs = pairs_view(spark, sf_dir)
    truth = pairs.filter("model = 'const' AND key % 7 <> 0").select("key", "y_true")
    return enrich.pair_predictions(truth, pairs.filter("key % 5 <> 0").select("model", "key", "y_pred"))


TRUTH = ", truth AS (SELECT key, y_true FROM pairs WHERE model = 'const' AND key % 7 <> 0), " \
        "preds AS (SELECT model, key, y_pred FROM pairs WHERE key % 5 <> 0)\n"


@entry("pair_join", "WITH " + PAIRS + TRUTH + f"""
SELECT model, key, {q6('y_true')} AS y_true, {q6('y_pred')} AS y_pred FROM preds JOIN truth USING (key)""")
def pair_join(spark, sf_dir):
    return rounded(_halves(spark, sf_dir)[0])


@entry("pair_unmatched", "WITH " + PAIRS + TRUTH + """
SELECT model, count(*) FILTER (WHERE t.key IS NULL) AS predictions_without_truth,
  (SELECT count(*) FROM truth) - count(t.key) AS truth_without_prediction
FROM preds p LEFT JOIN truth t ON p.key = t.key GROUP BY 1""")
def pair_unmatched(spark, sf_dir):
    return _halves(spark, sf_dir)[1]


@entry("calibration_fit", P + f"""
SELECT model, {q6('regr_slope(y_pred, y_true)')} AS slope, {q6('regr_intercept(y_pred, y_true)')} AS intercept,
  {q6(R2)} AS R2, count(*) AS N FROM good GROUP BY 1""")
def calibration_fit(spark, sf_dir):
    return rounded(evaluate.calibration_fit(pairs_view(spark, sf_dir)))


@entry("calibration_curve", "WITH " + PAIRS + f""",
sized AS (
  SELECT model, n, least(40, greatest(2, floor(sqrt(n))))::INTEGER AS bins FROM (SELECT model, count(*) AS n FROM good GROUP BY 1)
),
marks AS (
  SELECT model, i, (i / bins::DOUBLE) * (n - 1) AS place FROM sized, unnest(range(bins + 1)) u(i)
),
ranked AS (SELECT model, y_true, row_number() OVER (PARTITION BY model ORDER BY y_true) - 1 AS rk FROM good),
edges AS (
  SELECT DISTINCT m.model, a.y_true + (b.y_true - a.y_true) * (place - floor(place)) AS e FROM marks m
  JOIN ranked a ON a.model = m.model AND a.rk = floor(place)
  JOIN ranked b ON b.model = m.model AND b.rk = ceil(place)
)
SELECT model, bin, {q6('avg(y_true)')} AS y_mean, {q6('avg(y_pred)')} AS yp_mean, count(*) AS n FROM (
  SELECT g.*, greatest(1, (SELECT count(*) FROM edges e WHERE e.model = g.model AND e.e < g.y_true))::INTEGER AS bin FROM good g
) GROUP BY 1, 2""")
def calibration_curve(spark, sf_dir):
    return rounded(evaluate.calibration_curve(pairs_view(spark, sf_dir)))


def tolerance_sql(step: int) -> str:
    return P + f"""SELECT model, t::INTEGER AS tolerance, {q6('100 * avg((ae <= t)::INTEGER)')} AS accuracy_pct
FROM good, range(0, 61, {step}) g(t) GROUP BY 1, 2"""


@entry("tolerance_curve", tolerance_sql(1))
def tolerance_curve(spark, sf_dir):
    return rounded(evaluate.tolerance_curve(pairs_view(spark, sf_dir)))


@entry("tolerance_curve_even", tolerance_sql(2))
def tolerance_curve_even(spark, sf_dir):
    return rounded(evaluate.tolerance_curve(pairs_view(spark, sf_dir), step=2))


@entry("error_box", P + "SELECT * EXCLUDE (feature) FROM ("
       + box_sql("SELECT model, 'abs_error' AS feature, ae AS value FROM good", "model") + ")")
def error_box(spark, sf_dir):
    return rounded(evaluate.error_box(pairs_view(spark, sf_dir)))


def mae_sql(op: str, edges: list[float]) -> str:
    where = " + ".join(f"(y_true {op} {e!r})::INTEGER" for e in edges)
    labels = ", ".join(f"({i}, '{t}')" for i, t in enumerate(RUL_LABELS))
    return P + f"""SELECT m.model, l.bin, l.label, {q6('b.mae')} AS mae, coalesce(b.n, 0) AS n
FROM (SELECT DISTINCT model FROM good) m CROSS JOIN (VALUES {labels}) l(bin, label)
LEFT JOIN (SELECT model, {where} - 1 AS bin, avg(ae) AS mae, count(*) AS n FROM good GROUP BY 1, 2) b
  ON b.model = m.model AND b.bin = l.bin"""


@entry("mae_by_bin_left", mae_sql(">=", RUL_EDGES_LEFT))
def mae_by_bin_left(spark, sf_dir):
    return rounded(evaluate.mae_by_bin(pairs_view(spark, sf_dir), "left"))


@entry("mae_by_bin_right", mae_sql(">", RUL_EDGES_RIGHT))
def mae_by_bin_right(spark, sf_dir):
    return rounded(evaluate.mae_by_bin(pairs_view(spark, sf_dir), "right"))


LIMITS = """lims AS (
  SELECT axis, lo - 0.05e0 * (hi - lo + 1e-6) AS low, hi + 0.05e0 * (hi - lo + 1e-6) AS high FROM (
    SELECT 'truth' AS axis, quantile_cont(y_true, 0.01) AS lo, quantile_cont(y_true, 0.99) AS hi FROM good
    UNION ALL SELECT 'error', quantile_cont(err, 0.01), quantile_cont(err, 0.99) FROM good))"""


@entry("axis_limits", "WITH " + PAIRS + ", " + LIMITS + f"\nSELECT axis, {q6('low')} AS low, {q6('high')} AS high FROM lims")
def axis_limits(spark, sf_dir):
    return rounded(evaluate.axis_limits(pairs_view(spark, sf_dir)))


def error_histogram_sql(bins: int, shown: str) -> str:
    return f"""SELECT model, bin, {q6(f'lo + bin * ((hi - lo) / {bins}e0)')} AS low,
  {q6(f'lo + (bin + 1) * ((hi - lo) / {bins}e0)')} AS high, n, {q6('bias')} AS bias FROM (
  SELECT model, lo, hi, bias, CASE WHEN hi > lo
      THEN least(greatest(floor((v - lo) / nullif((hi - lo) / {bins}e0, 0)), 0), {bins - 1})::INTEGER
      ELSE {bins // 2} END AS bin, count(*) AS n
  FROM (SELECT model, {shown} AS v FROM good)
  JOIN (SELECT model, min({shown}) AS lo, max({shown}) AS hi, avg(err) AS bias FROM good GROUP BY 1) USING (model)
  GROUP BY ALL)"""


@entry("error_histogram", P + error_histogram_sql(60, "err"))
def error_histogram(spark, sf_dir):
    return rounded(evaluate.error_histogram(pairs_view(spark, sf_dir)))


@entry("error_histogram_clipped", "WITH " + PAIRS + ", " + LIMITS + "\n" + error_histogram_sql(
    60, "least(greatest(err, (SELECT low FROM lims WHERE axis = 'error')), (SELECT high FROM lims WHERE axis = 'error'))"))
def error_histogram_clipped(spark, sf_dir):
    return rounded(evaluate.error_histogram(pairs_view(spark, sf_dir), clipped=True))


def even_sql(points: int) -> str:
    return f""",
placed_pairs AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY key) - 1 AS pos,
                        count(*) OVER (PARTITION BY model) AS n FROM good),
wanted AS (
  SELECT DISTINCT model, CASE WHEN i = k - 1 THEN n - 1 ELSE floor(i * ((n - 1)::DOUBLE / (k - 1)))::BIGINT END AS pos
  FROM (SELECT model, n, least(n, {points}) AS k FROM (SELECT model, count(*) AS n FROM good GROUP BY 1)),
       unnest(range(k)) u(i)
)
"""


@entry("pred_sample", "WITH " + PAIRS + even_sql(400) + f"""
SELECT model, key, pos, {q6('y_true')} AS y_true, {q6('y_pred')} AS y_pred FROM placed_pairs SEMI JOIN wanted USING (model, pos)""")
def pred_sample(spark, sf_dir):
    return rounded(evaluate.even_sample(pairs_view(spark, sf_dir), 400))


@entry("residual_sample", "WITH " + PAIRS + even_sql(500) + f"""
SELECT model, key, {q6('y_true')} AS y_true, {q6('err')} AS residual FROM placed_pairs SEMI JOIN wanted USING (model, pos)""")
def residual_sample(spark, sf_dir):
    return rounded(evaluate.residual_sample(pairs_view(spark, sf_dir), 500))


@entry("time_slice", P + f"""
SELECT model, key, {q6('y_true')} AS y_true, {q6('y_pred')} AS y_pred FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY key) AS rn FROM good) WHERE rn <= 200""")
def time_slice(spark, sf_dir):
    return rounded(evaluate.time_slice(pairs_view(spark, sf_dir), 200))


# ---- drift -------------------------------------------------------------------

DRIFT = ["Motor_current_avg", "Oil_temperature_avg", "DV_pressure_avg", "RUL_minutes"]


@entry("feature_drift", "WITH " + prepared_sql(["Motor_current_std"]) + f""",
long_rows AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, timestamp_bin, split, {c} AS value FROM split WHERE {c} IS NOT NULL" for c in DRIFT)}
),
prof AS (
  SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, count(*) AS total,
         list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges
  FROM long_rows WHERE split = 'train' GROUP BY 1
),
placed_rows AS (
  SELECT l.*, len(list_filter(edges, lambda e: e < value)) AS bucket FROM long_rows l JOIN prof USING (feature)
),
days AS (SELECT feature, timestamp_bin::DATE AS day, count(*) AS n, sum(value) AS s FROM placed_rows GROUP BY 1, 2),
expect AS (SELECT feature, bucket, count(*) AS e FROM placed_rows WHERE split = 'train' GROUP BY 1, 2),
actual AS (SELECT feature, timestamp_bin::DATE AS day, bucket, count(*) AS a FROM placed_rows GROUP BY 1, 2, 3),
shares AS (
  SELECT d.feature, d.day, d.n, d.s, mean, std, greatest(coalesce(a, 0) / d.n::DOUBLE, 1e-4) AS a,
         greatest(coalesce(e, 0) / total::DOUBLE, 1e-4) AS e
  FROM days d JOIN (SELECT *, unnest(range(len(edges) + 1)) AS bucket FROM prof) p ON p.feature = d.feature
  LEFT JOIN expect x ON x.feature = d.feature AND x.bucket = p.bucket
  LEFT JOIN actual y ON y.feature = d.feature AND y.day = d.day AND y.bucket = p.bucket
)
SELECT feature, day, n, {q6('CASE WHEN std <> 0 THEN (s / n - mean) / std END')} AS mean_shift,
       {q6('sum((a - e) * ln(a / e))')} AS psi FROM shares GROUP BY feature, day, n, s, mean, std""")
def feature_drift(spark, sf_dir):
    split = stage(_split(spark, sf_dir)[0].select("timestamp_bin", "split", *DRIFT), "split")
    return rounded(live.feature_drift(split, split.filter("split = 'train'"), DRIFT))


@entry("rul_bins", "WITH " + ",".join([SENSOR, bins_sql(), rul_sql()]) + f"""
SELECT {" + ".join(f"(RUL_minutes >= {e!r})::INTEGER" for e in RUL_EDGES_LEFT)} - 1 AS bin, count(*) AS n
FROM life WHERE RUL_minutes IS NOT NULL GROUP BY 1""")
def rul_bins(spark, sf_dir):
    from ..plans.etl import labelled_bins

    life = clean.only_defined(labelled_bins(sensor_view(spark, sf_dir)))
    return life.groupBy(edge_index_left("RUL_minutes", RUL_EDGES_LEFT).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@entry("column_medians", FEAT + "SELECT " + ", ".join(
    q6(f"quantile_cont({c}, 0.5)") + f" AS {c}" for c in STATS) + " FROM feat")
def column_medians(spark, sf_dir):
    return rounded(medians(features_view(spark, sf_dir), STATS))


@entry("report_export", P + metrics_sql())
def report_export(spark, sf_dir):
    """The whole table of metrics written as CSV and read back with its types."""
    table = evaluate.metrics(pairs_view(spark, sf_dir))
    path = write_report(table, new_path(spark, "reports"), "metrics")
    return rounded(spark.read.schema(table.schema).csv(path, header=True))
