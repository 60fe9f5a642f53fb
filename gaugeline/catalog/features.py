"""Registered queries: features, labels, joins, reliability, streams. Each entry is (query, SQL twin or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timebins import add_time_of_day, hour_bucket, hours_between, minute_of_day, minutes_between, time_bin
from ..operators import bins, clean, eda, enrich, features, kpi, rul
from ..plans import hourly, incremental
from ..plans.etl import binned_log, labelled_bins, rul_features, run_etl
from ..session import new_path, stage
from ..sources import read_features, read_sensor_csv, read_table, write_features, write_table
from ..sources.fixtures import context_view, full_sensor_view, sensor_view, station_context_view, stations_view
from ..streaming import live
from ..schema import BINARY_SIGNALS, NUMERIC_SIGNALS
from .common import (
    CONTEXT, FULL_SENSOR, HOURLY, HOURLY_COLUMNS, HOURLY_ROUNDED, SENSOR, SIGNALS, bins_sql, features_sql, hourly_view,
    q6, r6, rounded, rul_sql, unit_bins_view, with_,
)

CATALOG: dict = {}


def entry(name: str, sql: str | None = None):
    def keep(f):
        CATALOG[name] = (f, sql)
        return f
    return keep


# ---- feature tables ----------------------------------------------------------

@entry("rul_features", with_(SENSOR, bins_sql(), rul_sql(), features_sql()) + "SELECT * FROM feat")
def rul_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rul_features(sensor_view(spark, sf_dir)))


@entry("rul_features_by_unit",
       with_(SENSOR, bins_sql(60, True), rul_sql(True), features_sql(True, 1, 60)) + "SELECT * FROM feat")
def rul_features_by_unit(spark, sf_dir):
    return rounded(rul_features(sensor_view(spark, sf_dir), 60, 60, ["unit_id"]))


@entry("rul_features_notebook",
       with_(SENSOR, bins_sql(source="flagged"), rul_sql(), features_sql(rows_back=15)) + "SELECT * FROM feat")
def rul_features_notebook(spark, sf_dir):
    """The other published setting: 15 rows back, rows without a place kept."""
    return rounded(rul_features(sensor_view(spark, sf_dir), require_gps=False, rows_back=15))


@entry("bin_aggregates", with_(SENSOR, bins_sql(10)) + "SELECT timestamp_bin, failure, COMP_flag, MPG_flag, LPS_flag, "
       + ", ".join(f"{q6(f'{c}_{s}')} AS {c}_{s}" for c in SIGNALS for s in ("avg", "std", "min", "max")) + " FROM bins")
def bin_aggregates(spark, sf_dir):
    ready = clean.prepare_readings(sensor_view(spark, sf_dir))
    return rounded(bins.bin_readings(ready, 10))


@entry("time_range_rolling", with_(SENSOR, bins_sql()) + f"""
SELECT timestamp_bin,
  {q6('avg(Motor_current_avg) OVER w')} AS Motor_current_avg_range_mean,
  {q6('stddev_samp(Motor_current_avg) OVER w')} AS Motor_current_avg_range_std,
  {q6('var_samp(Motor_current_avg) OVER w')} AS Motor_current_avg_range_var,
  {q6('sqrt(avg(Motor_current_avg * Motor_current_avg) OVER w)')} AS Motor_current_avg_range_rms
FROM bins WINDOW w AS (ORDER BY timestamp_bin
  RANGE BETWEEN INTERVAL 30 minutes PRECEDING AND INTERVAL 1 second PRECEDING)""")
def time_range_rolling(spark, sf_dir):
    binned = binned_log(sensor_view(spark, sf_dir)).select("timestamp_bin", "Motor_current_avg")
    return rounded(features.time_range_rolling(binned, ["Motor_current_avg"]).drop("Motor_current_avg"))


@entry("rul_capped", with_(SENSOR, bins_sql(), rul_sql(cap=60.0))
       + f"SELECT timestamp_bin, failure, {q6('RUL_minutes')} AS RUL_minutes FROM life")
def rul_capped(spark, sf_dir):
    table = labelled_bins(sensor_view(spark, sf_dir), rul_cap=60.0)
    return rounded(table.select("timestamp_bin", "failure", "RUL_minutes"))


@entry("time_of_day", with_(SENSOR) + f"""
SELECT reading_id, hour("timestamp") * 60 + minute("timestamp") AS minute_of_day,
  {q6('sin(2 * pi() * (hour("timestamp") * 60 + minute("timestamp")) / 1440.0)')} AS tod_sin,
  {q6('cos(2 * pi() * (hour("timestamp") * 60 + minute("timestamp")) / 1440.0)')} AS tod_cos
FROM sensor""")
def time_of_day(spark, sf_dir):
    rows = add_time_of_day(sensor_view(spark, sf_dir).select("reading_id", "timestamp"), "timestamp")
    return rounded(rows.select("reading_id", minute_of_day("timestamp").cast("bigint").alias("minute_of_day"),
                               "tod_sin", "tod_cos"))


@entry("time_differences", with_(SENSOR) + f"""
SELECT reading_id, time_bucket(INTERVAL '15 minutes', "timestamp") AS bin,
  {q6('''(floor(epoch("timestamp")) - epoch(time_bucket(INTERVAL '15 minutes', "timestamp"))) / 60.0''')} AS minutes_in,
  {q6('''(floor(epoch("timestamp")) - epoch(time_bucket(INTERVAL '15 minutes', "timestamp"))) / 3600.0''')} AS hours_in
FROM sensor""")
def time_differences(spark, sf_dir):
    rows = sensor_view(spark, sf_dir).select("reading_id", "timestamp", time_bin("timestamp", 15).alias("bin"))
    return rounded(rows.select("reading_id", "bin", minutes_between("timestamp", "bin").alias("minutes_in"),
                               hours_between("timestamp", "bin").alias("hours_in")))


# ---- hourly path -------------------------------------------------------------

@entry("hourly_location", with_(SENSOR, HOURLY)
       + f"SELECT timestamp_hour, lat_rounded, lon_rounded, {HOURLY_ROUNDED} FROM hourly")
def hourly_location(spark, sf_dir):
    return rounded(bins.hourly_by_place(sensor_view(spark, sf_dir)))


LABELLED = with_(SENSOR, HOURLY, """
place_failures AS (
  SELECT date_trunc('hour', "timestamp") AS timestamp_hour, round(gpsLat, 2) AS lat_rounded,
         round(gpsLong, 2) AS lon_rounded, max(failure_raw) AS failure
  FROM flagged GROUP BY 1, 2, 3
)""") + f"""
SELECT h.timestamp_hour, h.lat_rounded, h.lon_rounded, {HOURLY_ROUNDED}, coalesce(p.failure, 0) AS failure
FROM hourly h LEFT JOIN place_failures p ON h.timestamp_hour = p.timestamp_hour
  AND h.lat_rounded = p.lat_rounded AND h.lon_rounded = p.lon_rounded"""


@entry("hourly_labels_joined", LABELLED)
def hourly_labels_joined(spark, sf_dir):
    return rounded(hourly.hourly_labelled(sensor_view(spark, sf_dir)))


@entry("hourly_labels_fused", LABELLED)
def hourly_labels_fused(spark, sf_dir):
    return rounded(hourly.hourly_fused(sensor_view(spark, sf_dir)))


@entry("hourly_failure_join", with_(SENSOR, HOURLY) + "SELECT * FROM hf")
def hourly_failure_join(spark, sf_dir):
    return rounded(hourly.hourly_failure(sensor_view(spark, sf_dir)))


@entry("place_failures", with_(SENSOR) + """
SELECT date_trunc('hour', "timestamp") AS timestamp_hour, round(gpsLat, 2) AS lat_rounded,
       round(gpsLong, 2) AS lon_rounded, max(failure_raw) AS failure
FROM flagged GROUP BY 1, 2, 3""")
def place_failures(spark, sf_dir):
    return bins.failures_by_place(sensor_view(spark, sf_dir))


@entry("rul_hours", with_(SENSOR, HOURLY) + f"""
SELECT timestamp_hour, lat_rounded, lon_rounded, {', '.join(HOURLY_COLUMNS)}, failure, next_failure_time,
  {q6('CASE WHEN failure = 1 THEN 0e0 ELSE epoch(next_failure_time - timestamp_hour) / 3600.0 END')} AS RUL_hours
FROM (SELECT *, min(CASE WHEN failure = 1 THEN timestamp_hour END) OVER (
        ORDER BY timestamp_hour RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_failure_time
      FROM hf)""")
def rul_hours(spark, sf_dir):
    return rounded(hourly.rul_hours(sensor_view(spark, sf_dir)))


# ---- sources and sinks -------------------------------------------------------

SOURCE_ROWS = with_(SENSOR) + """
SELECT unit_id, "timestamp", Motor_current, Oil_temperature, DV_pressure, COMP, MPG, LPS, gpsLat, gpsLong
FROM sensor"""


@entry("csv_round_trip", SOURCE_ROWS)
def csv_round_trip(spark, sf_dir):
    path = new_path(spark, "readings") + ".csv"
    rows = sensor_view(spark, sf_dir).drop("reading_id")
    rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).write.csv(path, header=True)
    back = read_table(spark, path)
    return clean.parse_time(back).select(*rows.columns)


@entry("csv_inferred_round_trip", SOURCE_ROWS)
def csv_inferred_round_trip(spark, sf_dir):
    path = new_path(spark, "readings")
    rows = sensor_view(spark, sf_dir).drop("reading_id")
    rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).write.csv(path, header=True)
    back = clean.parse_time(read_sensor_csv(spark, path, infer=True)).select(*rows.columns)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])


@entry("parquet_round_trip", with_(SENSOR, bins_sql()) + "SELECT timestamp_bin, failure, Motor_current_min, "
       "Motor_current_max FROM bins WHERE timestamp_bin >= TIMESTAMP '2024-01-08' AND timestamp_bin < TIMESTAMP '2024-01-15'")
def parquet_round_trip(spark, sf_dir):
    """Write by day, then read one week: only its folders are opened."""
    path = new_path(spark, "by-day")
    binned = bins.bin_readings(clean.prepare_readings(sensor_view(spark, sf_dir)))
    write_features(binned.select("timestamp_bin", "failure", "Motor_current_min", "Motor_current_max"), path)
    return read_features(spark, path, "2024-01-08", "2024-01-14")


@entry("etl_job", with_(SENSOR, bins_sql(), rul_sql(), features_sql()) + "SELECT * FROM feat")
def etl_job(spark, sf_dir):
    """The whole job from a CSV log to the written feature table."""
    source, target = new_path(spark, "log") + ".csv", new_path(spark, "feature-table")
    rows = sensor_view(spark, sf_dir).drop("reading_id")
    rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).write.csv(source, header=True)
    return rounded(run_etl(spark, source, target))


@entry("bin_aggregates_full", with_(SENSOR, FULL_SENSOR) + """
SELECT time_bucket(INTERVAL '2 minutes', "timestamp") AS timestamp_bin, """ + ", ".join(
    [f"{q6(f'{f}({c})')} AS {c}_{n}" for c in NUMERIC_SIGNALS
     for n, f in (("avg", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    + [f"max({c}) AS {c}_flag" for c in BINARY_SIGNALS])
       + ", max(failure_raw) AS failure FROM full_log WHERE gpsLat IS NOT NULL AND gpsLong IS NOT NULL GROUP BY 1")
def bin_aggregates_full(spark, sf_dir):
    """Bins of a log with all signals."""
    return rounded(bins.bin_readings(clean.prepare_readings(full_sensor_view(spark, sf_dir)), 2))


@entry("hourly_location_full", with_(SENSOR, FULL_SENSOR) + f"""
SELECT date_trunc('hour', "timestamp") AS timestamp_hour, round(gpsLat, 2) AS lat_rounded, round(gpsLong, 2) AS lon_rounded,
  {q6('avg(TP2)')} AS TP2_avg, {q6('stddev_samp(TP2)')} AS TP2_std, {q6('avg(TP3)')} AS TP3_avg, {q6('avg(H1)')} AS H1_avg,
  {q6('avg(DV_pressure)')} AS DV_pressure_avg, {q6('avg(Oil_temperature)')} AS Oil_temp_avg,
  {q6('avg(Motor_current)')} AS Motor_current_avg, {q6('max(Motor_current)')} AS Motor_current_max,
  {q6('min(Motor_current)')} AS Motor_current_min
FROM full_log WHERE gpsLat IS NOT NULL AND gpsLong IS NOT NULL GROUP BY 1, 2, 3""")
def hourly_location_full(spark, sf_dir):
    """The hourly table by place of a log with all signals."""
    placed = clean.grid_cell(clean.prepare_readings(full_sensor_view(spark, sf_dir)))
    keys = [hour_bucket("timestamp").alias("timestamp_hour"), "lat_rounded", "lon_rounded"]
    return rounded(placed.groupBy(*keys).agg(*bins.hourly_statistics(placed)))


@entry("incremental_features",
       with_(SENSOR, bins_sql(60, True), rul_sql(True), features_sql(True, 1, 60)) + "SELECT * FROM feat")
def incremental_features(spark, sf_dir):
    """A feature store made from a log that lacks the second half of its middle day, then given that day whole."""
    readings, store = sensor_view(spark, sf_dir), new_path(spark, "store")
    day = F.to_date("timestamp")
    span = readings.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    middle = F.lit(span["first"] + (span["last"] - span["first"]) // 2)
    there = (day != middle) | (F.hour("timestamp") < 12)
    incremental.update_features(readings.filter(there), store, 60, 60, ["unit_id"])
    incremental.update_features(readings.filter(day == middle), store, 60, 60, ["unit_id"])
    return rounded(incremental.read_store(spark, store))


# ---- joins -------------------------------------------------------------------

ASOF = with_(SENSOR, CONTEXT) + """
SELECT s.reading_id, s.unit_id, s."timestamp", c.ts AS ts_matched, c.temp
FROM (SELECT *, unit_id % 7 AS cell_id FROM sensor) s
ASOF LEFT JOIN context c ON s.cell_id = c.cell_id AND s."timestamp" >= c.ts"""


def _with_context(spark, sf_dir):
    readings = sensor_view(spark, sf_dir).select(
        "reading_id", "unit_id", "timestamp", (F.col("unit_id") % 7).alias("cell_id")
    )
    context = context_view(spark, sf_dir)
    return enrich.as_of(readings, context, "cell_id", "timestamp", "ts", ["temp"], ["reading_id"])


@entry("asof_context", ASOF)
def asof_context(spark, sf_dir):
    return _with_context(spark, sf_dir).drop("cell_id")


@entry("context_filtered", f"""
SELECT reading_id, unit_id, "timestamp", regime FROM (
  SELECT *, CASE WHEN temp < 200000 THEN 'mild' WHEN temp >= 200000 THEN 'harsh' END AS regime FROM ({ASOF})
) WHERE regime = 'harsh' AND unit_id % 7 IN (1, 2) AND "timestamp" >= TIMESTAMP '2024-01-05'
  AND "timestamp" < TIMESTAMP '2024-01-20'""")
def context_filtered(spark, sf_dir):
    """Dashboard filters: weather regime, route and time span."""
    regime = F.when(F.col("temp") < 200000, "mild").when(F.col("temp") >= 200000, "harsh")
    rows = _with_context(spark, sf_dir).withColumn("regime", regime)
    kept = kpi.dashboard_filter(rows, {"regime": "harsh", "cell_id": [1, 2]}, "timestamp",
                                "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return kept.select("reading_id", "unit_id", "timestamp", "regime")


NEAREST_KM = 2.0
NEAREST = f"""
stations AS (
  SELECT s_suppkey AS station_id, 41.0::DOUBLE + 0.00131::DOUBLE * (s_suppkey * 31 % 173) AS lat,
         (-8.75)::DOUBLE + 0.00173::DOUBLE * (s_suppkey * 57 % 131) AS lon FROM supplier
),
spots AS (SELECT DISTINCT gpsLat, gpsLong FROM placed),
apart AS (
  SELECT gpsLat, gpsLong, station_id, 2 * 6371.0088::DOUBLE * asin(sqrt(
    pow(sin(radians(lat - gpsLat) / 2), 2)
    + cos(radians(gpsLat)) * cos(radians(lat)) * pow(sin(radians(lon - gpsLong) / 2), 2))) AS distance_km
  FROM spots, stations
),
nearest AS (
  SELECT * FROM apart WHERE distance_km <= {NEAREST_KM}
  QUALIFY row_number() OVER (PARTITION BY gpsLat, gpsLong ORDER BY distance_km, station_id) = 1
)"""


def _with_station(spark, sf_dir):
    readings = sensor_view(spark, sf_dir).select("reading_id", "timestamp", "gpsLat", "gpsLong")
    return enrich.nearest_place(readings, stations_view(spark, sf_dir), "station_id", "gpsLat", "gpsLong",
                                "lat", "lon", NEAREST_KM, cell_km=0.25)


@entry("nearest_station", with_(SENSOR, NEAREST) + f"""
SELECT reading_id, station_id, {q6('distance_km')} AS distance_km
FROM sensor LEFT JOIN nearest USING (gpsLat, gpsLong)""")
def nearest_station(spark, sf_dir):
    """Each reading's nearest station within two kilometres."""
    return rounded(_with_station(spark, sf_dir).select("reading_id", "station_id", "distance_km"))


@entry("nearest_context", with_(SENSOR, NEAREST, """
weather AS (
  SELECT o_custkey % 20 AS spot, TIMESTAMP '2024-01-01' + to_hours(((o_orderkey % 30) * 24 + o_custkey % 24)::BIGINT) AS ts,
         max(o_totalprice) AS temp
  FROM orders GROUP BY 1, 2
),
located AS (SELECT s.reading_id, s."timestamp", n.station_id, n.station_id % 20 AS spot
            FROM sensor s LEFT JOIN nearest n USING (gpsLat, gpsLong))""") + """
SELECT l.reading_id, l.station_id, w.ts AS ts_matched, w.temp
FROM located l ASOF LEFT JOIN weather w ON l.spot = w.spot AND l."timestamp" >= w.ts""")
def nearest_context(spark, sf_dir):
    """The newest weather of the nearest station's network at or before a reading."""
    located = _with_station(spark, sf_dir).select("reading_id", "timestamp", "station_id",
                                                  (F.col("station_id") % 20).alias("spot"))
    weather = station_context_view(spark, sf_dir).withColumnRenamed("station_id", "spot")
    matched = enrich.as_of(located, weather, "spot", "timestamp", "ts", ["temp"], ["reading_id"])
    return matched.select("reading_id", "station_id", "ts_matched", "temp")


@entry("around_all_failures", with_(SENSOR, bins_sql(60, True)) + """
SELECT e.failure_time, count(*) AS bins_near, count(DISTINCT b.unit_id) AS units_near
FROM bins b JOIN (SELECT DISTINCT timestamp_bin AS failure_time FROM bins WHERE failure = 1) e
  ON b.timestamp_bin BETWEEN e.failure_time - INTERVAL 6 hours AND e.failure_time + INTERVAL 2 hours
GROUP BY 1""")
def around_all_failures(spark, sf_dir):
    """Bins of the whole fleet around every failure time: an interval join without a key."""
    binned = binned_log(sensor_view(spark, sf_dir), 60, ["unit_id"]).select("unit_id", "timestamp_bin", "failure")
    events = clean.only_failures(binned).select(F.col("timestamp_bin").alias("failure_time")).distinct()
    near = enrich.around_events(binned.drop("failure"), events, "timestamp_bin", "failure_time", 6 * 3600, 2 * 3600)
    return near.groupBy("failure_time").agg(F.count(F.lit(1)).alias("bins_near"), F.countDistinct("unit_id").alias("units_near"))


@entry("static_places", with_(SENSOR) + """
SELECT reading_id, round(gpsLat, 2) AS lat_rounded, round(gpsLong, 2) AS lon_rounded, p.readings
FROM sensor LEFT JOIN (
  SELECT round(gpsLat, 2) AS la, round(gpsLong, 2) AS lo, count(*) AS readings FROM placed GROUP BY 1, 2
) p ON round(gpsLat, 2) = p.la AND round(gpsLong, 2) = p.lo""")
def static_places(spark, sf_dir):
    """Grid-cell attributes joined onto readings; readings without a place keep NULL."""
    cells = ["lat_rounded", "lon_rounded"]
    readings = clean.grid_cell(sensor_view(spark, sf_dir)).select("reading_id", *cells)
    places = readings.dropna(subset=cells).groupBy(*cells).agg(F.count(F.lit(1)).alias("readings"))
    return enrich.join_static(readings, places, cells).select("reading_id", *cells, "readings")


@entry("around_failures", with_(SENSOR, bins_sql(60, True)) + """
SELECT b.unit_id, b.timestamp_bin, e.timestamp_bin AS failure_time
FROM bins b JOIN (SELECT unit_id, timestamp_bin FROM bins WHERE failure = 1) e
  ON b.unit_id = e.unit_id AND b.timestamp_bin BETWEEN e.timestamp_bin - INTERVAL 12 hours
                                                   AND e.timestamp_bin + INTERVAL 12 hours""")
def around_failures(spark, sf_dir):
    binned = binned_log(sensor_view(spark, sf_dir), 60, ["unit_id"]).select("unit_id", "timestamp_bin", "failure")
    events = clean.only_failures(binned).select("unit_id", F.col("timestamp_bin").alias("failure_time"))
    near = enrich.around_events(binned.drop("failure"), events, "timestamp_bin", "failure_time",
                                12 * 3600, 12 * 3600, ["unit_id"])
    return near.select("unit_id", "timestamp_bin", "failure_time")


# ---- cleaning ----------------------------------------------------------------

@entry("unit_normalised", with_(SENSOR) + f"""
SELECT reading_id, {q6('Motor_current * 1000e0')} AS Motor_current,
       {q6('Oil_temperature * 1.8e0 + 32e0')} AS Oil_temperature FROM sensor""")
def unit_normalised(spark, sf_dir):
    """Amperes to milliamperes, Celsius to Fahrenheit."""
    rows = sensor_view(spark, sf_dir).select("reading_id", "Motor_current", "Oil_temperature")
    return rounded(clean.rescale(rows, {"Motor_current": (1000.0, 0.0), "Oil_temperature": (1.8, 32.0)}))


@entry("failure_flags", with_(SENSOR) + """
SELECT reading_id, "timestamp", COMP, MPG, LPS, failure_raw AS failure FROM flagged WHERE failure_raw = 1""")
def failure_flags(spark, sf_dir):
    rows = clean.flag_failures(sensor_view(spark, sf_dir), "failure")
    return clean.only_failures(rows).select("reading_id", "timestamp", "COMP", "MPG", "LPS", "failure")


@entry("finite_values", with_(SENSOR) + f"""
SELECT reading_id, CASE WHEN isfinite(x) THEN {q6('x')} END AS x FROM (
  SELECT reading_id, CASE WHEN COMP = 0 THEN 'nan'::DOUBLE WHEN MPG = 0 THEN 'inf'::DOUBLE
                          WHEN LPS = 0 THEN '-inf'::DOUBLE ELSE Motor_current END AS x FROM sensor)""")
def finite_values(spark, sf_dir):
    broken = F.when(F.col("COMP") == 0, float("nan")).when(F.col("MPG") == 0, float("inf")).when(
        F.col("LPS") == 0, float("-inf")).otherwise(F.col("Motor_current"))
    rows = sensor_view(spark, sf_dir).select("reading_id", broken.alias("x"))
    return rounded(clean.finite_columns(rows, ["x"]))


@entry("melted_signals", with_(SENSOR) + "UNPIVOT (SELECT reading_id, Motor_current, Oil_temperature, DV_pressure FROM sensor) "
       "ON Motor_current, Oil_temperature, DV_pressure INTO NAME feature VALUE value")
def melted_signals(spark, sf_dir):
    return clean.melt(sensor_view(spark, sf_dir), SIGNALS, ["reading_id"])


@entry("complete_rows", with_(SENSOR, bins_sql()) + f"""
SELECT timestamp_bin, {q6('Motor_current_std')} AS Motor_current_std FROM bins
WHERE Motor_current_std IS NOT NULL AND Motor_current_avg IS NOT NULL""")
def complete_rows(spark, sf_dir):
    binned = bins.bin_readings(clean.prepare_readings(sensor_view(spark, sf_dir)))
    full = clean.complete_rows(binned, ["Motor_current_avg", "Motor_current_std"])
    return rounded(full.select("timestamp_bin", "Motor_current_std"))


@entry("failure_hours", with_(SENSOR) + """
SELECT DISTINCT date_trunc('hour', "timestamp") AS timestamp_hour FROM flagged WHERE failure_raw = 1
ORDER BY 1 LIMIT 3""")
def failure_hours(spark, sf_dir):
    """The first three failing hours."""
    by_hour = bins.failures_by_hour(sensor_view(spark, sf_dir))
    return clean.distinct_values(clean.only_failures(by_hour), "timestamp_hour", 3)


@entry("sample_rows", with_(SENSOR) + """
SELECT reading_id, unit_id FROM sensor
WHERE ('0x' || substr(md5('42:' || reading_id), 1, 13))::BIGINT < 0.1 * 4503599627370496""")
def sample_rows(spark, sf_dir):
    return clean.sample_rows(sensor_view(spark, sf_dir), keys=["reading_id"]).select("reading_id", "unit_id")


# ---- reliability and status --------------------------------------------------

UNIT_LIFE = with_(SENSOR, bins_sql(60, True), rul_sql(True), """
ends AS (SELECT unit_id, max(timestamp_bin) AS last_bin FROM life GROUP BY 1),
aged AS (
  SELECT life.*, CASE WHEN minutes_since_last_failure = 0 THEN 0 ELSE floor(minutes_since_last_failure / 360) + 1 END AS age,
         coalesce(RUL_minutes, epoch(last_bin - timestamp_bin) / 60.0) AS seen
  FROM life JOIN ends USING (unit_id)
),
leaving AS (SELECT age, seen, count(*) AS n, count(RUL_minutes) AS failures FROM aged GROUP BY 1, 2),
at_risk AS (
  SELECT *, sum(n) OVER (PARTITION BY age ORDER BY seen DESC) AS at_risk,
         coalesce(lag(seen) OVER (PARTITION BY age ORDER BY seen), 0) AS before FROM leaving
),
survival AS (
  SELECT age, seen, before, failures, at_risk, coalesce(product(1 - failures::DOUBLE / at_risk) OVER (
    PARTITION BY age ORDER BY seen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS alive FROM at_risk
),
life_table AS (SELECT age, sum(alive * (seen - before)) AS mean_minutes FROM survival GROUP BY 1 HAVING sum(failures) > 0),
predicted AS (
  SELECT aged.*, coalesce(t.mean_minutes, (SELECT avg(mean_minutes) FROM life_table WHERE age IS DISTINCT FROM 0)) AS predicted_minutes
  FROM aged LEFT JOIN life_table t ON aged.age IS NOT DISTINCT FROM t.age
)""")
BAND = """CASE WHEN predicted_minutes < 120 THEN 'Critical' WHEN predicted_minutes <= 480 THEN 'High'
          WHEN predicted_minutes <= 1440 THEN 'Medium' WHEN predicted_minutes IS NOT NULL THEN 'Low' END"""
ACTION = """CASE risk_band
  WHEN 'Critical' THEN 'swap unit within ' || floor(predicted_minutes)::BIGINT || ' minutes'
  WHEN 'High' THEN 'schedule at next terminal within ' || floor(predicted_minutes)::BIGINT || ' minutes'
  WHEN 'Medium' THEN 'plan within ' || floor(predicted_minutes)::BIGINT || ' minutes'
  WHEN 'Low' THEN 'monitor' END"""
STATUS_COLUMNS = ["unit_id", "timestamp_bin", "predicted_minutes", "risk_band", "action"]


def _predicted(spark, sf_dir):
    """Hourly bins per unit with the life a life table predicts for them."""
    return rounded(_predicted_whole(spark, sf_dir))


def _predicted_whole(spark, sf_dir):
    """The same before rounding, for results that go on from it: a mean of rounded values would be rounded twice."""
    rows = stage(unit_bins_view(spark, sf_dir), "unit-life")
    return rul.predict_life(rows, rul.life_table(rows))


@entry("survival_curve", UNIT_LIFE + f"""
SELECT age::BIGINT AS age, {q6('seen')} AS seen, failures, at_risk::BIGINT AS at_risk, {q6('alive')} AS alive FROM survival""")
def survival_curve(spark, sf_dir):
    """Share of units still running by time, for every age."""
    return rounded(rul.survival_steps(stage(unit_bins_view(spark, sf_dir), "unit-life")))


@entry("risk_bands", UNIT_LIFE + f"""
SELECT unit_id, timestamp_bin, {q6('predicted_minutes')} AS predicted_minutes, risk_band, {ACTION} AS action
FROM (SELECT *, {BAND} AS risk_band FROM predicted)""")
def risk_bands(spark, sf_dir):
    return kpi.add_risk(_predicted(spark, sf_dir), "predicted_minutes").select(*STATUS_COLUMNS)


LATEST = f"""
SELECT unit_id, timestamp_bin, {q6('predicted_minutes')} AS predicted_minutes, risk_band, {ACTION} AS action FROM (
  SELECT *, {BAND} AS risk_band FROM (
    SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY timestamp_bin DESC) AS rn FROM predicted) WHERE rn = 1)"""


@entry("latest_status", UNIT_LIFE + LATEST)
def latest_status(spark, sf_dir):
    return kpi.status_board(_predicted(spark, sf_dir)).select(*STATUS_COLUMNS)


@entry("worklist", UNIT_LIFE + f"SELECT * FROM ({LATEST}) WHERE risk_band IN ('Critical', 'High')")
def worklist(spark, sf_dir):
    return kpi.worklist(_predicted(spark, sf_dir)).select(*STATUS_COLUMNS)


@entry("alert_history", UNIT_LIFE + f"""
SELECT unit_id, timestamp_bin, failure FROM life
WHERE unit_id IN (SELECT unit_id FROM ({LATEST}) WHERE risk_band IN ('Critical', 'High'))""")
def alert_history(spark, sf_dir):
    rows = _predicted(spark, sf_dir)
    return kpi.unit_history(rows, kpi.worklist(rows)).select("unit_id", "timestamp_bin", "failure")


EPISODES = """
marks AS (
  SELECT *, CASE WHEN failure = 1 AND coalesce(lag(failure) OVER (PARTITION BY unit_id ORDER BY timestamp_bin), 0) <> 1
                 THEN 1 ELSE 0 END AS starts FROM bins
),
episodes AS (
  SELECT unit_id, episode, min(timestamp_bin) AS start_time, max(timestamp_bin) AS end_time, count(*) AS bins
  FROM (SELECT *, CAST(sum(starts) OVER (PARTITION BY unit_id ORDER BY timestamp_bin) AS BIGINT) AS episode FROM marks)
  WHERE failure = 1 GROUP BY unit_id, episode
)"""


@entry("failure_episodes", with_(SENSOR, bins_sql(60, True), EPISODES) + "SELECT * FROM episodes")
def failure_episodes(spark, sf_dir):
    return rul.failure_episodes(binned_log(sensor_view(spark, sf_dir), 60, ["unit_id"]), ["unit_id"])


MTBF = with_(SENSOR, bins_sql(60, True), EPISODES, """
rel AS (
  SELECT h.unit_id, h.operating_hours, coalesce(e.n, 0) AS failures,
         CASE WHEN e.n > 0 THEN h.operating_hours / e.n END AS mtbf_hours,
         coalesce(e.n, 0) * 1000.0 / h.operating_hours AS failures_per_1000h
  FROM (SELECT unit_id, count(*) * 1e0 AS operating_hours FROM bins GROUP BY 1) h
  LEFT JOIN (SELECT unit_id, count(*) AS n FROM episodes GROUP BY 1) e ON h.unit_id = e.unit_id
)""")


@entry("mtbf", MTBF + f"""
SELECT unit_id, {q6('operating_hours')} AS operating_hours, failures, {q6('mtbf_hours')} AS mtbf_hours,
       {q6('failures_per_1000h')} AS failures_per_1000h FROM rel""")
def mtbf(spark, sf_dir):
    return rounded(kpi.reliability(binned_log(sensor_view(spark, sf_dir), 60, ["unit_id"]), 60))


SPLIT = "2024-01-16"
RATIO = "(failures_after / hours_after) / (failures_before / hours_before)"
REACH = "exp(1.959964e0 * sqrt(1e0 / failures_before + 1e0 / failures_after))"
KNOWN = "failures_before > 0 AND failures_after > 0 AND hours_before > 0 AND hours_after > 0"


@entry("failure_rate_change", with_(SENSOR, bins_sql(60, True), EPISODES, f"""
sides AS (
  SELECT unit_id % 5 AS unit_group, timestamp_bin >= TIMESTAMP '{SPLIT}' AS after, 1e0 AS hours, 0 AS runs FROM bins
  UNION ALL SELECT unit_id % 5, start_time >= TIMESTAMP '{SPLIT}', 0e0, 1 FROM episodes
),
both_sides AS (
  SELECT unit_group, sum(runs) FILTER (NOT after) AS failures_before, sum(runs) FILTER (after) AS failures_after,
         sum(hours) FILTER (NOT after) AS hours_before, sum(hours) FILTER (after) AS hours_after FROM sides GROUP BY 1
)""") + f"""
SELECT unit_group, coalesce(failures_before, 0)::BIGINT AS failures_before, coalesce(failures_after, 0)::BIGINT AS failures_after,
       {q6('coalesce(hours_before, 0)')} AS hours_before, {q6('coalesce(hours_after, 0)')} AS hours_after,
       {q6(f'CASE WHEN {KNOWN} THEN {RATIO} END')} AS rate_ratio, {q6(f'CASE WHEN {KNOWN} THEN {RATIO} / {REACH} END')} AS ratio_low,
       {q6(f'CASE WHEN {KNOWN} THEN {RATIO} * {REACH} END')} AS ratio_high FROM both_sides""")
def failure_rate_change(spark, sf_dir):
    """Failure rates before and after a date, by unit group, with 95 % limits of their ratio."""
    binned = binned_log(sensor_view(spark, sf_dir), 60, ["unit_id"])
    return rounded(kpi.rate_change(stage(binned, "unit-bins"), 60, SPLIT, F.col("unit_id") % 5))


@entry("roi", MTBF + f"SELECT unit_id, {q6('failures * (500e0 + 1500e0) - 250e0')} AS savings FROM rel")
def roi(spark, sf_dir):
    """Savings per unit if each of its failures had been avoided."""
    table = kpi.reliability(binned_log(sensor_view(spark, sf_dir), 60, ["unit_id"]), 60)
    return table.select("unit_id", r6(kpi.savings(F.col("failures"), 500.0, 1500.0, 250.0)).alias("savings"))


@entry("fleet_heatmap", UNIT_LIFE + f"""
SELECT unit_id, CAST(timestamp_bin AS DATE) AS day, {q6('min(predicted_minutes)')} AS min_rul, {q6('avg(predicted_minutes)')} AS avg_rul
FROM predicted GROUP BY 1, 2""")
def fleet_heatmap(spark, sf_dir):
    return rounded(eda.unit_heatmap(_predicted_whole(spark, sf_dir), rul="predicted_minutes"))


# ---- streams -----------------------------------------------------------------

def _stream(spark, sf_dir):
    """`events` as a stream of readings, by the same projection as the batch view."""
    folder = spark.read.parquet(f"{sf_dir}/events.parquet")
    events = live.read_stream(spark, folder, sf_dir, "events.parquet")
    return sensor_view(spark, sf_dir, events)


FINISHED = with_(SENSOR, bins_sql(60, True), """
finished AS (
  SELECT * FROM bins WHERE timestamp_bin + INTERVAL 60 minutes
    <= (SELECT date_trunc('second', max("timestamp")) FROM placed) - INTERVAL 10 minutes
)""")


@entry("stream_bins", FINISHED + "SELECT unit_id, timestamp_bin, failure, COMP_flag, MPG_flag, LPS_flag, "
       + ", ".join(f"{q6(f'{c}_{s}')} AS {c}_{s}" for c in SIGNALS for s in ("avg", "std", "min", "max"))
       + " FROM finished")
def stream_bins(spark, sf_dir):
    return rounded(live.run_fresh(live.live_bins(_stream(spark, sf_dir), 60), "live-bins"))


@entry("stream_last_failure", FINISHED + f"""
SELECT unit_id, timestamp_bin, failure, {q6('''epoch(timestamp_bin - max(CASE WHEN failure = 1 THEN timestamp_bin END)
  OVER (PARTITION BY unit_id ORDER BY timestamp_bin)) / 60.0''')} AS minutes_since_last_failure FROM finished""")
def stream_last_failure(spark, sf_dir):
    table, path = _live_bin_table(spark, sf_dir)
    bins_stream = live.read_stream(spark, table, path)
    return rounded(live.run_fresh(live.live_since_failure(bins_stream), "live-since"))


def _live_bin_table(spark, sf_dir):
    path = new_path(spark, "live-bins")
    stream = live.live_bins(_stream(spark, sf_dir), 60)
    live.run_to_table(stream, path, new_path(spark, "live-bins-progress"))
    return spark.read.schema(stream.schema).parquet(path), path


SCORED = [f"{c}_avg" for c in SIGNALS] + [f"{c}_avg_{k}" for c in SIGNALS for k in ("roll_mean_60m", "roll_std_60m", "lag1", "delta")]


def _scored_sql() -> str:
    frame = "(PARTITION BY unit_id ORDER BY timestamp_bin ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
    order = "(PARTITION BY unit_id ORDER BY timestamp_bin)"
    cols = [f"{q6(f'{c}_avg')} AS {c}_avg" for c in SIGNALS]
    for c in SIGNALS:
        b = f"{c}_avg"
        cols += [f"{q6(f'coalesce(avg({b}) OVER {frame}, 0)')} AS {b}_roll_mean_60m",
                 f"{q6(f'coalesce(stddev_samp({b}) OVER {frame}, 0)')} AS {b}_roll_std_60m",
                 f"{q6(f'coalesce(lag({b}) OVER {order}, 0)')} AS {b}_lag1",
                 f"{q6(f'coalesce({b} - lag({b}) OVER {order}, 0)')} AS {b}_delta"]
    return f"SELECT unit_id, timestamp_bin, {', '.join(cols)}, true AS is_finite FROM finished"


@entry("stream_scoring")
def stream_scoring(spark, sf_dir):
    """Features of live bins over two batches, scored with a model trained on the batch table of the same units."""
    from ..operators import models, prep

    batch = stage(clean.only_defined(rul_features(sensor_view(spark, sf_dir), 60, 60, ["unit_id"], rows_back=3)), "train")
    split = batch.withColumn("split", F.lit("train"))
    fills = prep.train_medians(split, SCORED).first().asDict()
    # Remembered node ids save walking every tree from its root at every level; the trees are the same.
    model = models.fit(prep.impute(models.evenly(batch), SCORED, fills), SCORED, models.forest(cacheNodeIds=True))
    table, path = _live_bin_table(spark, sf_dir)
    out = new_path(spark, "live-scores")
    halves = new_path(spark, "live-halves")
    middle = table.agg(F.expr("percentile_approx(timestamp_bin, 0.5)")).first()[0]
    for part in (table.filter(F.col("timestamp_bin") < F.lit(middle)), table.filter(F.col("timestamp_bin") >= F.lit(middle))):
        part.write.mode("append").parquet(halves)
        live.score_bins(live.read_stream(spark, table, halves), model, SCORED, out, f"{halves}-progress", fills,
                        rows_back=3, roll_minutes=60)
    return spark.read.parquet(out).select("unit_id", "timestamp_bin", *SCORED, "y_pred")


@entry("stream_scoring_check", FINISHED + _scored_sql())
def stream_scoring_check(spark, sf_dir):
    scored = stream_scoring(spark, sf_dir)
    finite = ~F.isnan("y_pred") & F.col("y_pred").isNotNull()
    return rounded(scored.select("unit_id", "timestamp_bin", *SCORED, finite.alias("is_finite")))


@entry("table_write", with_(SENSOR) + "SELECT unit_id, count(*) AS n FROM sensor GROUP BY 1")
def table_write(spark, sf_dir):
    path = new_path(spark, "by-unit")
    counts = sensor_view(spark, sf_dir).groupBy("unit_id").agg(F.count(F.lit(1)).alias("n"))
    write_table(counts, path)
    return read_table(spark, path)
