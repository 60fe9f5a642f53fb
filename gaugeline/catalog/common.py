"""Pieces shared by the registered queries and their SQL twins.

Doubles are rounded on both sides after a tiny shift: sums may differ in their
last digits between engines, and the shift keeps exact halves off the rounding edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import medians
from ..functions.timebins import day_chunk
from ..operators.clean import only_defined
from ..operators.ordered import running, with_halo
from ..plans.etl import labelled_bins, rul_features
from ..plans.hourly import hourly_failure
from ..session import stage
from ..sources.fixtures import sensor_view

SHIFT = 3e-9


def r6(c: Column | str) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value + F.lit(SHIFT), 6)


def rounded(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[
        f"round(`{f.name}` + {SHIFT!r}D, 6) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
        for f in df.schema.fields
    ])


def q6(expr: str) -> str:
    return f"(round({expr} + 3e-9, 6) + 0e0)"


def features_view(spark: SparkSession, sf_dir: str, staged: bool = True) -> DataFrame:
    """The global feature table, rounded; written once where several passes read it."""
    table = rounded(rul_features(sensor_view(spark, sf_dir)))
    return stage(table, "features") if staged else table


def hourly_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics by place with the hour's failure label, rounded, written once."""
    return stage(rounded(hourly_failure(sensor_view(spark, sf_dir))), "hourly")


def unit_bins_view(spark: SparkSession, sf_dir: str, bin_minutes: int = 60) -> DataFrame:
    """Hourly bins per unit with remaining life."""
    return labelled_bins(sensor_view(spark, sf_dir), bin_minutes, ["unit_id"])


def pairs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic predictions: `lag` repeats the previous bin's life, `const` the overall median."""
    labelled = only_defined(labelled_bins(sensor_view(spark, sf_dir)))
    life = running(labelled.select("timestamp_bin", "RUL_minutes"), "timestamp_bin",
                   day_chunk("timestamp_bin"), position="key")
    life = stage(life, "life")
    lagged = with_halo(life, "key", 1, lambda w: [F.lag("RUL_minutes", 1).over(w).alias("y_pred")])
    middle = medians(life, ["RUL_minutes"]).first()["RUL_minutes"]
    columns = ["model", "key", F.col("RUL_minutes").alias("y_true"), "y_pred"]
    lag = lagged.withColumn("model", F.lit("lag")).select(*columns)
    const = life.withColumn("model", F.lit("const")).withColumn("y_pred", F.lit(middle)).select(*columns)
    return lag.unionByName(const)


# ---- SQL twins -----------------------------------------------------------------

SIGNALS = ["Motor_current", "Oil_temperature", "DV_pressure"]
FLAGS = ["COMP", "MPG", "LPS"]

SENSOR = """
sensor AS (
  SELECT event_id AS reading_id, ts AS "timestamp", user_id AS unit_id,
         value AS Motor_current, k::DOUBLE AS Oil_temperature,
         value * 0.5::DOUBLE - k * 0.25::DOUBLE AS DV_pressure,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS COMP,
         CASE WHEN k < 50 THEN 0 ELSE 1 END AS MPG,
         CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS LPS,
         CASE WHEN event_id % 50 <> 7 THEN 41.1::DOUBLE + 0.013::DOUBLE * (user_id % 7) END AS gpsLat,
         CASE WHEN event_id % 50 <> 7 THEN (-8.6)::DOUBLE - 0.013::DOUBLE * (user_id % 5) END AS gpsLong
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
flagged AS (
  SELECT *, CASE WHEN COMP = 0 AND MPG = 0 AND LPS = 0 THEN 1 ELSE 0 END AS failure_raw FROM sensor
),
placed AS (SELECT * FROM flagged WHERE gpsLat IS NOT NULL AND gpsLong IS NOT NULL)"""


FULL_SENSOR = """
full_log AS (
  SELECT *, Motor_current * 0.25::DOUBLE + Oil_temperature AS TP2, Motor_current - Oil_temperature * 0.5::DOUBLE AS TP3,
    Oil_temperature * 0.125::DOUBLE AS H1, CASE WHEN reading_id % 11 <> 3 THEN Motor_current * 2::DOUBLE END AS Reservoirs,
    (reading_id % 97) * 0.5::DOUBLE AS Flowmeter, (reading_id % 13)::DOUBLE AS Caudal_impulses,
    CASE WHEN reading_id % 50 <> 7 THEN (unit_id % 50) * 1.5::DOUBLE END AS gpsSpeed,
    (reading_id % 3 = 0)::INTEGER AS Pressure_switch, (Oil_temperature % 2)::INTEGER AS DV_eletric,
    (Motor_current > 50)::INTEGER AS Towers,
    CASE WHEN reading_id % 4 <> 1 THEN (reading_id % 7 = 0)::INTEGER END AS Oil_level,
    (reading_id % 50 <> 7)::INTEGER AS gpsQuality
  FROM flagged
)"""


def bins_sql(minutes: int = 2, by_unit: bool = False, source: str = "placed") -> str:
    unit = "unit_id, " if by_unit else ""
    stats = ", ".join(
        f"avg({c}) AS {c}_avg, stddev_samp({c}) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max"
        for c in SIGNALS
    )
    flags = ", ".join(f"max({c}) AS {c}_flag" for c in FLAGS)
    return f"""
bins AS (
  SELECT {unit}time_bucket(INTERVAL '{minutes} minutes', "timestamp") AS timestamp_bin,
         {stats}, {flags}, max(failure_raw) AS failure
  FROM {source} GROUP BY ALL
)"""


def rul_sql(by_unit: bool = False, cap: float | None = None) -> str:
    part = "PARTITION BY unit_id " if by_unit else ""
    life = """CASE WHEN failure = 1 THEN 0e0
              ELSE epoch(next_failure_time - timestamp_bin) / 60.0 END"""
    if cap is not None:
        life = f"CASE WHEN ({life}) IS NOT NULL THEN least({life}, {cap}e0) END"
    return f"""
timed AS (
  SELECT *,
    min(CASE WHEN failure = 1 THEN timestamp_bin END) OVER (
      {part}ORDER BY timestamp_bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_failure_time,
    max(CASE WHEN failure = 1 THEN timestamp_bin END) OVER (
      {part}ORDER BY timestamp_bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_failure_time
  FROM bins
),
life AS (
  SELECT *, {life} AS RUL_minutes,
         epoch(timestamp_bin - last_failure_time) / 60.0 AS minutes_since_last_failure
  FROM timed
)"""


def rolled_names(roll: int = 30) -> list[str]:
    return [f"{c}_avg_{k}" for c in SIGNALS
            for k in (f"roll_mean_{roll}m", f"roll_std_{roll}m", "lag1", "delta")]


def features_sql(by_unit: bool = False, rows_back: int = 14, roll: int = 30) -> str:
    """CTE `feat`: the rounded feature table."""
    part = "PARTITION BY unit_id " if by_unit else ""
    frame = f"({part}ORDER BY timestamp_bin ROWS BETWEEN {rows_back} PRECEDING AND 1 PRECEDING)"
    order = f"({part}ORDER BY timestamp_bin)"
    cols = []
    for c in SIGNALS:
        cols += [f"{q6(f'{c}_{s}')} AS {c}_{s}" for s in ("avg", "std", "min", "max")]
    cols += [f"{c}_flag" for c in FLAGS] + ["failure"]
    for c in SIGNALS:
        b = f"{c}_avg"
        cols += [
            f"{q6(f'coalesce(avg({b}) OVER {frame}, 0)')} AS {b}_roll_mean_{roll}m",
            f"{q6(f'coalesce(stddev_samp({b}) OVER {frame}, 0)')} AS {b}_roll_std_{roll}m",
            f"{q6(f'coalesce(lag({b}) OVER {order}, 0)')} AS {b}_lag1",
            f"{q6(f'coalesce({b} - lag({b}) OVER {order}, 0)')} AS {b}_delta",
        ]
    lead = "unit_id, " if by_unit else ""
    return f"""
feat AS (
  SELECT {lead}timestamp_bin, {', '.join(cols)}, next_failure_time, last_failure_time,
         {q6('RUL_minutes')} AS RUL_minutes,
         {q6('minutes_since_last_failure')} AS minutes_since_last_failure
  FROM life
)"""


HOURLY_STATS = """avg(DV_pressure) AS DV_pressure_avg, avg(Oil_temperature) AS Oil_temp_avg,
         avg(Motor_current) AS Motor_current_avg, max(Motor_current) AS Motor_current_max,
         min(Motor_current) AS Motor_current_min"""
HOURLY_COLUMNS = ["DV_pressure_avg", "Oil_temp_avg", "Motor_current_avg", "Motor_current_max", "Motor_current_min"]
HOURLY_ROUNDED = ", ".join(f"{q6(c)} AS {c}" for c in HOURLY_COLUMNS)

HOURLY = f"""
hourly AS (
  SELECT date_trunc('hour', "timestamp") AS timestamp_hour, round(gpsLat, 2) AS lat_rounded,
         round(gpsLong, 2) AS lon_rounded, {HOURLY_STATS}
  FROM placed GROUP BY 1, 2, 3
),
hour_failures AS (
  SELECT date_trunc('hour', "timestamp") AS timestamp_hour, max(failure_raw) AS failure
  FROM flagged GROUP BY 1
),
hf AS (
  SELECT h.timestamp_hour, lat_rounded, lon_rounded, {HOURLY_ROUNDED}, f.failure
  FROM hourly h LEFT JOIN hour_failures f ON h.timestamp_hour = f.timestamp_hour
)"""

PAIRS = f"""
{SENSOR},{bins_sql()},{rul_sql()},
ordered AS (
  SELECT row_number() OVER (ORDER BY timestamp_bin) - 1 AS key, RUL_minutes FROM life WHERE RUL_minutes IS NOT NULL
),
pairs AS (
  SELECT 'lag' AS model, key, RUL_minutes AS y_true, lag(RUL_minutes) OVER (ORDER BY key) AS y_pred FROM ordered
  UNION ALL
  SELECT 'const', key, RUL_minutes, (SELECT quantile_cont(RUL_minutes, 0.5) FROM ordered) FROM ordered
),
good AS (
  SELECT *, y_pred - y_true AS err, abs(y_pred - y_true) AS ae FROM pairs
  WHERE y_true IS NOT NULL AND y_pred IS NOT NULL AND isfinite(y_true) AND isfinite(y_pred)
)"""

CONTEXT = """
context AS (
  SELECT o_custkey % 7 AS cell_id,
         TIMESTAMP '2024-01-01' + to_hours(((o_orderkey % 30) * 24 + o_custkey % 24)::BIGINT) AS ts,
         max(o_totalprice) AS temp
  FROM orders GROUP BY 1, 2
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
