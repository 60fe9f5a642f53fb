"""The driver's tables seen as a sensor log and its context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sensor_view(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """`events` (a table or a stream) as readings; signals it has no counterpart for stay absent."""
    if events is None:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    has_gps = F.col("event_id") % 50 != 7
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("unit_id"),
        F.col("value").alias("Motor_current"),
        k.cast("double").alias("Oil_temperature"),
        (F.col("value") * F.lit(0.5) - k * F.lit(0.25)).alias("DV_pressure"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("COMP"),
        F.when(k < 50, 0).otherwise(1).alias("MPG"),
        F.when(F.col("event_id") % 5 == 0, 0).otherwise(1).alias("LPS"),
        F.when(has_gps, F.lit(41.1) + F.lit(0.013) * (F.col("user_id") % 7)).alias("gpsLat"),
        F.when(has_gps, F.lit(-8.6) - F.lit(0.013) * (F.col("user_id") % 5)).alias("gpsLong"),
    )


def context_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as weather by cell: (cell_id, ts, temp)."""
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    hours = (F.col("o_orderkey") % 30) * 24 + F.col("o_custkey") % 24
    return (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .groupBy((F.col("o_custkey") % 7).alias("cell_id"), F.timestamp_add("HOUR", hours, start).alias("ts"))
        .agg(F.max("o_totalprice").alias("temp"))
    )


def stations_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`supplier` as weather stations around the readings' area: (station_id, lat, lon)."""
    key = F.col("s_suppkey")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        key.alias("station_id"),
        (F.lit(41.0) + F.lit(0.00131) * (key * 31 % 173)).alias("lat"),
        (F.lit(-8.75) + F.lit(0.00173) * (key * 57 % 131)).alias("lon"),
    )


def station_context_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as weather by station: (station_id, ts, temp)."""
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    hours = (F.col("o_orderkey") % 30) * 24 + F.col("o_custkey") % 24
    return (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .groupBy((F.col("o_custkey") % 20).alias("station_id"), F.timestamp_add("HOUR", hours, start).alias("ts"))
        .agg(F.max("o_totalprice").alias("temp"))
    )


def full_sensor_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sensor_view` with a value for every other signal of the log, some of them missing at times."""
    key, value, k = F.col("reading_id"), F.col("Motor_current"), F.col("Oil_temperature")
    return sensor_view(spark, sf_dir).withColumns({
        "TP2": value * 0.25 + k, "TP3": value - k * 0.5, "H1": k * 0.125,
        "Reservoirs": F.when(key % 11 != 3, value * 2.0), "Flowmeter": (key % 97) * F.lit(0.5),
        "Caudal_impulses": (key % 13).cast("double"), "gpsSpeed": F.when(key % 50 != 7, (F.col("unit_id") % 50) * F.lit(1.5)),
        "Pressure_switch": (key % 3 == 0).cast("int"), "DV_eletric": (k % 2).cast("int"),
        "Towers": (value > 50).cast("int"), "Oil_level": F.when(key % 4 != 1, (key % 7 == 0).cast("int")),
        "gpsQuality": (key % 50 != 7).cast("int"),
    })
