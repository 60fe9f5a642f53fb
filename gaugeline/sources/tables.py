"""Readers and writers. Paths are Hadoop paths, so s3a:// and hdfs:// work alike."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SENSOR_SCHEMA


def read_sensor_csv(
    spark: SparkSession, path: str, infer: bool = False, schema: T.StructType | None = None,
) -> DataFrame:
    """CSV log with a header.

    The given schema is cut down to the columns the file has (by its header),
    so absent signals stay absent and no inference pass is spent. `infer=True`
    reads the data twice to guess types.
    """
    if infer:
        return spark.read.csv(path, header=True, inferSchema=True)
    known = {f.name: f for f in (schema or SENSOR_SCHEMA).fields}
    header = spark.read.csv(path, header=True, enforceSchema=False).columns
    fields = [known.get(c, T.StructField(c, T.StringType())) for c in header]
    return spark.read.csv(path, header=True, schema=T.StructType(fields))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Suffix decides: `.csv` is CSV, anything else parquet.

    A CSV with columns of its own (a feature table) has its types inferred; a raw log does not need that.
    """
    if path.lower().endswith(".csv"):
        known = {f.name for f in SENSOR_SCHEMA.fields}
        header = spark.read.csv(path, header=True, enforceSchema=False).columns
        return read_sensor_csv(spark, path, infer=not known.issuperset(header))
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(path)


def write_features(df: DataFrame, path: str, ts_col: str = "timestamp_bin") -> None:
    """Feature table in one folder per day, so that time filters prune files.

    The rebalance hint lets AQE merge small days and split big ones.
    """
    write_table(df.withColumn("bin_date", F.to_date(ts_col)), path, ["bin_date"])


def read_features(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None,
) -> DataFrame:
    """Read `write_features` output; the day limits select folders before any scan."""
    df = spark.read.parquet(path)
    if "bin_date" not in df.columns:
        return df
    if first_day is not None:
        df = df.filter(F.col("bin_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.filter(F.col("bin_date") <= F.lit(last_day).cast("date"))
    return df.drop("bin_date")


def write_report(df: DataFrame, folder: str, name: str, stamped: bool = True) -> str:
    """Small report as CSV with header; the UTC time goes into the path."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = posixpath.join(folder, f"{name}_{stamp}" if stamped else name)
    df.write.mode("overwrite").csv(path, header=True)
    return path


def save_record(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """One JSON artifact (feature list, medians, cut, metrics) as a one-line text table."""
    spark.createDataFrame([(json.dumps(record),)], "value string").write.mode("overwrite").text(path)


def load_record(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])


def save_split(df: DataFrame, path: str, keys: Sequence[str] = ("pos", "split")) -> None:
    """Row positions with their side of the split."""
    df.select(*keys).write.mode("overwrite").parquet(path)


def load_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
