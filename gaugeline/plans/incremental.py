"""Feature table kept up to date day by day.

    python -m gaugeline.plans.incremental --input log.csv --target store --day 2024-01-10

The store holds three tables in one folder per day: `bins`, `features`, and `days`, which has one row per
series and day with its number of bins and its first and last failure. From `days` alone follows what a
changed day changes elsewhere, so only those days are computed and only their folders are replaced.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timebins import parse_time
from ..operators.bins import bin_readings
from ..operators.clean import prepare_readings
from ..operators.features import frame_rows, rolling_features
from ..operators.rul import add_rul
from ..session import build_session, stage
from ..sources import read_table
from .etl import FAILURE_COLUMNS

DAY, TS = "bin_date", "timestamp_bin"


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table as stored, or an empty one before the first run."""
    try:
        return spark.read.parquet(path).select(*like.columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def _replace_days(df: DataFrame, path: str) -> None:
    """Replace the folders of the days in `df`, and no others."""
    (df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))


def day_rows(bins: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(parts, day, rows, first and last failure): one row per series and day."""
    failing = F.when(F.col("failure") == 1, F.col(TS))
    return bins.groupBy(*parts, DAY).agg(
        F.count(F.lit(1)).alias("rows"), F.min(failing).alias("first_failure"), F.max(failing).alias("last_failure"))


def _series(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """A struct is never NULL itself, so a series whose key holds NULLs still joins."""
    return df.withColumn("_series", F.struct(*[F.col(p) for p in parts], F.lit(0).alias("_all")))


def _carried(days: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(series, day, before, last, next): bins before the day, last failure before it, first one after it."""
    earlier = Window.partitionBy("_series").orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("_series").orderBy(F.desc(DAY)).rowsBetween(Window.unboundedPreceding, -1)
    return _series(days, parts).select(
        "_series", DAY, "rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.max("last_failure").over(earlier).alias("last"), F.min("first_failure").over(later).alias("next"))


def _dates(df: DataFrame) -> list[date]:
    """The days as a list: at most one entry for each folder of the table."""
    return sorted(r[0] for r in df.select(DAY).distinct().collect())


def _one_of(days: Sequence[date]) -> Column:
    return F.col(DAY).isin(list(days)) if days else F.lit(False)


def changed_days(old: DataFrame, new: DataFrame, touched: Sequence[date], back: int) -> list[date]:
    """Days with other features than before, from the carried values of both states.

    These are the touched days, days for which some series has another last failure before or first failure
    after them, and days with fewer than `back` bins between them and a touched day before them.
    """
    keys = ["_series", DAY]
    was = old.select(*keys, F.struct("last", "next").alias("_was"))
    both = new.select(*keys, "rows", F.struct("last", "next").alias("_is")).join(was, keys, "full")
    upto = Window.partitionBy("_series").orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    rows = both.withColumn("rows", F.coalesce("rows", F.lit(0))).withColumn("_touched", _one_of(touched))
    placed = rows.withColumn("_end", F.sum("rows").over(Window.partitionBy("_series").orderBy(DAY)))
    near = F.col("_end") - F.col("rows") - F.max(F.when(F.col("_touched"), F.col("_end"))).over(upto) < back
    hit = placed.withColumn("_near", F.coalesce(near, F.lit(False)))
    moved = ~F.col("_is").eqNullSafe(F.col("_was"))
    # A day all of whose rows have gone from a series has no features to write for it.
    return sorted({*touched, *_dates(hit.filter((F.col("rows") > 0) & (F.col("_near") | moved)))})


def needed_days(new: DataFrame, changed: Sequence[date], back: int) -> list[date]:
    """The changed days and those that hold some of the `back` bins before a changed day of some series."""
    onward = Window.partitionBy("_series").orderBy(F.desc(DAY)).rowsBetween(Window.unboundedPreceding, -1)
    start = F.min(F.when(_one_of(changed), F.col("before"))).over(onward)
    near = new.withColumn("_gap", start - F.col("before") - F.col("rows")).filter(F.col("_gap") < back)
    return sorted({*changed, *_dates(near)})


def update_features(
    readings: DataFrame, target: str, bin_minutes: int = 2, roll_minutes: int = 30, parts: Sequence[str] = (),
    require_gps: bool = True, rows_back: int | None = None, rul_cap: float | None = None,
) -> list[date]:
    """Bring the store up to date with `readings` and return the days whose features were written.

    `readings` must hold every reading of each day it touches; those days are replaced, others stay. The result
    equals `etl.rul_features` over everything ever given, so the settings must be the same on every call. Readings
    without a time belong to no day and are left out. Features are written first and `days` last: a job that
    dies in between is simply run again with the same readings.
    """
    spark = readings.sparkSession
    back = frame_rows(roll_minutes, bin_minutes) if rows_back is None else rows_back
    made = bin_readings(prepare_readings(readings, require_gps), bin_minutes, parts)
    fresh = stage(made.filter(F.col(TS).isNotNull()).withColumn(DAY, F.to_date(TS)), "fresh-bins")
    fresh_days = stage(day_rows(fresh, parts), "fresh-days")
    touched = _dates(fresh_days)
    if not touched:
        return []
    old_days = _stored(spark, f"{target}/days", fresh_days)
    old = _carried(old_days, parts)
    new = stage(_carried(old_days.filter(~_one_of(touched)).unionByName(fresh_days), parts), "carried")
    changed = changed_days(old, new, touched, back)
    needed = needed_days(new, changed, back)

    kept = _stored(spark, f"{target}/bins", fresh).filter(_one_of(sorted({*needed} - {*touched})))
    bins = _series(kept.unionByName(fresh), parts)
    inside = Window.partitionBy("_series", DAY).orderBy(TS)
    onward = Window.partitionBy("_series", DAY).orderBy(F.desc(TS)).rowsBetween(Window.unboundedPreceding, 0)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    failing = F.when(F.col("failure") == 1, F.col(TS))
    local = bins.select(
        "*", F.row_number().over(inside).alias("_row"), F.max(failing).over(upto).alias("_in_last"),
        F.min(failing).over(onward).alias("_in_next"))
    timed = local.join(new.drop("rows"), ["_series", DAY]).select(
        *fresh.columns, (F.col("before") + F.col("_row") - 1).alias("pos"),
        F.coalesce("_in_next", "next").alias("next_failure_time"), F.coalesce("_in_last", "last").alias("last_failure_time"))
    rolled = rolling_features(timed, back, roll_minutes, parts).filter(_one_of(changed))
    full = add_rul(rolled, cap_minutes=rul_cap)
    lead = [c for c in full.columns if c not in (*FAILURE_COLUMNS, "pos", DAY)]
    _replace_days(full.select(*lead, *FAILURE_COLUMNS, DAY), f"{target}/features")
    _replace_days(fresh, f"{target}/bins")
    _replace_days(fresh_days, f"{target}/days")
    return changed


def read_store(spark: SparkSession, target: str) -> DataFrame:
    """The feature table of a store."""
    return spark.read.parquet(f"{target}/features").drop(DAY)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Renew days of a feature store from the sensor log")
    parser.add_argument("--input", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--day", action="append", default=[], help="day to renew, may be repeated; all days without it")
    parser.add_argument("--bin-minutes", type=int, default=2)
    parser.add_argument("--roll-minutes", type=int, default=30)
    parser.add_argument("--unit-column", default=None)
    args = parser.parse_args(argv)
    readings = parse_time(read_table(build_session(), args.input))
    if args.day:
        readings = readings.filter(F.to_date("timestamp").isin([date.fromisoformat(d) for d in args.day]))
    parts = [args.unit_column] if args.unit_column else []
    written = update_features(readings, args.target, args.bin_minutes, args.roll_minutes, parts)
    print(f"{len(written)} days written: {', '.join(map(str, written))}")


if __name__ == "__main__":
    main()
