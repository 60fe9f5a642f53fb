"""Time buckets and differences.

All of it works on wall-clock seconds, so `timestamp_ntz` columns give the
same answer in every session time zone.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_SECONDS = 86400
# A chunk id below every real day, for rows whose time could not be read.
NO_DAY = -(2**31)


def parse_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Bring a string or zoned column to `timestamp_ntz`; unreadable text becomes NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return df
    value = F.col(column)
    if isinstance(kind, T.StringType):
        value = F.try_to_timestamp(value)
    return df.withColumn(column, value.cast("timestamp_ntz"))


def at_second(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def bucket_second(ts: Column | str, width: int) -> Column:
    """Start second of the bucket holding `ts`; floors before 1970 too."""
    seconds = F.unix_timestamp(ts)
    return seconds - F.pmod(seconds, F.lit(width))


def time_bin(ts: Column | str, minutes: int = 2) -> Column:
    return at_second(bucket_second(ts, minutes * 60))


def hour_bucket(ts: Column | str) -> Column:
    return time_bin(ts, 60)


def day_chunk(ts: Column | str) -> Column:
    """Day number, never NULL, increasing with `ts` under nulls-first order."""
    day = F.floor(bucket_second(ts, DAY_SECONDS) / DAY_SECONDS)
    return F.coalesce(day, F.lit(NO_DAY)).cast("bigint")


def minute_of_day(ts: Column | str) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def add_time_of_day(df: DataFrame, ts_col: str = "timestamp_bin") -> DataFrame:
    """Cyclic `tod_sin`, `tod_cos`; left out with a warning if the column is unusable."""
    kind = df.schema[ts_col].dataType if ts_col in df.columns else None
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        warnings.warn(f"no timestamp column '{ts_col}'; time-of-day features left out", stacklevel=2)
        return df
    angle = minute_of_day(ts_col) * F.lit(2 * math.pi) / F.lit(1440.0)
    return df.select("*", F.sin(angle).alias("tod_sin"), F.cos(angle).alias("tod_cos"))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(3600.0)
