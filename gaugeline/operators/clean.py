"""Row-level cleaning: flags, filters, fills, samples. All narrow, no shuffle."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import finite_sql
from ..functions.timebins import parse_time
from ..schema import FAILURE_SIGNALS, GPS_COLUMNS, require_columns


def flag_failures(df: DataFrame, out: str = "failure_raw") -> DataFrame:
    """1 where the compressor, pressure-gauge and low-pressure signals are all 0, else 0.

    A NULL signal is not a failure; a missing signal column gives 0 everywhere.
    """
    absent = [c for c in FAILURE_SIGNALS if c not in df.columns]
    if absent:
        warnings.warn(f"no column {', '.join(absent)}; no row is flagged as failure", stacklevel=2)
        return df.withColumn(out, F.lit(0))
    down = (F.col("COMP") == 0) & (F.col("MPG") == 0) & (F.col("LPS") == 0)
    return df.withColumn(out, F.when(down, 1).otherwise(0))


def drop_without_gps(df: DataFrame) -> DataFrame:
    if any(c not in df.columns for c in GPS_COLUMNS):
        return df
    return df.dropna(subset=GPS_COLUMNS)


def grid_cell(df: DataFrame, digits: int = 2) -> DataFrame:
    """`lat_rounded`, `lon_rounded`: the place at grid resolution."""
    require_columns(df, GPS_COLUMNS)
    return df.select(
        "*", F.round("gpsLat", digits).alias("lat_rounded"), F.round("gpsLong", digits).alias("lon_rounded")
    )


def prepare_readings(df: DataFrame, require_gps: bool = True, ts: str = "timestamp") -> DataFrame:
    """Parsed time, failure flag, and (unless switched off) only rows with a place."""
    require_columns(df, [ts])
    flagged = flag_failures(parse_time(df, ts))
    return drop_without_gps(flagged) if require_gps else flagged


def only_failures(df: DataFrame, flag: str = "failure") -> DataFrame:
    return df.filter(F.col(flag) == 1)


def only_defined(df: DataFrame, column: str = "RUL_minutes") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a NULL or NaN in `columns`, one condition per column.

    `dropna` is a single condition over all of them; where the columns are computed, the
    optimizer derives one variant of it per subset, and planning never ends.
    """
    fractional = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    for c in columns:
        there = F.col(f"`{c}`").isNotNull()
        df = df.filter(there & ~F.isnan(f"`{c}`") if c in fractional else there)
    return df


def finite_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and infinities to NULL in the given columns."""
    chosen = set(columns)
    return df.selectExpr(*[finite_sql(c) if c in chosen else f"`{c}`" for c in df.columns])


def rescale(df: DataFrame, units: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Bring signals to common units: value * scale + offset per column."""
    return df.select(*[
        (F.col(c) * F.lit(units[c][0]) + F.lit(units[c][1])).alias(c) if c in units else F.col(c)
        for c in df.columns
    ])


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42, keys: Sequence[str] = ()) -> DataFrame:
    """A sample of rows; with `keys` it depends on the keys alone, so reruns and other engines agree."""
    if not keys:
        return df.sample(fraction=fraction, seed=seed)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.filter(F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") < fraction * (1 << 52))


def distinct_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values in order, all or the first `limit`."""
    values = df.select(column).distinct().orderBy(column)
    return values if limit is None else values.limit(limit)


def melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Wide to long: (keys, feature, value)."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "feature", "value")
