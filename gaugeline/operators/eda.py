"""Distribution and exploratory reports as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import equal_width_bin, finite
from ..functions.quantiles import percentile_arrays
from ..schema import COUNTED_SIGNALS, numeric_columns
from ..session import importable
from .clean import finite_columns, melt
from .enrich import around_events

HOUR = 3600
TREND_SENSORS = ["Motor_current_avg", "Oil_temp_avg", "DV_pressure_avg"]


def table_profile(df: DataFrame, name: str = "table") -> DataFrame:
    """(name, row_count, column_count)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("name"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def signal_value_counts(df: DataFrame, signals: Sequence[str] = COUNTED_SIGNALS) -> DataFrame:
    """Counts per value of each binary signal, all signals in one pass."""
    present = [c for c in signals if c in df.columns]
    wide = df.select(*[F.col(c).try_cast("int").alias(c) for c in present])
    counted = wide.unpivot([], present, "signal", "value").groupBy("signal", "value")
    return counted.agg(F.count(F.lit(1)).alias("n")).orderBy("signal", "value")


def class_balance(df: DataFrame, flag: str = "failure") -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


def _stacked(wide: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One row holding `<column>__<stat>` to one row per column."""
    entries = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in columns
    ]
    return wide.select(F.inline(F.array(*entries)))


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, mean, stddev, min, max) of the finite values in one aggregate."""
    df = finite_columns(df, columns)
    kinds = {"n": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    wide = df.agg(*[
        f(F.col(c).cast("double")).alias(f"{c}__{s}") for c in columns for s, f in kinds.items()
    ])
    return _stacked(wide, columns, list(kinds))


def missing_and_outliers(df: DataFrame, columns: Sequence[str], fence: float = 1.5) -> DataFrame:
    """(feature, missing, outliers): values beyond `fence` quartile ranges count as outliers."""
    quartiles = percentile_arrays(df, columns, [0.25, 0.75]).select("feature", "q")
    long = melt(df, columns)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    reach = (q3 - q1) * fence
    outside = (F.col("value") < q1 - reach) | (F.col("value") > q3 + reach)
    # One quartile row per feature: as small as the column list.
    return long.join(F.broadcast(quartiles), "feature", "left").groupBy("feature").agg(
        F.count(F.when(F.col("value").isNull() | F.isnan("value"), 1)).alias("missing"),
        F.count(F.when(outside & ~F.isnan("value"), 1)).alias("outliers"),
    )


def zscores(df: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """Columns minus their mean over their sample std; NULL where the std is 0 or missing, or the value is not finite."""
    df = finite_columns(df, columns)
    moments = df.agg(*[
        m(c).alias(f"_{n}_{c}") for c in columns for n, m in (("mean", F.avg), ("std", F.stddev))
    ])
    out = [
        F.when(F.col(f"_std_{c}") != 0, (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_std_{c}")).alias(c + suffix)
        for c in columns
    ]
    return df.crossJoin(F.broadcast(moments)).select(*[F.col(c) for c in df.columns], *out)


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int, groups: Sequence[str] = (),
) -> DataFrame:
    """(groups, feature, bin, low, high, n): equal-width counts of non-missing values.

    Each (group, feature) has its own range; empty bins are left out. Groups are
    report classes, so few.
    """
    groups = list(groups)
    series = [*groups, "feature"]
    long = melt(df, columns, groups).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    ranges = long.groupBy(*series).agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    where = equal_width_bin("value", F.col("_low"), F.col("_high"), bins)
    # One row per group and feature; a shuffle on so few keys would be all skew.
    counted = long.join(F.broadcast(ranges), series).groupBy(*series, "_low", "_high", where.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    width = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
    return counted.select(
        *series, "bin", (F.col("_low") + F.col("bin") * width).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("high"), "n",
    )


def box_stats(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, feature, q1, median, q3, whisker_low, whisker_high, outliers, mean, n).

    Whiskers end at the outermost values within 1.5 quartile ranges, and never
    inside the box.
    """
    groups = list(groups)
    series = [*groups, "feature"]
    quartiles = percentile_arrays(df, columns, [0.25, 0.5, 0.75], groups).drop("n_values")
    long = melt(df, columns, groups).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    q1, q3 = F.col("q")[0], F.col("q")[2]
    low, high = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    value = F.col("value")
    stats = long.join(F.broadcast(quartiles), series).groupBy(*series, "q").agg(
        F.min(F.when(value >= low, value)).alias("_low"),
        F.max(F.when(value <= high, value)).alias("_high"),
        F.count(F.when((value < low) | (value > high), 1)).alias("outliers"),
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"),
    )
    return stats.select(
        *series, q1.alias("q1"), F.col("q")[1].alias("median"), q3.alias("q3"),
        F.least("_low", q1).alias("whisker_low"), F.greatest("_high", q3).alias("whisker_high"),
        "outliers", "mean", "n",
    )


def correlations(
    df: DataFrame, columns: Sequence[str] | None = None, listwise: bool = False,
) -> DataFrame:
    """(a, b, r) for every pair of columns in column order, each column with itself included.

    Pairwise by default: each pair uses the rows where both are present.
    `listwise` uses only rows where all columns are. r is NULL where a column does not vary.
    """
    return correlation_tables(df, columns, ("listwise" if listwise else "pairwise",)).drop("rows")


def correlation_tables(
    df: DataFrame, columns: Sequence[str] | None = None, rows: Sequence[str] = ("pairwise", "listwise"),
) -> DataFrame:
    """(rows, a, b, r): one matrix per rule of which rows count, all from the same pass.

    Each task reduces its rows to sums per pair, Spark adds those up. As separate aggregate
    expressions the pairs would outgrow compiled code. The listwise rule is a mask inside
    that reduction, so it costs neither a filter nor a pass.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    base = df.select(*[finite(c).alias(c) for c in columns])
    # Sums around the mean keep their digits; which mean does not matter.
    means = base.agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns])
    centred = base.crossJoin(F.broadcast(means)).select(
        *[(F.col(c) - F.col(f"_mean_{c}")).alias(c) for c in columns]
    )
    importable(df.sparkSession)
    sums = centred.mapInPandas(partial(_pair_sums, rules=tuple(rows)), PAIR_SUMS).groupBy("rows", "i", "j").agg(
        *[F.sum(s).alias(s) for s in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    per_row = F.greatest("n", F.lit(1.0))
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / per_row, F.col("syy") - F.col("sy") * F.col("sy") / per_row
    # What is left of a constant's squares is rounding noise.
    varies = (vx > F.col("sxx") * 1e-12) & (vy > F.col("syy") * 1e-12)
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / per_row) / F.sqrt(vx * vy)
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(
        "rows", F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), F.when(varies, r).alias("r")
    )


PAIR_SUMS = "rows string, i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pair_sums(batches: Iterator[pd.DataFrame], rules: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """Sums over the rows that count for a pair of columns, for one task's rows and each rule."""
    totals: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        present = batch.to_numpy(dtype="float64")
        for rule in rules:
            there = np.isfinite(present)
            if rule == "listwise":
                there = there & there.all(axis=1, keepdims=True)
            values = np.where(there, present, 0.0)
            there = there.astype("float64")
            parts = [there.T @ there, values.T @ there, (values * values).T @ there, values.T @ values]
            totals[rule] = [a + b for a, b in zip(totals[rule], parts)] if rule in totals else parts
    for rule, (n, sx, sxx, sxy) in totals.items():
        i, j = np.triu_indices(n.shape[0])
        yield pd.DataFrame({
            "rows": rule, "i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "sx": sx[i, j], "sy": sx[j, i],
            "sxx": sxx[i, j], "syy": sxx[j, i], "sxy": sxy[i, j],
        })


def failure_window_trend(
    hourly: DataFrame, sensors: Sequence[str] = TREND_SENSORS, hours: int = 12, failures: int | None = None,
) -> DataFrame:
    """(failure_time, timestamp_hour, <sensor>_norm): z-scored means around every failing hour, or the first `failures`."""
    normed = zscores(hourly, sensors)
    times = (
        hourly.filter(F.col("failure") == 1).select(F.col("timestamp_hour").alias("failure_time"))
        .distinct()
    )
    if failures:
        times = times.orderBy("failure_time").limit(failures)
    near = around_events(normed, times, "timestamp_hour", "failure_time", hours * HOUR, hours * HOUR)
    return near.groupBy("failure_time", "timestamp_hour").agg(
        *[F.avg(f"{s}_norm").alias(f"{s}_norm") for s in sensors]
    )


def pre_failure_rows(hourly: DataFrame, hours: int = 12) -> DataFrame:
    """Each hourly row once per failing hour at most `hours` later, with `hours_to_failure` <= 0.

    `failing_places` counts the failing rows of that hour, so no pairs of places are formed.
    """
    failing = hourly.filter(F.col("failure") == 1).groupBy(F.col("timestamp_hour").alias("failure_time")).agg(
        F.count(F.lit(1)).alias("failing_places"))
    near = around_events(hourly, failing, "timestamp_hour", "failure_time", hours * HOUR, 0)
    gap = F.unix_timestamp("timestamp_hour") - F.unix_timestamp("failure_time")
    return near.withColumn("hours_to_failure", gap / F.lit(3600.0))


def pre_failure_trend(
    hourly: DataFrame, sensors: Sequence[str] = TREND_SENSORS, hours: int = 12,
) -> DataFrame:
    """(hours_to_failure, per sensor mean, std and both standardised over the offsets).

    Equals aggregating `pre_failure_rows`, but never forms those rows: an hour's
    rows all share their offset to a failing hour, so per-hour counts, means and
    squared deviations are combined, weighted by the failing rows of the hour.
    """
    moments = [F.count(F.when(F.col("failure") == 1, 1)).alias("_weight")]
    for s in sensors:
        moments += [
            F.count(s).cast("double").alias(f"n_{s}"), F.avg(s).alias(f"m_{s}"),
            (F.var_pop(s) * F.count(s)).alias(f"d_{s}"),
        ]
    by_hour = hourly.groupBy("timestamp_hour").agg(*moments)
    failing = by_hour.filter("_weight > 0").select(
        F.col("timestamp_hour").alias("failure_time"), F.col("_weight").cast("double").alias("w"),
        F.explode(F.sequence(F.lit(-hours), F.lit(0))).alias("_offset"),
    )
    shifted = failing.select(
        "w", F.col("_offset").cast("double").alias("hours_to_failure"),
        F.timestamp_add("HOUR", F.col("_offset"), F.col("failure_time")).alias("timestamp_hour"),
    )
    hit = by_hour.drop("_weight").join(shifted, "timestamp_hour")

    # Two steps, mean first: squared deviations around it do not cancel.
    means = hit.groupBy("hours_to_failure").agg(*[
        (F.sum(F.col("w") * F.col(f"n_{s}") * F.col(f"m_{s}")) / F.sum(
            F.when(F.col(f"n_{s}") > 0, F.col("w") * F.col(f"n_{s}")))).alias(f"mean_{s}")
        for s in sensors
    ])
    spread = hit.join(F.broadcast(means), "hours_to_failure").groupBy("hours_to_failure").agg(*[
        f for s in sensors for f in (
            F.max(f"mean_{s}").alias(f"{s}_mean"),
            F.sum(F.col("w") * F.col(f"n_{s}")).alias(f"_n_{s}"),
            F.sum(F.col("w") * (F.col(f"d_{s}") + F.col(f"n_{s}") * F.pow(
                F.col(f"m_{s}") - F.col(f"mean_{s}"), 2))).alias(f"_d_{s}"),
        )
    ])
    table = spread.select("hours_to_failure", *[
        c for s in sensors for c in (
            F.col(f"{s}_mean"),
            F.when(F.col(f"_n_{s}") > 1, F.sqrt(F.col(f"_d_{s}") / (F.col(f"_n_{s}") - 1))).alias(f"{s}_std"),
        )
    ])
    return zscores(table, [f"{s}_{k}" for s in sensors for k in ("mean", "std")])


def unit_heatmap(
    rows: DataFrame, unit: str = "unit_id", ts: str = "timestamp_bin", rul: str = "RUL_minutes",
) -> DataFrame:
    """(unit, day, min_rul, avg_rul): remaining life by unit and day."""
    return rows.groupBy(unit, F.to_date(ts).alias("day")).agg(
        F.min(rul).alias("min_rul"), F.avg(rul).alias("avg_rul")
    )


def top_rows(df: DataFrame, by: str, k: int) -> DataFrame:
    """The k rows with the greatest `by`; Spark keeps k rows per task."""
    return df.orderBy(F.desc(by)).limit(k)


def first_rows(df: DataFrame, order: str, k: int, groups: Sequence[str] = ()) -> DataFrame:
    """The first k rows in order, overall or per group.

    The rank filter on `row_number` lets Spark cut each task to k rows per group
    before the shuffle.
    """
    if not groups:
        return df.orderBy(order).limit(k)
    ranked = F.row_number().over(Window.partitionBy(*groups).orderBy(order))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") <= k).drop("_rank")
