"""Maintenance outputs: risk bands, actions, reliability figures, savings."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rul import failure_episodes, latest_rows

# Upper limits of the bands in minutes. The first two are the
# published action limits; anything past the third is low risk.
CRITICAL_MINUTES, HIGH_MINUTES, MEDIUM_MINUTES = 120, 480, 1440


def risk_band(rul: str = "RUL_minutes") -> Column:
    life = F.col(rul)
    return (
        F.when(life < CRITICAL_MINUTES, "Critical").when(life <= HIGH_MINUTES, "High")
        .when(life <= MEDIUM_MINUTES, "Medium").when(life.isNotNull(), "Low")
    )


def recommended_action(rul: str = "RUL_minutes") -> Column:
    """What to do, with the lead time in whole minutes."""
    lead = F.floor(rul).cast("bigint")
    band = F.col("risk_band")
    return (
        F.when(band == "Critical", F.format_string("swap unit within %d minutes", lead))
        .when(band == "High", F.format_string("schedule at next terminal within %d minutes", lead))
        .when(band == "Medium", F.format_string("plan within %d minutes", lead))
        .when(band == "Low", F.lit("monitor"))
    )


def add_risk(rows: DataFrame, rul: str = "RUL_minutes") -> DataFrame:
    return rows.withColumn("risk_band", risk_band(rul)).withColumn("action", recommended_action(rul))


def status_board(
    rows: DataFrame, unit: str = "unit_id", ts: str = "timestamp_bin", rul: str = "predicted_minutes",
) -> DataFrame:
    """The newest row of each unit with the risk and action of its predicted life."""
    return add_risk(latest_rows(rows, unit, ts), rul)


def worklist(
    rows: DataFrame, unit: str = "unit_id", ts: str = "timestamp_bin", rul: str = "predicted_minutes",
) -> DataFrame:
    """Units at critical or high risk now, most urgent first."""
    urgent = status_board(rows, unit, ts, rul).filter(F.col("risk_band").isin("Critical", "High"))
    return urgent.orderBy(rul, unit)


def unit_history(rows: DataFrame, alerts: DataFrame, unit: str = "unit_id") -> DataFrame:
    """All rows of the units on an alert list."""
    return rows.join(alerts.select(unit).distinct(), unit, "left_semi")


def reliability(bins: DataFrame, bin_minutes: int, unit: str = "unit_id", ts: str = "timestamp_bin") -> DataFrame:
    """(unit, operating_hours, failures, mtbf_hours, failures_per_1000h).

    Operating time is the time covered by the unit's bins; a run of failing
    bins is one failure. Without failures there is no MTBF.
    """
    hours = bins.groupBy(unit).agg((F.count(F.lit(1)) * F.lit(bin_minutes / 60.0)).alias("operating_hours"))
    failures = failure_episodes(bins, [unit], ts).groupBy(unit).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    return hours.join(failures, unit, "left").select(
        unit, "operating_hours", n.alias("failures"),
        F.when(n > 0, F.col("operating_hours") / n).alias("mtbf_hours"),
        (n * 1000.0 / F.col("operating_hours")).alias("failures_per_1000h"),
    )


def rate_change(
    bins: DataFrame, bin_minutes: int, split: str, group: Column, name: str = "unit_group", unit: str = "unit_id",
    ts: str = "timestamp_bin", z: float = 1.959964,
) -> DataFrame:
    """(group, failures and operating hours before and from `split` on, rate_ratio, ratio_low, ratio_high) per unit group.

    Failures are taken as Poisson counts over the operating time. The limits are those of the log ratio, `z` standard
    errors to each side (1.96: 95 %); a side without failures or without operating time has no ratio. `group` is a column
    of the unit key. A run of failing bins counts once, on the side where it starts.
    """
    at = F.lit(split).cast("timestamp_ntz")
    hours = bins.groupBy(group.alias(name), (F.col(ts) >= at).alias("_after")).agg(
        (F.count(F.lit(1)) * F.lit(bin_minutes / 60.0)).alias("_hours"))
    runs = failure_episodes(bins, [unit], ts).groupBy(group.alias(name), (F.col("start_time") >= at).alias("_after")).agg(
        F.count(F.lit(1)).alias("_runs"))
    # A row per group and side from here on.
    sides = hours.withColumn("_runs", F.lit(0).cast("long")).unionByName(runs.withColumn("_hours", F.lit(0.0)))

    def on(side: bool, column: str) -> Column:
        return F.sum(F.when(F.col("_after") == side, F.col(column)).otherwise(0))
    both = sides.filter(F.col("_after").isNotNull()).groupBy(name).agg(
        on(False, "_runs").alias("failures_before"), on(True, "_runs").alias("failures_after"),
        on(False, "_hours").alias("hours_before"), on(True, "_hours").alias("hours_after"))
    known = (F.least("failures_before", "failures_after") > 0) & (F.least("hours_before", "hours_after") > 0)
    ratio = F.when(known, F.col("failures_after") / F.col("hours_after") / (F.col("failures_before") / F.col("hours_before")))
    reach = F.exp(z * F.sqrt(1.0 / F.col("failures_before") + 1.0 / F.col("failures_after")))
    return both.select("*", ratio.alias("rate_ratio"), F.when(known, ratio / reach).alias("ratio_low"),
                       F.when(known, ratio * reach).alias("ratio_high"))


def savings(failures_avoided: Column, delay_cost: float, damage_cost: float, planned_delta: float) -> Column:
    """Cost saved: avoided failures at their full cost, less the extra planned maintenance."""
    return failures_avoided * F.lit(delay_cost + damage_cost) - F.lit(planned_delta)


def dashboard_filter(rows: DataFrame, wanted: Mapping[str, Any], ts: str | None = None,
                     start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows matching every given column (a value or a list of values) and the time span [start, end)."""
    for column, value in wanted.items():
        rows = rows.filter(F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set))
                           else F.col(column) == value)
    if ts and start is not None:
        rows = rows.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if ts and end is not None:
        rows = rows.filter(F.col(ts) < F.lit(end).cast("timestamp_ntz"))
    return rows
