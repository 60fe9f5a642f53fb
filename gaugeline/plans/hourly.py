"""The hourly tables: statistics by place, with failure labels and remaining hours."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.bins import failures_by_place, hourly_by_place, hourly_with_failures, hourly_with_hour_failures
from ..operators.enrich import join_place_labels
from ..operators.rul import add_rul_hours
from ..session import stage


def hourly_labelled(readings: DataFrame) -> DataFrame:
    """Statistics joined with separately built labels by hour and place."""
    return join_place_labels(hourly_by_place(readings), failures_by_place(readings))


def hourly_fused(readings: DataFrame) -> DataFrame:
    """The same table from a single scan."""
    return hourly_with_failures(readings)


def hourly_failure(readings: DataFrame) -> DataFrame:
    """Statistics by place, labelled by whether anything failed in that hour anywhere."""
    return hourly_with_hour_failures(readings)


def rul_hours(readings: DataFrame, cap_hours: float | None = None) -> DataFrame:
    """`hourly_failure` with the next failing hour and the hours left to it."""
    return add_rul_hours(stage(hourly_failure(readings), "hourly"), cap_hours=cap_hours)
