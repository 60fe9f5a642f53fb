"""Splitting of groups that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_groups(sizes: DataFrame, keys: Sequence[str], count: str = "n", rows_per_task: int = 1_000_000) -> DataFrame:
    """(keys, splits) for every group above `rows_per_task` rows.

    There may be many of them, so the result is joined like any other table.
    """
    return sizes.filter(F.col(count) > rows_per_task).select(
        *keys, F.ceil(F.col(count) / F.lit(rows_per_task)).cast("int").alias("splits"))


def salt_of(row_key: Sequence[str], splits: Column) -> Column:
    """Part 0..splits-1 from the row's content: a recomputed task gives the same parts."""
    return F.pmod(F.xxhash64(*row_key), splits.cast("bigint")).cast("int")
