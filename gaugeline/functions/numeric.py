"""Small numeric column expressions; all of them compile to JVM code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value as double; NaN and both infinities become NULL."""
    value = _col(c).cast("double")
    ok = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(ok, value)


def finite_sql(column: str) -> str:
    """`finite` as SQL text, for lists of many columns."""
    value = f"CAST(`{column}` AS DOUBLE)"
    return f"CASE WHEN NOT isnan({value}) AND abs({value}) <> DOUBLE('Infinity') THEN {value} END AS `{column}`"


def zero_if_missing(c: Column) -> Column:
    """NULL and NaN to 0."""
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def clip(c: Column | str, low: float | Column, high: float | Column) -> Column:
    """Bring into [low, high]; NULL stays NULL (`least` and `greatest` would skip it)."""
    value = _col(c)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def edge_index_left(c: Column | str, edges: Sequence[float]) -> Column:
    """i with edges[i] <= x < edges[i+1]; -1 below, len(edges)-1 at or past the end."""
    value = _col(c)
    passed = reduce(add, [(value >= F.lit(e)).cast("int") for e in edges])
    return passed - 1


def edge_index_right(c: Column | str, edges: Sequence[float]) -> Column:
    """i with edges[i] < x <= edges[i+1]; -1 at or below the first edge."""
    value = _col(c)
    passed = reduce(add, [(value > F.lit(e)).cast("int") for e in edges])
    return passed - 1


def equal_width_bin(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """Bin 0..bins-1 of [low, high]; the top value belongs to the last bin.

    A range of width zero puts everything into the middle bin.
    """
    value = _col(c)
    raw = F.floor((value - low) / ((high - low) / F.lit(float(bins))))
    inside = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    placed = F.when(high > low, inside).otherwise(F.lit(bins // 2))
    return F.when(value.isNotNull(), placed).cast("int")


def with_place(
    df: DataFrame, out: str, value: Column | str, edges: str, most: int, include_equal: bool = True,
) -> DataFrame:
    """`out`: how many entries of the sorted array column `edges` lie at or below (or just below) the value.

    Halving search over at most `most` entries, one projection per step, all of
    it compiled; filtering the array would visit every entry for every row.
    """
    value = _col(value)
    array = F.col(edges)
    step = 1 << (max(most, 1).bit_length() - 1)
    df = df.withColumn(out, F.lit(0))
    while step:
        entry = F.get(array, F.col(out) + F.lit(step - 1))
        passed = entry <= value if include_equal else entry < value
        df = df.withColumn(out, F.col(out) + F.when(passed, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return df
