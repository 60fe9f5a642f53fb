"""Ordered windows over series of any length.

A plain window without partition columns (or with one giant key) sorts the
whole series in one task. These forms cut the series into chunks, window
inside the chunks, and bring what crosses a chunk border as small carried
values or as a few copied rows. Every helper gives the plain window's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import stage

BLOCK_ROWS = 4096
# Low bits of `monotonically_increasing_id`: the row within its task.
TASK_BITS = 33


def running(
    df: DataFrame,
    order: str,
    chunk: Column,
    parts: Sequence[str] = (),
    position: str | None = None,
    total: str | None = None,
    sums: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add columns that depend on the whole series before or after a row.

    `chunk` must never be NULL and never fall along `order`, which is unique
    within `parts`. `position` counts from 0, `total` is the series' length,
    `sums` are running sums including the row. `last` / `following` take
    markers that never fall along the order (such as the time of an event, or
    NULL): the latest at or before, the earliest at or after the row.
    """
    sums, last, following = dict(sums or {}), dict(last or {}), dict(following or {})
    # A struct is never NULL itself, so a series whose key holds NULLs still joins.
    series = ["_series"] if parts else []
    keys = [*series, "_chunk"]
    chunked = df.withColumn("_chunk", chunk)
    if parts:
        chunked = chunked.withColumn("_series", F.struct(*parts))

    aggregates = [F.count(F.lit(1)).alias("_rows")]
    aggregates += [F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    aggregates += [F.max(c).alias(f"_last_{n}") for n, c in last.items()]
    aggregates += [F.min(c).alias(f"_next_{n}") for n, c in following.items()]
    per_chunk = chunked.groupBy(*keys).agg(*aggregates)

    earlier = Window.partitionBy(*series).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*series).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base")]
    carried += [F.sum("_rows").over(Window.partitionBy(*series)).alias("_length")]
    carried += [F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_sum_{n}") for n in sums]
    carried += [F.max(f"_last_{n}").over(earlier).alias(f"_last_{n}") for n in last]
    carried += [F.min(f"_next_{n}").over(later).alias(f"_next_{n}") for n in following]
    carry = per_chunk.select(*keys, *carried)

    inside = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # The mirrored running minimum costs one pass; a frame to the end of the
    # chunk would be recomputed for every row.
    onward = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = [F.row_number().over(inside).cast("bigint").alias("_row")] if position else []
    local += [F.sum(c).over(upto).alias(f"_in_sum_{n}") for n, c in sums.items()]
    local += [F.max(c).over(upto).alias(f"_in_last_{n}") for n, c in last.items()]
    local += [F.min(c).over(onward).alias(f"_in_next_{n}") for n, c in following.items()]

    out = [F.col(c) for c in df.columns]
    if position:
        out.append((F.col("_base") + F.col("_row") - 1).alias(position))
    if total:
        out.append(F.col("_length").alias(total))
    out += [(F.col(f"_sum_{n}") + F.coalesce(F.col(f"_in_sum_{n}"), F.lit(0))).alias(n) for n in sums]
    out += [F.coalesce(f"_in_last_{n}", f"_last_{n}").alias(n) for n in last]
    out += [F.coalesce(f"_in_next_{n}", f"_next_{n}").alias(n) for n in following]
    return chunked.select("*", *local).join(carry, keys, "left").select(*out)


def positions(df: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """(`df` with its place in ascending `order`, number of rows), no matter how many rows share a day.

    The rows are written once, with a number each. Only the order columns and that number are dealt by range
    and sorted; a row's place is its place in its task plus the rows of the tasks before, one count per task. The
    places come back to the rows by an equality join on the number. Both ends agree because the numbers are stored.
    """
    held = stage(df.withColumn("_row", F.monotonically_increasing_id()), "unplaced")
    slim = held.select("_row", *order).repartitionByRange(*order).sortWithinPartitions(*order, "_row")
    placed = stage(slim.select("_row", F.monotonically_increasing_id().alias("_place")), "placed")
    task = F.shiftright("_place", TASK_BITS)
    starts, total = [], 0
    for number, count in sorted(map(tuple, placed.groupBy(task.alias("task")).count().collect())):
        starts.append((number, total))
        total += count
    bases = df.sparkSession.createDataFrame(starts, "_task long, _before long")
    within = F.col("_place").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    places = placed.withColumn("_task", task).join(F.broadcast(bases), "_task").select(
        "_row", (F.col("_before") + within).alias(name))
    return held.join(places, "_row").select(*df.columns, name), total


def with_halo(
    df: DataFrame,
    position: str,
    back: int,
    build: Callable[[WindowSpec], Sequence[Column]],
    parts: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add windowed columns that look at most `back` rows behind.

    Rows go to blocks of consecutive positions; the last `back` rows of a block
    are also sent to the next one, so each block can be windowed alone.
    """
    block_rows = max(block_rows, back)
    own = F.floor(F.col(position) / F.lit(block_rows))
    near_end = F.col(position) - own * block_rows >= block_rows - back
    spread = df.withColumn("_block", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))
    window = Window.partitionBy(*parts, "_block").orderBy(position)
    return (
        spread.select("*", *build(window))
        .filter(F.col("_block") == own)
        .drop("_block")
    )


def with_time_halo(
    df: DataFrame,
    second: Column,
    span: int,
    build: Callable[[WindowSpec], Sequence[Column]],
    parts: Sequence[str] = (),
    block_seconds: int | None = None,
) -> DataFrame:
    """Like `with_halo` for frames of `span` seconds; the window is ordered by second."""
    width = max(block_seconds or 86400, span)
    timed = df.withColumn("_second", second)
    own = F.floor(F.col("_second") / F.lit(width))
    near_end = F.col("_second") - own * width >= width - span
    # A NULL time falls to array(NULL): one row in a block of its own.
    spread = timed.withColumn(
        "_block", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    window = Window.partitionBy(*parts, "_block").orderBy("_second")
    return (
        spread.select("*", *build(window))
        .filter(F.col("_block").eqNullSafe(own))
        .drop("_block", "_second")
    )
