"""Time to the next failure, time since the last one, failure episodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timebins import day_chunk, hours_between, minutes_between
from .ordered import BLOCK_ROWS, running, with_halo


def add_failure_times(
    bins: DataFrame, parts: Sequence[str] = (), ts: str = "timestamp_bin", position: str | None = "pos",
) -> DataFrame:
    """`next_failure_time`, `last_failure_time` (a failing bin is its own), and the row position.

    Chunks are days of one series: at most 720 two-minute bins each.
    """
    failing = F.when(F.col("failure") == 1, F.col(ts))
    return running(
        bins, ts, day_chunk(ts), parts, position=position,
        following={"next_failure_time": failing}, last={"last_failure_time": failing},
    )


def failure_time_columns(parts: Sequence[str], ts: str = "timestamp_bin") -> list[Column]:
    """The same two times from windows over whole series, for series known to fit a task."""
    failing = F.when(F.col("failure") == 1, F.col(ts))
    forward = Window.partitionBy(*parts).orderBy(F.col(ts).asc_nulls_first())
    mirrored = Window.partitionBy(*parts).orderBy(F.col(ts).desc_nulls_last())
    upto = (Window.unboundedPreceding, 0)
    return [
        F.min(failing).over(mirrored.rowsBetween(*upto)).alias("next_failure_time"),
        F.max(failing).over(forward.rowsBetween(*upto)).alias("last_failure_time"),
    ]


def add_rul(bins: DataFrame, ts: str = "timestamp_bin", cap_minutes: float | None = None) -> DataFrame:
    """`RUL_minutes` (0 on failure, NULL after the last one) and `minutes_since_last_failure`."""
    left = minutes_between("next_failure_time", ts)
    life = F.when(F.col("failure") == 1, F.lit(0.0)).otherwise(left)
    if cap_minutes is not None:
        life = F.when(life.isNotNull(), F.least(life, F.lit(float(cap_minutes))))
    return bins.select(
        "*", life.alias("RUL_minutes"),
        minutes_between(ts, "last_failure_time").alias("minutes_since_last_failure"),
    )


def add_rul_hours(rows: DataFrame, ts: str = "timestamp_hour", cap_hours: float | None = None) -> DataFrame:
    """`next_failure_time` and `RUL_hours` on rows of which many may share an hour.

    Rows of one hour must not depend on their order, so the search runs over
    the distinct hours and is joined back.
    """
    hours = rows.groupBy(ts).agg(F.max("failure").alias("_failed"))
    failing = F.when(F.col("_failed") == 1, F.col(ts))
    hours = running(hours, ts, day_chunk(ts), following={"next_failure_time": failing}).drop("_failed")
    life = F.when(F.col("failure") == 1, F.lit(0.0)).otherwise(hours_between("next_failure_time", ts))
    if cap_hours is not None:
        life = F.when(life.isNotNull(), F.least(life, F.lit(float(cap_hours))))
    return rows.join(hours, ts, "left").withColumn("RUL_hours", life)


def failure_episodes(
    bins: DataFrame, parts: Sequence[str] = (), ts: str = "timestamp_bin", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per run of consecutive failing bins: (parts, episode, start, end, bins)."""
    placed = running(bins, ts, day_chunk(ts), parts, position="_pos")

    def build(window):
        before = F.coalesce(F.lag("failure", 1).over(window), F.lit(0))
        return [F.when((F.col("failure") == 1) & (before != 1), 1).otherwise(0).alias("_starts")]

    marked = with_halo(placed, "_pos", 1, build, parts, block_rows).filter(F.col("failure") == 1)
    # Non-failing bins carry no start, so the running count needs only the failing ones.
    numbered = running(marked, ts, day_chunk(ts), parts, sums={"episode": F.col("_starts").cast("bigint")})
    return numbered.groupBy(*parts, "episode").agg(
        F.min(ts).alias("start_time"), F.max(ts).alias("end_time"), F.count(F.lit(1)).alias("bins")
    )


def latest_rows(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The newest row per key, by one aggregate with map-side combine."""
    row = F.struct(*[F.col(c) for c in df.columns])
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, ts).alias("_row"))
    return newest.filter(F.col("_row").isNotNull()).select("_row.*")


def survival_steps(
    rows: DataFrame, width_minutes: int = 360, parts: Sequence[str] = ("unit_id",), ts: str = "timestamp_bin",
) -> DataFrame:
    """(age, seen, failures, at_risk, alive): the product-limit estimate of remaining life for every age.

    `age` is 0 for failing rows, NULL if no failure came before, else 1 plus the steps of `width_minutes` since the last
    failure. A row whose failure is known leaves at its remaining life; any other row is censored: it was
    seen without a failure until its unit's last bin. `alive` is the share still running just before `seen`.
    """
    unit = F.struct(*parts)
    ends = rows.groupBy(unit.alias("_unit")).agg(F.max(ts).alias("_end"))
    seen = F.coalesce("RUL_minutes", minutes_between("_end", ts))
    leaving = rows.withColumn("_unit", unit).join(ends, "_unit").groupBy(_age(width_minutes).alias("age"), seen.alias("seen")).agg(
        F.count(F.lit(1)).alias("_leaving"), F.count("RUL_minutes").alias("failures"))
    # A row per age and distinct time: bounded by the span of the log, not by its readings.
    later = Window.partitionBy("age").orderBy(F.desc("seen")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("age").orderBy("seen").rowsBetween(Window.unboundedPreceding, -1)
    counted = leaving.withColumn("at_risk", F.sum("_leaving").over(later))
    stays = F.lit(1.0) - F.col("failures") / F.col("at_risk")
    return counted.select("age", "seen", "failures", "at_risk", F.coalesce(F.product(stays).over(earlier), F.lit(1.0)).alias("alive"))


def life_table(
    rows: DataFrame, width_minutes: int = 360, parts: Sequence[str] = ("unit_id",), ts: str = "timestamp_bin",
) -> DataFrame:
    """(age, mean_minutes): mean remaining life by age, the area below the product-limit curve up to the longest time seen.

    Ages at which no failure was seen are left out. Leaving out the censored rows instead would make every life too short.
    """
    steps = survival_steps(rows, width_minutes, parts, ts)
    before = F.coalesce(F.lag("seen").over(Window.partitionBy("age").orderBy("seen")), F.lit(0.0))
    area = steps.withColumn("_area", F.col("alive") * (F.col("seen") - before))
    table = area.groupBy("age").agg(F.sum("_area").alias("mean_minutes"), F.sum("failures").alias("_failures"))
    return table.filter("_failures > 0").select("age", "mean_minutes")


def predict_life(rows: DataFrame, table: DataFrame, width_minutes: int = 360) -> DataFrame:
    """`predicted_minutes` from a life table: that of the row's age, else the mean over all ages of running units.

    Needs only what is known at the row's time, so the newest rows get a value too.
    """
    overall = table.filter(F.coalesce("age", F.lit(-1)) != 0).agg(F.avg("mean_minutes").alias("_overall"))  # one row
    steps = table.select(F.col("age").alias("_age"), F.col("mean_minutes").alias("_mean"))
    aged = rows.withColumn("_own", _age(width_minutes))
    met = aged.join(steps, F.col("_own").eqNullSafe(F.col("_age")), "left").crossJoin(F.broadcast(overall))
    return met.select(*rows.columns, F.coalesce("_mean", "_overall").alias("predicted_minutes"))


def _age(width_minutes: int) -> Column:
    since = F.col("minutes_since_last_failure")
    return F.when(since == 0, F.lit(0)).otherwise(F.floor(since / width_minutes) + 1)
