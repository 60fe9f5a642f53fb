"""Joins: labels by key, rows around events, context as of a time, predictions with truth.

No join here forces a broadcast of data that can grow: Spark and AQE choose by
measured size, and AQE splits skewed join partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .bins import HOUR_PLACE
from .skew import hot_groups, salt_of


def join_place_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of failure labels by hour and place; no label means no failure."""
    return features.join(labels, HOUR_PLACE, "left").fillna({"failure": 0})


def join_hour_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of failure labels by hour, many rows to one; no label stays NULL."""
    return features.join(labels, "timestamp_hour", "left")


def around_events(
    points: DataFrame,
    events: DataFrame,
    point_ts: str,
    event_ts: str,
    before_seconds: int,
    after_seconds: int,
    keys: Sequence[str] = (),
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Every point within [event - before, event + after], once per matching event.

    Both limits are inclusive. Buckets as wide as the interval turn the range
    condition into an equality: each event visits at most two buckets, a point one.
    A bucket with more points than `rows_per_task` is split by the points' content, and its
    events are copied to each part; only buckets that an event visits are counted.
    """
    width = before_seconds + after_seconds
    if width <= 0:
        raise ValueError("the interval must be longer than zero seconds")
    bucketed = points.withColumn("_bucket", F.floor(F.unix_timestamp(point_ts) / width))
    at = F.unix_timestamp(event_ts)
    visiting = events.withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor((at - before_seconds) / width), F.floor((at + after_seconds) / width))),
    )
    near = (F.col(point_ts) >= F.timestamp_add("SECOND", F.lit(-before_seconds), F.col(event_ts))) & (
        F.col(point_ts) <= F.timestamp_add("SECOND", F.lit(after_seconds), F.col(event_ts))
    )
    spots = [*keys, "_bucket"]
    hot = _visited_hot(bucketed, visiting, spots, rows_per_task)
    splits = F.coalesce("splits", F.lit(1))
    parts = bucketed.join(hot, spots, "left").withColumn("_part", salt_of(points.columns, splits)).drop("splits")
    copies = visiting.join(hot, spots, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), splits - 1))).drop("splits")
    return parts.join(copies, [*spots, "_part"]).filter(near).drop("_bucket", "_part")


def _visited_hot(points: DataFrame, events: DataFrame, spots: Sequence[str], rows_per_task: int) -> DataFrame:
    """(spots, splits) of the buckets with too many points among those an event visits."""
    sizes = points.groupBy(*spots).agg(F.count(F.lit(1)).alias("_n"))
    return hot_groups(sizes, spots, "_n", rows_per_task).join(events.select(*spots).distinct(), list(spots), "left_semi")


def as_of(
    readings: DataFrame,
    context: DataFrame,
    key: str,
    reading_ts: str,
    context_ts: str,
    values: Sequence[str],
    row_key: Sequence[str],
    bucket_seconds: int = 3600,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Each reading with the newest context row at or before it; NULL if there is none.

    Work is cut by (key, time bucket). The newest context before a bucket is
    carried into it as one extra row, so no window reaches across buckets.
    Buckets with too many readings are split by row content, with the bucket's
    context rows copied to each part; readings never depend on each other.
    `context` has at most one row per key and time (else the greatest value wins).
    """
    bucket = lambda ts: F.floor(F.unix_timestamp(ts) / bucket_seconds)
    spots = [key, "_bucket"]
    facts = (
        context.groupBy(key, F.col(context_ts).alias("_ts"))
        .agg(F.max(F.struct(*values)).alias("_values"))
        .withColumn("_bucket", bucket("_ts"))
        .withColumn("_fact", F.struct("_ts", "_values"))
    )
    placed = readings.withColumn("_bucket", bucket(reading_ts))
    # Counted once: the same small table says which buckets are read and which are split.
    sizes = stage(placed.groupBy(*spots).agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    hot = hot_groups(sizes, spots, "n", rows_per_task)

    # Newest context of each bucket, brought forward to the buckets that have readings.
    newest = facts.groupBy(*spots).agg(F.max("_fact").alias("_newest"))
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sizes.select(*spots, F.lit(True).alias("_read"))
        .join(newest, spots, "full")
        .select(*spots, "_read", F.last("_newest", ignorenulls=True).over(earlier).alias("_fact"))
        .filter(F.col("_read") & F.col("_fact").isNotNull())
        .select(*spots, "_fact")
    )
    splits = F.coalesce("splits", F.lit(1))
    supply = (
        facts.select(*spots, "_fact").unionByName(carried)
        .join(hot, spots, "left")
        .select(
            *spots, F.explode(F.sequence(F.lit(0), splits - 1)).alias("_salt"),
            F.col("_fact")["_ts"].alias("_at"), F.lit(0).alias("_side"), "_fact",
        )
    )
    demand = (
        placed.join(hot, spots, "left")
        .select(
            *spots, salt_of(row_key, splits).alias("_salt"), F.col(reading_ts).alias("_at"),
            F.lit(1).alias("_side"), F.struct(*readings.columns).alias("_row"),
        )
    )
    # On equal times the context comes first, so it applies to the reading.
    upto = (
        Window.partitionBy(*spots, "_salt").orderBy("_at", "_side")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        supply.unionByName(demand, allowMissingColumns=True)
        .withColumn("_match", F.last("_fact", ignorenulls=True).over(upto))
        .filter(F.col("_side") == 1)
        .select(
            "_row.*", F.col("_match._ts").alias(f"{context_ts}_matched"),
            *[F.col(f"_match._values.{v}").alias(v) for v in values],
        )
    )


def join_static(readings: DataFrame, places: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a place dimension (grid cell attributes)."""
    return readings.join(places, list(keys), "left")


EARTH_KM = 6371.0088


def _on_sphere(lat: str, lon: str) -> list[Column]:
    """Kilometres along three axes from the Earth's centre; straight distances there grow with those along the ground."""
    up, round_ = F.radians(lat), F.radians(lon)
    return [F.cos(up) * F.cos(round_) * EARTH_KM, F.cos(up) * F.sin(round_) * EARTH_KM, F.sin(up) * EARTH_KM]


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    place_key: str,
    lat: str,
    lon: str,
    place_lat: str,
    place_lon: str,
    radius_km: float,
    cell_km: float = 1.0,
    distance: str = "distance_km",
) -> DataFrame:
    """`points` with the key of the nearest place within `radius_km` and its great-circle distance, else NULL.

    Works on the distinct positions, so a position with a third of all points is searched once. Positions and
    places are put into cubes of space, which know neither poles nor a date line. A place visits its own cube
    and the 26 around it; the best one found is sure if it is no farther off than a cube is wide. Positions without a
    sure one go on with cubes twice as wide, up to the radius. Equal distances go to the smaller key. Positions or
    places with a NULL or non-finite coordinate match nothing; a place's repeated rows count once.
    """
    if not 0 < radius_km < EARTH_KM or cell_km <= 0:
        raise ValueError("radius_km must lie between zero and the Earth's radius, cell_km above zero")
    axes = ["_x", "_y", "_z"]
    finite = lambda *names: reduce(and_, [F.abs(F.col(n)) < float("inf") for n in names])  # noqa: E731  NaN is greater
    spots = points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).filter(finite("_lat", "_lon")).distinct()
    left = stage(spots.select("_lat", "_lon", *[c.alias(n) for n, c in zip(axes, _on_sphere("_lat", "_lon"))]), "positions")
    known = stage(
        places.filter(finite(place_lat, place_lon) & F.col(place_key).isNotNull())
        .select(F.col(place_key).alias("_place"), *[c.alias(f"_p{n}") for n, c in zip(axes, _on_sphere(place_lat, place_lon))])
        .distinct(), "places")
    reach = 2 * EARTH_KM * math.sin(radius_km / EARTH_KM / 2)  # the radius as a straight line
    width, answers = min(cell_km, reach), []
    while True:
        cubes = [f"_c{n}" for n in axes]
        around = known
        for axis, cube in zip(axes, cubes):
            own = F.floor(F.col(f"_p{axis}") / width)
            around = around.withColumn(cube, F.explode(F.array(own - 1, own, own + 1)))
        here = left
        for axis, cube in zip(axes, cubes):
            here = here.withColumn(cube, F.floor(F.col(axis) / width))
        square = sum(((F.col(n) - F.col(f"_p{n}")) * (F.col(n) - F.col(f"_p{n}")) for n in axes), F.lit(0.0))
        best = (
            here.join(around, cubes).groupBy("_lat", "_lon")
            .agg(F.min(F.struct(F.sqrt(square).alias("off"), F.col("_place").alias("place"))).alias("_best"))
            .filter(F.col("_best.off") <= width)
        )
        answers.append(stage(best, "nearest"))
        if width >= reach:
            break
        left = stage(left.join(answers[-1], ["_lat", "_lon"], "left_anti"), "positions")
        if left.isEmpty():
            break
        width = min(2 * width, reach)
    found = reduce(DataFrame.unionByName, answers).select(
        F.col("_lat").alias(lat), F.col("_lon").alias(lon), F.col("_best.place").alias(place_key),
        (2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.col("_best.off") / (2 * EARTH_KM)))).alias(distance))
    return points.join(found, [lat, lon], "left").select(*points.columns, place_key, distance)


def pair_predictions(
    truth: DataFrame, predictions: DataFrame, key: str = "key",
) -> tuple[DataFrame, DataFrame]:
    """(pairs, unmatched): truth with predictions by row key, and what found no partner.

    `unmatched` has one row per model with the predictions lacking truth and the
    truth rows lacking a prediction.
    """
    pairs = predictions.join(truth, key).select("model", key, "y_true", "y_pred")
    known = truth.select(key, F.lit(1).alias("_known"))
    per_model = predictions.join(known, key, "left").groupBy("model").agg(
        F.count(F.when(F.col("_known").isNull(), 1)).alias("predictions_without_truth"),
        F.count("_known").alias("_matched"),
    )
    size = truth.agg(F.count(F.lit(1)).alias("_truth"))
    unmatched = per_model.crossJoin(F.broadcast(size)).select(
        "model", "predictions_without_truth",
        (F.col("_truth") - F.col("_matched")).alias("truth_without_prediction"),
    )
    return pairs, unmatched
