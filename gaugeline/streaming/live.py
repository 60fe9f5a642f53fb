"""Live bins, time since failure, scoring and drift on Structured Streaming.

The queries chain through tables: readings -> bins -> per-unit state, scores.
Each stage has its own checkpoint, so a lost executor or a restart resumes
where the stage stood.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import with_place
from ..functions.quantiles import percentile_arrays
from ..functions.timebins import at_second, day_chunk, parse_time
from ..operators.bins import bin_statistics
from ..operators.clean import drop_without_gps, flag_failures, melt
from ..operators.eda import summary_stats
from ..operators.features import rolling_features
from ..operators.ordered import running
from ..operators.prep import impute
from ..schema import KEY_SIGNALS
from ..session import new_path, stage
from . import keyed


def live_bins(
    readings: DataFrame,
    bin_minutes: int = 2,
    parts: Sequence[str] = ("unit_id",),
    watermark: str = "10 minutes",
    require_gps: bool = True,
    ts: str = "timestamp",
) -> DataFrame:
    """Streaming bins: a bin is emitted once, when the watermark has passed its end.

    Partial aggregation runs before the shuffle, so a busy unit costs one row
    per bin and task. Readings later than the watermark are dropped. Open bins wait in the store that
    keeps them on disk: a batch may open as many as it has readings.
    """
    keyed.prepare(readings.sparkSession)
    flagged = flag_failures(parse_time(readings, ts))
    placed = drop_without_gps(flagged) if require_gps else flagged
    # Watermarks want a zoned type; the wall-clock second is read as UTC and back.
    timed = placed.withColumn("_event", F.timestamp_seconds(F.unix_timestamp(ts))).withWatermark("_event", watermark)
    bins = timed.groupBy(*parts, F.window("_event", f"{bin_minutes} minutes").alias("_window")).agg(
        *bin_statistics(placed), F.max("failure_raw").alias("failure")
    )
    return bins.select(
        *parts, at_second(F.unix_timestamp("_window.start")).alias("timestamp_bin"),
        *[c for c in bins.columns if c not in (*parts, "_window")],
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into a parquet table, then stop."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_stream(spark: SparkSession, table: DataFrame, path: str, name_filter: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet folder as a stream with the schema of `table`."""
    reader = spark.readStream.schema(table.schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def live_since_failure(bins: DataFrame, ts: str = "timestamp_bin", unit: str = "unit_id") -> DataFrame:
    """Streaming minutes since each unit's last failure, from finished bins in any order."""
    return keyed.since_failure(bins, ts, unit)


def score_bins(
    stream: DataFrame, model: PipelineModel, features: Sequence[str], out_path: str, checkpoint: str,
    fills: Mapping[str, float], parts: Sequence[str] = ("unit_id",), rows_back: int = 14, roll_minutes: int = 30,
    ts: str = "timestamp_bin", idle_ms: int | None = None,
) -> None:
    """Score each batch of finished bins with features that reach into earlier bins.

    The last `rows_back` bins of a unit are state of the stream (`keyed.NewestBins`): a batch reads and writes
    those of the units it has bins of, whatever the fleet's size, and a unit may be silent for any time
    unless `idle_ms` bounds it. Only columns that are features, or that features are made of, enter the state.
    Missing features get the train medians in `fills`, as in training. Batch
    ids are folders of the output, so a replayed batch overwrites itself instead of adding rows.
    """
    used = {*parts, ts, *features, *KEY_SIGNALS}
    narrow = stream.select(*[c for c in stream.columns if c in used])

    def handle(batch: DataFrame, batch_id: int) -> None:
        recent = stage(batch, "live-batch")
        placed = running(recent, ts, day_chunk(ts), parts, position="pos")
        rolled = rolling_features(placed, rows_back, roll_minutes, parts).filter("_fresh")
        ready = impute(rolled, features, dict(fills))
        model.transform(ready).select(*parts, ts, *features, "y_pred").write.mode("overwrite").parquet(
            f"{out_path}/batch={batch_id}"
        )

    query = (
        keyed.with_newest(narrow, parts, ts, rows_back, idle_ms).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_fresh(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is available into a new table and return that table."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    run_to_table(stream, path, new_path(spark, f"{label}-progress"))
    return spark.read.schema(stream.schema).parquet(path)


def drift_profile(train: DataFrame, features: Sequence[str], buckets: int = 10) -> DataFrame:
    """(feature, mean, std, edges) of the train side; edges are its inner quantiles."""
    marks = [i / buckets for i in range(1, buckets)]
    edges = percentile_arrays(train, features, marks).select("feature", F.array_distinct("q").alias("edges"))
    stats = summary_stats(train, features).select("feature", "mean", F.col("stddev").alias("std"))
    return stats.join(edges, "feature")


def feature_drift(
    rows: DataFrame, train: DataFrame, features: Sequence[str], ts: str = "timestamp_bin",
    buckets: int = 10, floor: float = 1e-4,
) -> DataFrame:
    """(feature, day, n, mean_shift, psi): each day against the train profile.

    `mean_shift` is in train standard deviations. `psi` compares the shares per
    train-quantile bucket, with empty shares raised to `floor`. A label is
    tracked by naming it among the features.
    """
    profile = F.broadcast(drift_profile(train, features, buckets))  # one row per feature

    def counted(source: DataFrame, keys: list[str]) -> DataFrame:
        long = melt(source, features, keys).filter(F.col("value").isNotNull() & ~F.isnan("value"))
        placed = with_place(long.join(profile, "feature"), "bucket", "value", "edges", buckets, False)
        return placed.groupBy("feature", *keys, "bucket")

    expected = counted(train, []).agg(F.count(F.lit(1)).alias("_e"))
    daily = counted(rows.withColumn("day", F.to_date(ts)), ["day"]).agg(
        F.count(F.lit(1)).alias("_a"), F.sum("value").alias("_sum")
    )
    # At most buckets rows per feature and day from here on.
    days = daily.groupBy("feature", "day").agg(F.sum("_a").alias("n"), F.sum("_sum").alias("_sum"))
    totals = expected.groupBy("feature").agg(F.sum("_e").alias("_all"))
    every = profile.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bucket"))
    grid = (
        days.join(every, "feature").join(totals, "feature")
        .join(expected, ["feature", "bucket"], "left")
    )
    shares = grid.join(daily.select("feature", "day", "bucket", "_a"), ["feature", "day", "bucket"], "left").select(
        "feature", "day", "n", "_sum",
        F.greatest(F.coalesce("_a", F.lit(0)) / F.col("n"), F.lit(floor)).alias("a"),
        F.greatest(F.coalesce("_e", F.lit(0)) / F.col("_all"), F.lit(floor)).alias("e"),
    )
    psi = shares.groupBy("feature", "day", "n", "_sum").agg(
        F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi")
    )
    shift = F.when(F.col("std") != 0, (F.col("_sum") / F.col("n") - F.col("mean")) / F.col("std"))
    return psi.join(profile.select("feature", "mean", "std"), "feature").select(
        "feature", "day", "n", shift.alias("mean_shift"), "psi"
    )
