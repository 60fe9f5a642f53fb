"""Reports on prediction pairs `(model, key, y_true, y_pred)`.

Models are few, so each report aggregates per model with map-side combine;
what needs positions or ranks is cut into chunks of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip, edge_index_left, edge_index_right, equal_width_bin, finite, with_place
from ..functions.quantiles import exact_percentiles, percentile_arrays
from ..schema import RUL_EDGES_LEFT, RUL_EDGES_RIGHT, RUL_LABELS
from .eda import box_stats, first_rows
from .ordered import running

KEY_CHUNK = 65536


def error() -> Column:
    return F.col("y_pred") - F.col("y_true")


def absolute_error() -> Column:
    return F.abs(error())


def finite_pairs(pairs: DataFrame) -> DataFrame:
    """Only pairs with both sides present and finite."""
    return pairs.filter(finite("y_true").isNotNull() & finite("y_pred").isNotNull())


def dropped_pairs(pairs: DataFrame) -> DataFrame:
    """(model, dropped): how many pairs `finite_pairs` takes out."""
    bad = finite("y_true").isNull() | finite("y_pred").isNull()
    return pairs.groupBy("model").agg(F.count(F.when(bad, 1)).alias("dropped"))


def smape(factor: float = 2.0, eps: float = 1e-9) -> Column:
    share = F.lit(factor) * absolute_error() / (F.abs("y_true") + F.abs("y_pred") + F.lit(eps))
    return F.lit(100.0) * F.avg(share)


def within(minutes: float) -> Column:
    return F.lit(100.0) * F.avg((absolute_error() <= minutes).cast("double"))


def r_squared(eps: float = 0.0) -> Column:
    """1 - residual over total squares. A constant target gives 1 for a perfect fit, else 0, unless eps is set."""
    residual = F.sum(F.pow(error(), 2))
    total = F.var_pop("y_true") * F.count("y_true") + F.lit(eps)
    flat = F.when(residual == 0, 1.0).otherwise(0.0)
    return F.when(total == 0, flat).otherwise(F.lit(1.0) - residual / total)


def metrics(
    pairs: DataFrame, factor: float = 2.0, eps: float = 1e-9, r2_eps: float = 0.0,
    order_by: str | None = "RMSE", digits: int | None = None,
) -> DataFrame:
    """One row per model: MAE, RMSE, R2, Bias, sMAPE_pct, Pct_within_5min, Pct_within_10min, N."""
    table = finite_pairs(pairs).groupBy("model").agg(
        F.avg(absolute_error()).alias("MAE"),
        F.sqrt(F.avg(F.pow(error(), 2))).alias("RMSE"),
        r_squared(r2_eps).alias("R2"),
        F.avg(error()).alias("Bias"),
        smape(factor, eps).alias("sMAPE_pct"),
        within(5).alias("Pct_within_5min"),
        within(10).alias("Pct_within_10min"),
        F.count(F.lit(1)).alias("N"),
    )
    if digits is not None:
        table = table.select("model", *[
            F.round(c, digits).alias(c) if c != "N" else F.col(c) for c in table.columns if c != "model"
        ])
    return table.orderBy(order_by, "model") if order_by else table


def smape_variants(pairs: DataFrame) -> DataFrame:
    """The three sMAPE forms in use: factor 2 with eps 1e-9 or 1e-6, and no factor with eps 1e-6."""
    return finite_pairs(pairs).groupBy("model").agg(
        smape(2.0, 1e-9).alias("smape_fine"), smape(2.0, 1e-6).alias("smape_coarse"),
        smape(1.0, 1e-6).alias("smape_half"),
    )


def best_model(table: DataFrame, by: str = "RMSE") -> DataFrame:
    return table.agg(F.min_by("model", by).alias("model"), F.min(by).alias(by))


def calibration_fit(pairs: DataFrame) -> DataFrame:
    """Least-squares line of prediction on truth, with R2."""
    return finite_pairs(pairs).groupBy("model").agg(
        F.regr_slope("y_pred", "y_true").alias("slope"),
        F.regr_intercept("y_pred", "y_true").alias("intercept"),
        r_squared().alias("R2"), F.count(F.lit(1)).alias("N"),
    )


def calibration_curve(pairs: DataFrame, most_bins: int = 40) -> DataFrame:
    """(model, bin, y_mean, yp_mean, n): means per quantile bin of the truth.

    Bins are right-closed, the lowest edge included; equal edges merge. Their
    number is the root of the pair count, between 2 and `most_bins`.
    """
    def marks(n: Column) -> Column:
        bins = F.least(F.lit(most_bins), F.greatest(F.lit(2), F.floor(F.sqrt(n)).cast("int")))
        return F.transform(F.sequence(F.lit(0), bins), lambda i: i / bins.cast("double"))

    usable = finite_pairs(pairs)
    # At most most_bins + 1 edges per model.
    edges = percentile_arrays(usable, ["y_true"], marks, ["model"]).select(
        "model", F.array_distinct("q").alias("_edges")
    )
    placed = with_place(usable.join(F.broadcast(edges), "model"), "_passed", "y_true", "_edges", most_bins + 1, False)
    return (
        placed.groupBy("model", F.greatest("_passed", F.lit(1)).alias("bin"))
        .agg(F.avg("y_true").alias("y_mean"), F.avg("y_pred").alias("yp_mean"), F.count(F.lit(1)).alias("n"))
    )


def tolerance_curve(pairs: DataFrame, step: int = 1, most: int = 60) -> DataFrame:
    """(model, tolerance, accuracy_pct) for 0..most: share of errors within the tolerance.

    Errors are counted once per whole minute; the curve is a running sum over
    those counts, not one pass per tolerance.
    """
    minute = F.least(F.ceil(absolute_error()), F.lit(most + 1)).cast("int")
    counted = finite_pairs(pairs).groupBy("model", minute.alias("tolerance")).agg(
        F.count(F.lit(1)).alias("n")
    )
    grid = counted.select("model").distinct().select(
        "model", F.explode(F.sequence(F.lit(0), F.lit(most + 1))).alias("tolerance")
    )
    upto = Window.partitionBy("model").orderBy("tolerance").rowsBetween(Window.unboundedPreceding, 0)
    share = F.lit(100.0) * F.sum(F.coalesce("n", F.lit(0))).over(upto) / F.sum("n").over(
        Window.partitionBy("model")
    )
    return (
        grid.join(counted, ["model", "tolerance"], "left")
        .select("model", "tolerance", share.alias("accuracy_pct"))
        .filter((F.col("tolerance") <= most) & (F.col("tolerance") % step == 0))
    )


def error_box(pairs: DataFrame) -> DataFrame:
    """Box statistics of the absolute error per model."""
    errors = finite_pairs(pairs).select("model", absolute_error().alias("abs_error"))
    return box_stats(errors, ["abs_error"], ["model"]).drop("feature")


def mae_by_bin(pairs: DataFrame, closed: str = "left") -> DataFrame:
    """(model, bin, label, mae, n) for all seven ranges of actual life; NULL mae where empty.

    Left-closed ranges hold 0 and end at 1e9; right-closed ones leave out 0 and
    anything past 9999.
    """
    where = (
        edge_index_left("y_true", RUL_EDGES_LEFT) if closed == "left"
        else edge_index_right("y_true", RUL_EDGES_RIGHT)
    )
    binned = finite_pairs(pairs).groupBy("model", where.alias("bin")).agg(
        F.avg(absolute_error()).alias("mae"), F.count(F.lit(1)).alias("n")
    )
    labels = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(t).alias("label")) for i, t in enumerate(RUL_LABELS)])
    grid = binned.select("model").distinct().select("model", F.inline(labels))
    return grid.join(binned, ["model", "bin"], "left").select(
        "model", "bin", "label", "mae", F.coalesce("n", F.lit(0)).alias("n")
    )


def axis_limits(pairs: DataFrame) -> DataFrame:
    """(axis, low, high): 1st to 99th percentile over all models, 5 % of the span wider each way."""
    stacked = finite_pairs(pairs).select(F.col("y_true").alias("truth"), error().alias("error"))
    points = percentile_arrays(stacked, ["truth", "error"], [0.01, 0.99])
    low, high = F.col("q")[0], F.col("q")[1]
    pad = F.lit(0.05) * (high - low + F.lit(1e-6))
    return points.select(F.col("feature").alias("axis"), (low - pad).alias("low"), (high + pad).alias("high"))


def error_histogram(pairs: DataFrame, bins: int = 60, clipped: bool = False) -> DataFrame:
    """(model, bin, low, high, n, bias): counts of the error over each model's own range.

    `clipped` first brings the errors into the common axis limits of all models.
    """
    errors = finite_pairs(pairs).select("model", error().alias("err"))
    shown = errors.withColumn("_shown", F.col("err"))
    if clipped:
        limits = axis_limits(pairs).filter(F.col("axis") == "error").select(
            F.col("low").alias("_lo"), F.col("high").alias("_hi")
        )
        shown = errors.crossJoin(F.broadcast(limits)).select(
            "model", "err", clip("err", F.col("_lo"), F.col("_hi")).alias("_shown")
        )
    # One row per model.
    ranges = shown.groupBy("model").agg(
        F.min("_shown").alias("_low"), F.max("_shown").alias("_high"), F.avg("err").alias("bias")
    )
    where = equal_width_bin("_shown", F.col("_low"), F.col("_high"), bins)
    counted = shown.join(F.broadcast(ranges), "model").groupBy(
        "model", "_low", "_high", "bias", where.alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
    return counted.select(
        "model", "bin", (F.col("_low") + F.col("bin") * width).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("high"), "n", "bias",
    )


def with_pair_position(pairs: DataFrame) -> DataFrame:
    """`pos` by key within each model's finite pairs, and their count `n_pairs`."""
    chunk = F.floor(F.col("key") / F.lit(KEY_CHUNK)).cast("bigint")
    return running(finite_pairs(pairs), "key", chunk, ["model"], position="pos", total="n_pairs")


def even_sample(pairs: DataFrame, points: int = 400) -> DataFrame:
    """Up to `points` evenly spaced pairs per model, first and last included."""
    placed = with_pair_position(pairs)
    k = F.least(F.col("n_pairs"), F.lit(points))
    spacing = F.when(k > 1, (F.col("n_pairs") - 1) / (k - 1)).otherwise(F.lit(0.0))
    i = F.col("_i")
    # At most `points` wanted positions per model.
    wanted = (
        placed.groupBy("model").agg(F.max("n_pairs").alias("n_pairs"))
        .select("model", "n_pairs", spacing.alias("_step"), F.explode(F.sequence(F.lit(0), k - 1)).alias("_i"))
        .select("model", F.when((i > 0) & (i == F.least("n_pairs", F.lit(points)) - 1), F.col("n_pairs") - 1)
                .otherwise(F.floor(i * F.col("_step"))).alias("pos"))
        .distinct()
    )
    return placed.join(F.broadcast(wanted), ["model", "pos"], "left_semi").select(
        "model", "key", "pos", "y_true", "y_pred"
    )


def residual_sample(pairs: DataFrame, points: int = 500) -> DataFrame:
    return even_sample(pairs, points).select("model", "key", "y_true", error().alias("residual"))


def time_slice(pairs: DataFrame, n: int = 200) -> DataFrame:
    """The first n finite pairs of each model in time order."""
    return first_rows(finite_pairs(pairs), "key", n, ["model"]).select("model", "key", "y_true", "y_pred")


def truth_percentiles(pairs: DataFrame, probs: Sequence[float]) -> DataFrame:
    return exact_percentiles(finite_pairs(pairs), ["y_true"], probs, ["model"])
