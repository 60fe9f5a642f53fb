"""Training sets in time order: matrix, split, imputation, sequences, weights."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip, edge_index_left, finite
from ..functions.quantiles import approximate_medians, medians
from ..functions.timebins import add_time_of_day, day_chunk
from ..schema import LEAKAGE_COLUMNS, RUL_EDGES_LEFT, TARGET, numeric_columns, require_columns
from .clean import finite_columns, only_defined
from .ordered import positions, running

SEQUENCE_LENGTH = 30


def feature_matrix(
    df: DataFrame,
    target: str = TARGET,
    ts: str = "timestamp_bin",
    drop: Sequence[str] = LEAKAGE_COLUMNS,
    features: Sequence[str] | None = None,
    time_of_day: bool = True,
    parts: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """(rows, feature names): rows with a target, features finite or NULL; `parts` (unit keys) are kept, never features.

    Without `features`, every numeric column that does not leak the target is one.
    """
    require_columns(df, [target], "feature table")
    rows = only_defined(df, target)
    if time_of_day and ts in df.columns:
        rows = add_time_of_day(rows, ts)
    if features is None:
        features = numeric_columns(rows, [*drop, target, *parts])
        if not features:
            raise ValueError("no numeric feature column is left after dropping leakage columns")
    else:
        require_columns(rows, features, "feature table")
    kept = [c for c in (*parts, ts, "failure") if c in rows.columns and c not in features and c != target]
    return finite_columns(rows, features).select(*kept, target, *features), list(features)


def cut_of(n: Column, test_size: float = 0.2, rule: str = "round") -> Column:
    """First test position. `round`: nearest to the train share, halves to even; `ceil`: test share rounded up."""
    if rule == "round":
        return F.bround(n * F.lit(1.0 - test_size)).cast("bigint")
    if rule == "ceil":
        return n - F.ceil(n * F.lit(test_size))
    raise ValueError(f"unknown split rule '{rule}'")


def time_split(
    rows: DataFrame, ts: str = "timestamp_bin", test_size: float = 0.2, rule: str = "round", parts: Sequence[str] = (),
) -> DataFrame:
    """`pos` in time order over all units (ties by `parts`), `cut`, and `split` = train / test."""
    placed, n = positions(rows, [ts, *parts], "pos")
    cut = cut_of(F.lit(n).cast("bigint"), test_size, rule)
    return placed.withColumn("cut", cut).withColumn("split", _side("cut"))


def per_series(rows: DataFrame, parts: Sequence[str], ts: str = "timestamp_bin") -> DataFrame:
    """A split table with `pos` and `cut` counted within each unit, as sequences need them.

    The split itself stays that of the whole fleet: a unit's cut is the number of its train rows.
    """
    unit = F.struct(*parts)
    cuts = rows.groupBy(unit.alias("_unit")).agg(F.count_if(F.col("split") == "train").alias("cut"))
    placed = running(rows.drop("pos", "cut"), ts, day_chunk(ts), parts, position="pos")
    return placed.withColumn("_unit", unit).join(cuts, "_unit").drop("_unit")


def split_at(rows: DataFrame, cut: int, ts: str = "timestamp_bin", parts: Sequence[str] = ()) -> DataFrame:
    """As `time_split` with a saved cut; the table must reach it."""
    placed, n = positions(rows, [ts, *parts], "pos")
    if cut <= 0 or cut > n:
        raise ValueError(f"cut {cut} does not lie within the table's {n} rows")
    return placed.withColumn("cut", F.lit(cut).cast("bigint")).withColumn("split", _side("cut"))


def _side(cut: str) -> Column:
    return F.when(F.col("pos") < F.col(cut), "train").otherwise("test")


def train_medians(rows: DataFrame, features: Sequence[str], exact: bool = True) -> DataFrame:
    """One row of medians over the train side only."""
    train = rows.filter(F.col("split") == "train")
    return medians(train, features) if exact else approximate_medians(train, features)


def impute(rows: DataFrame, features: Sequence[str], fills: dict[str, float] | DataFrame) -> DataFrame:
    """NULL features to their fill: known values, or a one-row table with a column per feature."""
    chosen = set(features)
    if isinstance(fills, dict):
        known = {c: "NULL" if fills.get(c) is None else f"{float(fills[c])!r}D" for c in features}
        source = rows
    else:
        known = {c: f"`_fill_{c}`" for c in features}
        source = rows.crossJoin(F.broadcast(fills.selectExpr(*[f"`{c}` AS `_fill_{c}`" for c in features])))
    return source.selectExpr(*[
        f"CAST(coalesce(`{c}`, {known[c]}) AS DOUBLE) AS `{c}`" if c in chosen else f"`{c}`" for c in rows.columns
    ])


def saved_fills(rows: DataFrame, features: Sequence[str], saved: dict[str, float]) -> dict[str, float]:
    """Saved medians; a feature they lack gets its train median, or 0 if that is not finite."""
    fills = {c: saved[c] for c in features if c in saved}
    absent = [c for c in features if c not in saved]
    if absent:
        found = train_medians(rows, absent).select(
            *[F.coalesce(finite(c), F.lit(0.0)).alias(c) for c in absent]
        )
        fills.update(found.first().asDict())
    return fills


def sequence_split(sequences: DataFrame) -> DataFrame:
    """Sequences belong to the side of their target row, wherever their window starts."""
    return sequences.withColumn("split", _side("cut"))


def sequence_norms(
    rows: DataFrame, features: Sequence[str], length: int = SEQUENCE_LENGTH, floor: float = 1e-6,
) -> DataFrame:
    """One row `<feature>__mean`, `<feature>__std` over all cells of the train windows.

    A row lies in as many train windows as there are train targets among the
    `length` rows after it, so weighting rows by that count replaces building
    the windows. The std is the population's, 0 becomes `floor`.
    """
    first = F.greatest(F.lit(0), F.col("pos") - (length - 1))
    last = F.least(F.col("pos"), F.col("cut") - (length + 1))
    weighted = rows.withColumn("_w", (last - first + 1).cast("double")).filter(F.col("_w") > 0)
    share = F.sum("_w")
    means = weighted.agg(*[(F.sum(F.col("_w") * F.col(c)) / share).alias(f"{c}__mean") for c in features])
    spread = weighted.crossJoin(F.broadcast(means)).agg(
        *[F.first(f"{c}__mean").alias(f"{c}__mean") for c in features],
        *[F.sqrt(F.sum(F.col("_w") * F.pow(F.col(c) - F.col(f"{c}__mean"), 2)) / share).alias(f"{c}__std")
          for c in features],
    )
    return spread.select(
        *[F.col(f"{c}__mean") for c in features],
        *[F.when(F.col(f"{c}__std") == 0, F.lit(floor)).otherwise(F.col(f"{c}__std")).alias(f"{c}__std")
          for c in features],
    )


def normalise(rows: DataFrame, features: Sequence[str], norms: DataFrame) -> DataFrame:
    """Feature columns minus mean over std of the one-row `norms`."""
    chosen = set(features)
    return rows.crossJoin(F.broadcast(norms)).select(*[
        ((F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std")).alias(c) if c in chosen else F.col(c)
        for c in rows.columns
    ])


def validation_tail(
    sequences: DataFrame, share: float = 0.1, length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """Mark the last `share` of the train sequences as `validation` in `split`.

    With fewer train sequences than 1/share the train side stays whole.
    """
    n_train = F.greatest(F.col("cut") - length, F.lit(0))
    tail = F.floor(n_train * F.lit(share))
    in_tail = (F.col("split") == "train") & (F.col("pos") >= F.col("cut") - tail)
    return sequences.withColumn("split", F.when(in_tail, "validation").otherwise(F.col("split")))


def bin_weights(
    train: DataFrame, target: str = TARGET, edges: Sequence[float] = RUL_EDGES_LEFT,
    low: float = 0.3, high: float = 5.0,
) -> DataFrame:
    """(bin, n, weight) for every bin: total / (bins * n), clipped; empty bins count as one row."""
    bins = len(edges) - 1
    counted = train.groupBy(_weight_bin(target, edges).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = train.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    total = train.agg(F.count(F.lit(1)).alias("_all"))
    filled = every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    raw = F.col("_all") / (F.lit(float(bins)) * F.greatest("n", F.lit(1)))
    return filled.crossJoin(F.broadcast(total)).select("bin", "n", clip(raw, low, high).alias("weight"))


def _weight_bin(target: str, edges: Sequence[float]) -> Column:
    return clip(edge_index_left(target, edges), F.lit(0), F.lit(len(edges) - 2)).cast("int")


def add_sample_weight(
    rows: DataFrame, weights: DataFrame, target: str = TARGET, edges: Sequence[float] = RUL_EDGES_LEFT,
) -> DataFrame:
    """`weight` by the target's bin; the weight table has one row per bin."""
    binned = rows.withColumn("bin", _weight_bin(target, edges))
    return binned.join(F.broadcast(weights.select("bin", "weight")), "bin", "left").drop("bin")


def weighted_mse(rows: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", weight: str = "weight") -> DataFrame:
    """mean(w * error^2): divided by the row count, not by the weights."""
    return rows.groupBy("model").agg(
        F.avg(F.col(weight) * F.pow(F.col(y_pred) - F.col(y_true), 2)).alias("weighted_mse")
    )


def flatten_sequence(sequences: DataFrame, column: str = "sequence", out: str = "features") -> DataFrame:
    """Window of feature rows to one ML vector, oldest step first."""
    from pyspark.ml.functions import array_to_vector

    return sequences.withColumn(out, array_to_vector(F.flatten(column)))


def time_folds(cut: int, folds: int) -> list[tuple[int, int]]:
    """(train end, validation end) positions of expanding, time-ordered folds below `cut`."""
    step = cut / (folds + 1)
    marks = [math.floor(step * (i + 1)) for i in range(folds)] + [cut]
    return list(zip(marks[:-1], marks[1:], strict=True))


def checksum(columns: Sequence[str]) -> Column:
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])
