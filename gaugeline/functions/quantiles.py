"""Exact percentiles by bracket selection: two narrow passes, no shuffle or copy of the values.

The built-in `percentile` keeps every distinct value of a group in one buffer. Here

1. one aggregate makes a mergeable quantile sketch per column, a few hundred numbers per task. For each wanted
   percentile it gives a bracket: two values between which the exact one is certain to lie, since the bracket is
   wider than the sketch's error bound. About `4 / ACCURACY` of the rows fall in it.
2. one more pass counts the rows between brackets (one row per task and gap) and keeps the values inside brackets
   by distinct value, so heavy repeats cost nothing. Running sums over these few rows give exact ranks.

The input is read twice instead of being shuffled, so it should be a stored table or a cheap view of one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

ACCURACY = 10_000  # a sketched percentile is off by at most 1 / ACCURACY of the rows
MARGIN = 2 / ACCURACY
GRID = 1000        # cuts sketched where the wanted points depend on the count
ENDLESS = float("inf")


def _brackets(wanted: Column, probs: Sequence[float] | None, cuts: Sequence[float]) -> Column:
    """`array<struct<lo, hi>>`, one per wanted point, from the sketched cuts in `_cuts`."""
    few = F.col("_total") < 2 * ACCURACY  # the two ranks of a point may lie beyond the margin: keep all rows

    def cut(at: Column, open_end: float) -> Column:
        return F.when(few, open_end).otherwise(F.coalesce(F.get("_cuts", at), F.lit(open_end)))
    if probs is not None:
        place = {c: n for n, c in enumerate(cuts)}
        return F.array(*[F.struct(
            cut(F.lit(place.get(p - MARGIN, -1)), -ENDLESS).alias("lo"), cut(F.lit(place.get(p + MARGIN, -1)), ENDLESS).alias("hi"))
            for p in probs])
    return F.transform(wanted, lambda p: F.struct(
        cut(F.floor(p * GRID).cast("int") - 1, -ENDLESS).alias("lo"), cut(F.ceil(p * GRID).cast("int") + 1, ENDLESS).alias("hi")))


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] | Callable[[Column], Column],
    groups: Sequence[str] = (),
) -> DataFrame:
    """(groups, feature, idx, p, value, n_values), linear between neighbouring ranks.

    `probs` is a list, or a function from the group's value count to an array
    column when the wanted points depend on the count. `groups` may be report
    classes or as many as units; rows without a group are left out.
    """
    groups = list(groups)
    series = [*groups, "feature"]
    listed = None if callable(probs) else [float(p) for p in probs]
    cuts = [n / GRID for n in range(GRID + 1)] if listed is None else sorted(
        {c for p in listed for c in (p - MARGIN, p + MARGIN) if 0 <= c <= 1} or {0.5})
    there = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    sketches = [f for n, c in enumerate(columns) for f in (
        F.count(there[c]).alias(f"_n{n}"), F.percentile_approx(there[c], cuts, ACCURACY).alias(f"_q{n}"))]
    stacked = F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_n{n}").alias("_total"), F.col(f"_q{n}").alias("_cuts")) for n, c in enumerate(columns)]))
    sketched = df.groupBy(*groups).agg(*sketches).select(*groups, stacked).filter("_total > 0")
    wanted = probs(F.col("_total")) if listed is None else F.array(*[F.lit(p) for p in listed])
    # Small (a row per series), so its stored size lets Spark broadcast it unless there are very many groups.
    plan = stage(sketched.select(
        *series, "_total", wanted.alias("_probs"), _brackets(wanted, listed, cuts).alias("_brackets")), "brackets")
    edges = F.array_sort(F.array_distinct(F.flatten(F.transform("_brackets", lambda b: F.array(b["lo"], b["hi"])))))
    bounds = plan.select(*series, "_brackets", edges.alias("_edges"))

    long = df.select(*groups, *[there[c].alias(c) for c in columns]).unpivot(groups, list(columns), "feature", "value").filter(
        F.col("value").isNotNull())
    value = F.col("value")
    # Even: between two edges; odd: on an edge. Rises with the value.
    slot = F.size(F.filter("_edges", lambda e: e < value)) + F.size(F.filter("_edges", lambda e: e <= value))
    inside = F.exists("_brackets", lambda b: (b["lo"] <= value) & (value <= b["hi"]))
    counted = long.join(bounds, series).groupBy(*series, slot.alias("_slot"), F.when(inside, value).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))

    place = F.col("p") * (F.col("_total") - 1)
    points = (
        plan.select(*series, "_total", F.posexplode("_probs").alias("idx", "p"))
        .select("*", place.alias("_place"), F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))).alias("_rank"))
        .groupBy(*series, "_total").agg(F.collect_list(F.struct("idx", "p", "_place", "_rank")).alias("_points"))
    )
    running = Window.partitionBy(*series).orderBy("_slot", "value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_upto", F.sum("n").over(running)).join(points, series)
    hit = lambda t: (t["_rank"] < F.col("_upto")) & (t["_rank"] >= F.col("_upto") - F.col("n"))
    met = F.filter("_points", hit)
    # A rank outside all brackets would break the sketch's promise: stop rather than return a wrong value.
    kept = F.coalesce("value", F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double"))
    found = placed.filter(F.size(met) > 0).select(*series, kept.alias("value"), "_total", F.inline(met))
    low, high = F.min("value"), F.max("value")
    share = F.max("_place") - F.floor(F.max("_place"))
    return found.groupBy(*series, "idx", "p").agg(
        F.when(low == high, low).otherwise(low + (high - low) * share).alias("value"), F.max("_total").alias("n_values")
    )


def percentile_arrays(
    df: DataFrame, columns: Sequence[str], probs, groups: Sequence[str] = (),
) -> DataFrame:
    """(groups, feature, q): the percentiles of each feature as one sorted array."""
    points = exact_percentiles(df, columns, probs, groups)
    pairs = F.array_sort(F.collect_list(F.struct("idx", "value")))
    return points.groupBy(*groups, "feature").agg(
        F.transform(pairs, lambda s: s["value"]).alias("q"), F.max("n_values").alias("n_values")
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column under the column's own name."""
    points = exact_percentiles(df, columns, [0.5])
    return points.agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in columns])


def approximate_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """One-pass sketch, for when an exact median is not needed."""
    return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns])
