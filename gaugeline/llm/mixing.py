"""Mixing sources to target weights by Pareto order sampling.

Targets: sources, ordered by code point (null last), weigh `weights` in turn and share
`share` of all words; none gets more than `cap` times what it has, the excess going to
the others by weight. A source whose target is r times its size takes floor(r) whole
copies of each document for certain. The rest is an unequal-probability sample: within a
source the inclusion odds grow with a document's importance class (the bit length of its
size unless another is given), scaled so that the expected words meet the rest of the target,
classes that would exceed 1 being certain. Each document draws u from its key and gets the
Pareto rank (u / (1 - u)) / (p / (1 - p)); documents are taken in rank order while they fit the rest. What is
left open is filled in the same order from documents that fit it, in `ROUNDS` rounds in all; in the last one a
document may overshoot if that brings the words nearer to the target. So long documents at the threshold
do not decide how far off a small source is.

No task sorts a source: words are summed per source and rank interval, about as many intervals as the
square root of the source's rows, and only the interval that holds the threshold is ordered.
The threshold then decides every row on its own.

Defined cases: a null or empty text has size 0, and a source without words has target 0;
rows with the same key and size share their draw and are taken alike at the threshold; a
null key draws as the empty text; an empty table gives an empty result. Columns of the input
other than the named ones are returned by `mixed_rows` only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import count_words, draw, key_text, named, numbered, text_or_empty

SEED = "pareto"
ROUNDS = 3


def bit_length(size: Column) -> Column:
    return F.length(F.bin(size))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source: `source, source_size, n, target`. `sizes` has `source, size`."""
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    totals = totals.withColumn("_null", F.col("source").isNull())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = numbered(stage(totals, "sources"), ["_null", "source"], "rank", "ranked").drop("_null")
    ranked = stage(ranked.withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int"))), "weighed")
    limit = F.lit(float(cap)) * F.col("source_size")
    wanted = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, done = None, -1
    while True:
        capped = F.lit(False) if level is None else limit < F.col("weight") * level[0] / F.lit(level[1])
        held, weight, count = ranked.agg(
            F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
            F.count_if(capped)).first()
        if count == done or not weight:
            break
        level, done = (F.lit(float(wanted - held)), float(weight)), count
    if level is None:
        return spark.createDataFrame([], "source string, source_size long, n long, target double")
    fair = F.col("weight") * level[0] / F.lit(level[1])
    return ranked.select("source", "source_size", "n", F.least(limit, fair).alias("target"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return rows.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))) \
        .drop("_source")


def _scaled(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with whole copies, the rest in words, and the scale of the inclusion odds."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size"))
    classes = _with_plan(rows.groupBy("source", "class").agg(F.sum("size").alias("words")), plan)
    above = Window.partitionBy("source").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, 0)
    scale = F.try_divide(F.col("rest") - F.coalesce(F.sum("words").over(above), F.lit(0)),
                         F.sum(F.col("class") * F.col("words")).over(below))
    fitting = classes.withColumn("scale", scale).where(F.col("scale") * F.col("class") <= 1)
    best = fitting.groupBy("source").agg(F.max_by("scale", "class").alias("scale"), F.max("class").alias("top"))
    best = best.withColumnRenamed("source", "_s")
    return plan.join(best, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn(
        "intervals", F.ceil(F.sqrt("n")).cast("double"))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan, inclusion probability `p` and Pareto order `rank` in [0, 1]."""
    both = _with_plan(rows, plan)
    p = F.when(F.col("class") > F.col("top"), F.lit(1.0)).otherwise(F.col("scale") * F.col("class"))
    both = both.withColumn("p", F.coalesce(p, F.lit(0.0)))
    odds = (F.col("u") / (F.lit(1.0) - F.col("u"))) * ((F.lit(1.0) - F.col("p")) / F.col("p"))
    both = both.withColumn("odds", F.when(F.col("p") > 0, odds))
    both = both.withColumn("rank", F.when(F.col("p") > 0, F.col("odds") / (F.lit(1.0) + F.col("odds"))))
    return both.withColumn("interval", F.least(F.floor(F.col("rank") * F.col("intervals")),
                                               F.col("intervals").cast("long") - 1))


def _taken(rounds: int) -> Column:
    """Whether a row was taken in one of the first `rounds` rounds."""
    own, any_ = F.struct("rank", "name", "size"), F.lit(False)
    for k in range(rounds):
        before = F.col("interval") < F.coalesce(F.col(f"cross{k}"), F.col("intervals").cast("long"))
        at = (F.col("interval") == F.col(f"cross{k}")) & F.coalesce(own <= F.col(f"last{k}"), F.lit(False))
        any_ = any_ | (_fits(k) & F.coalesce(before | at, F.lit(False)))
    return any_


def _fits(k: int) -> Column:
    reach = 2 if k + 1 == ROUNDS else 1
    return (F.col("p") > 0) & (F.col("size") > 0) & (F.col("size") <= reach * F.col(f"gap{k}"))


def _with_round(rows: DataFrame, plan: DataFrame, k: int) -> DataFrame:
    """The plan with round `k`: the interval in which the fitting words cross the gap, and the last row taken there."""
    open_rows = _ranked(rows, plan).where(_fits(k) & ~_taken(k)).withColumn("gap", F.col(f"gap{k}"))
    sums = open_rows.groupBy("source", "interval").agg(F.sum("size").alias("words"), F.max("gap").alias("gap"))
    order = Window.partitionBy("source").orderBy("interval").rowsBetween(Window.unboundedPreceding, 0)
    sums = stage(sums.withColumn("after", F.sum("words").over(order)), "intervals")
    crossing = sums.where("after > gap").groupBy("source").agg(
        F.min("interval").alias("cross"), F.min_by(F.col("after") - F.col("words"), "interval").alias("start"))
    found = crossing.withColumnRenamed("source", "_source")
    inside = open_rows.join(found, F.col("source").eqNullSafe(F.col("_source")) & (F.col("interval") == F.col("cross")))
    upto = Window.partitionBy("source").orderBy("rank", "name", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("after", F.col("start") + F.sum("size").over(upto))
    near = 2 * F.col("after") - F.col("size") <= 2 * F.col("gap") if k + 1 == ROUNDS else F.col("after") <= F.col("gap")
    ends = inside.where(near).groupBy("source").agg(
        F.max(F.struct("rank", "name", "size")).alias(f"last{k}"), F.max("after").alias("reached"))
    whole = sums.groupBy("source").agg(F.max("after").alias("all")).withColumnRenamed("source", "_s")
    same = [F.col("_s").eqNullSafe(F.col(c)) for c in ("_c", "_e")]
    done = whole.join(crossing.withColumnRenamed("source", "_c"), same[0], "left") \
        .join(ends.withColumnRenamed("source", "_e"), same[1], "left")
    used = F.when(F.col("cross").isNull(), F.col("all")).otherwise(F.coalesce("reached", "start"))
    done = done.select("_s", F.col("cross").alias(f"cross{k}"), f"last{k}", used.alias("_used"))
    joined = plan.join(done, F.col("source").eqNullSafe(F.col("_s")), "left")
    return stage(joined.withColumn(f"gap{k + 1}", F.greatest(
        F.col(f"gap{k}") - F.coalesce("_used", F.lit(0)), F.lit(0.0))).drop("_s", "_used"), "plan")


def _slim(docs: DataFrame, key: str, text: str, source: str, importance: Column | None) -> list[Column]:
    size = count_words(text_or_empty(text))
    return [
        key_text(key).alias("name"), named(source).cast("string").alias("source"), size.alias("size"),
        (bit_length(size) if importance is None else importance).cast("long").alias("class"),
        draw(key_text(key), F.lit(SEED)).alias("u"),
    ]


def _decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return _ranked(rows, plan).withColumn("copies", F.col("whole") + _taken(ROUNDS).cast("long")) \
        .withColumn("taken", F.col("copies") * F.col("size"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.0, cap: float = 3.0, importance: Column | None = None,
    carry: bool = False,
) -> DataFrame:
    """Per row: key, `size, source_size, target, p, copies, taken`; with `carry` also the input row as `_row`.

    `importance` is a column of `docs` with few distinct positive integers. With `carry`
    the texts are read a second time, which spares shuffling them.
    """
    made = _slim(docs, key, text, source, importance)
    rows = stage(docs.select(named(key).alias("_key"), *made), "sizes")
    plan = stage(_scaled(rows, source_targets(rows, weights, share, cap)).withColumn("gap0", F.col("rest")), "plan")
    for k in range(ROUNDS):
        plan = _with_round(rows, plan, k)
    if carry:
        rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("_row"), named(key).alias("_key"), *made)
    return _decided(rows, plan).select(
        *(["_row"] if carry else []), F.col("_key").alias(key), "size", "source_size", "target", "p", "copies", "taken")


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each input row as often as it is taken, columns as in `docs`."""
    decided = mix(docs, carry=True, **settings).where("copies > 0")
    return decided.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")
