"""Quality rules: plain counts, then a hashed n-gram likelihood ratio that every document must pass.

Words and word pairs are hashed into two halves of `buckets` counts. `raw` counts all
documents, `target` those of all trusted labels (quality 1, not toxic), smoothed
towards raw by one pseudo-count per bucket. A document's score is the mean over its n-grams
of ln(target share / raw share); it is kept if the counts do not fail it and the score is at
least `least`. The default limit was found by looking at labelled rows of one synthetic corpus; for another, take a low
percentile of the `llr` of its trusted rows.

All work is done by built-in functions: n-grams are hashed inside each row, and counting is one
aggregate with at most `buckets` rows per task. Which documents are trusted is looked up where they are
(`common.flagged`), for any number of labels, so no text and no hash of one is shuffled. The finished table (one
number per bucket) enters the plan as a constant, so scoring shuffles nothing either.

Defined cases: a null text has no words, counts of 0, score 0 and fails; without trusted
labels all scores are 0; repeated rows are counted and scored as separate rows; an empty table
gives an empty result; further columns are left alone and not returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flagged, named, text_or_empty

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def repeated_words(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more in `grams` (window hashes by position)."""
    def covered(ordered: Column) -> Column:
        def same(n: Column, x: Column) -> Column:
            return F.coalesce(F.get(ordered, n)["h"] == x["h"], F.lit(False))

        def position(x: Column, i: Column) -> Column:
            return F.when(same(i - 1, x) | same(i + 1, x), x["p"])
        found = F.sort_array(F.array_compact(F.transform(ordered, position)))
        return F.get(F.transform(F.array(found), lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda total, n: total + n)), F.lit(0))
    ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    count = F.get(F.transform(F.array(ordered), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(count).cast("long")


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column) -> Column:
    firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))


def _grams(hashes: Column, buckets: int) -> Column:
    half = buckets // 2
    pairs = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0)))
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(half)).cast("int"))
    double = F.transform(pairs, lambda h, i: (
        F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(half)) + half).cast("int"))
    return F.concat(single, double)


def gram_weights(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = 1 << 14,
) -> list[float]:
    """ln(target share / raw share) per bucket."""
    trusted = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).where(named(key).isNotNull())
    bodies = docs.select(named(key).cast("long").alias("_key"), text_or_empty(text).alias("_body"))
    marked = flagged(bodies, F.col("_key"), trusted.select(named(key).alias("_trusted")), "good")
    hashed = marked.select("good", _hashed(words_of(F.col("_body"))).alias("_h"))
    grams = hashed.select("good", F.explode(_grams(F.col("_h"), buckets)).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("raw"), F.count_if("good").alias("target")).collect()
    raw, target = [1.0] * buckets, [0.0] * buckets
    for row in counted:
        raw[row["gram"]] += row["raw"]
        target[row["gram"]] += row["target"]
    everything, chosen = sum(raw), sum(target)
    shares = [r / everything for r in raw]
    return [round(math.log((t + buckets * s) / (chosen + buckets) / s), 9) for t, s in zip(target, shares)]


def apply_rules(
    docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text", least: float = -0.08,
) -> DataFrame:
    """Per row: key, the counts, `base_failed`, `llr` (mean over n-grams) and `kept`."""
    buckets = len(weights)
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    body = text_or_empty(text)
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    read = docs.select(
        named(key).alias("_key"), words_of(body).alias("_w"), lines.alias("_lines"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    hashed = read.select(
        "_key", "n_symbols", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _hashed(F.col("_w")).alias("_h"))
    total = F.aggregate(_grams(F.col("_h"), buckets), F.lit(0.0), lambda a, g: a + F.get(table, g))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    made = hashed.withColumn("_g", _windows(F.col("_h"))).select(
        "*", repeated_words(F.col("_g")).alias("n_repeat_words"), (total / n_grams).alias("llr"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return made.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr",
        failed.alias("base_failed"), (~failed & (F.col("llr") >= least)).alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    return apply_rules(docs, gram_weights(docs, labels), **settings)
