"""Benchmark decontamination by winnowed fingerprints, extended to exact spans.

A window is `span` consecutive words of an item, or the whole item if it is shorter. Both
sides hash every k-gram (k = 5, or the window's length if less) and keep the smallest of
each run of `length - k + 1`; two texts that share a window share the smallest k-gram in
it, so every shared window leaves a common fingerprint. The join of fingerprints gives, per
document position, the only start at which the window can lie; the words around the position
are carried along and compared there by a 64-bit hash of the whole window.

One pass over the documents: fingerprints are chosen and exploded inside each row, joined with the
benchmark's (broadcast if they are at most `broadcast_rows`, else a shuffled join), and only
confirmed hits and one row per document are aggregated. No pairs of documents are formed.

Words are runs of 0-9, a-z and characters above 0x7F after lower-casing A-Z.

Defined cases: null or wordless texts have no words, no hits and no items; wordless items have
no window; rows with equal key and text are judged once and returned as often as they occur; an
empty table on either side gives no hits; further columns are left alone and not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import flagged, named, new_name, text_or_empty

BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 5


def word_hashes(text: Column) -> Column:
    """Hashes of the words; only A-Z are lower-cased, so words beyond ASCII take the slower path."""
    plain = F.array_remove(F.split(text, BREAKS), "")
    return F.transform(plain, lambda w: F.xxhash64(
        F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER))))


def _gram_hashes(words: Column, k: int) -> Column:
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, *[F.get(words, i + n) for n in range(1, k)]))


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text", span: int = 13) -> DataFrame:
    """Distinct `(item, len, window, k, gram, offset)`: each window with its fingerprint and where it lies."""
    read = items.select(named(item).cast("string").alias("item"), word_hashes(text_or_empty(text)).alias("w"))
    size = F.least(F.size("w"), F.lit(span))
    cut = read.where(F.size("w") > 0).select(
        "item", size.alias("len"), F.explode(F.transform(
            F.sequence(F.lit(1), F.size("w") - size + 1), lambda s: F.slice(F.col("w"), s, size))).alias("words"))
    k = F.least(F.col("len"), F.lit(GRAM))
    grams = F.transform(F.sequence(F.lit(1), F.col("len") - k + 1), lambda s: F.slice(F.col("words"), s, k))
    hashed = F.transform(grams, lambda g: F.xxhash64(*[F.get(g, F.lit(i)) for i in range(GRAM)]))
    made = cut.select("item", "len", F.xxhash64("words").alias("window"), k.alias("k"), hashed.alias("grams"))
    least = F.array_min("grams")
    return made.select("item", "len", "window", "k", least.alias("gram"),
                       (F.array_position("grams", least) - 1).cast("int").alias("offset")).distinct()


def _chosen(words: Column, grams: Column, lows: Column | None, k: int, width: int, back: int, span: int) -> Column:
    """Positions whose k-gram is the smallest of some run of `width`, with the words around them."""
    def keep(h: Column, p: Column) -> Column:
        if lows is None:
            return F.lit(True)
        return F.greatest(*[F.get(lows, p - n) for n in range(width)]) == h

    def around(p: Column) -> Column:
        low = F.greatest(p - back, F.lit(0))
        return F.struct(F.lit(k).alias("k"), F.get(grams, p).alias("gram"), p.alias("at"), low.alias("low"),
                        F.slice(words, low + 1, F.lit(back + span)).alias("near"))
    places = F.transform(F.filter(F.transform(grams, lambda h, p: F.struct(h.alias("h"), p.alias("p"))),
                                  lambda x: keep(x["h"], x["p"])), lambda x: x["p"])
    return F.transform(places, around)


def _lows(grams: Column, width: int) -> Column:
    firsts = F.slice(grams, F.lit(1), F.greatest(F.size(grams) - (width - 1), F.lit(0)))
    return F.transform(firsts, lambda h, i: F.least(h, *[F.get(grams, i + n) for n in range(1, width)]))


def _positions(docs: DataFrame, key: str, text: str, schemes: list[tuple[int, int]], span: int) -> DataFrame:
    body = text_or_empty(text)
    rows = docs.select(named(key).alias("_key"), F.xxhash64(body).alias("_text"), word_hashes(body).alias("_w"))
    back = max([span - k for k, _ in schemes if k == GRAM], default=0)
    for k, width in schemes:
        rows = rows.withColumn(f"_g{k}", _gram_hashes(F.col("_w"), k))
        if width > 1:
            rows = rows.withColumn(f"_l{k}", _lows(F.col(f"_g{k}"), width))
    itself = F.array(F.struct(
        F.lit(0).alias("k"), F.lit(0).cast("long").alias("gram"), F.lit(-1).alias("at"), F.lit(0).alias("low"),
        F.array().cast("array<bigint>").alias("near")))
    lists = [_chosen(F.col("_w"), F.col(f"_g{k}"), F.col(f"_l{k}") if width > 1 else None, k, width, back, span)
             for k, width in schemes]
    return rows.select("_key", "_text", F.size("_w").alias("n_words"), F.explode(F.concat(itself, *lists)).alias("f")) \
        .select("_key", "_text", "n_words", "f.*")


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", span: int = 13, share: int = 20, broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Per row: key, `_text` (hash of the text), `n_words, n_hit, spans, items, contaminated`.

    `spans` are the merged runs of hit words; a row is contaminated if any word is hit and
    hits are at least 1/`share` of its words.
    """
    windows = stage(benchmark_windows(items, item, item_text, span), "windows")
    marks = windows.select("k", "gram", "offset", "len", "window").distinct()
    spark = docs.sparkSession
    own = spark.createDataFrame([(0, 0, 0, 0, 0)], "k int, gram long, offset int, len int, window long")
    marks = stage(marks.unionByName(own), "marks")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most `span` values
    schemes = [(n, 1) for n in lengths if n < GRAM]
    if any(n >= GRAM for n in lengths):
        schemes.append((GRAM, min(n for n in lengths if n >= GRAM) - GRAM + 1))
    small = marks.count() <= broadcast_rows
    met = _positions(docs, key, text, schemes, span).join(F.broadcast(marks) if small else marks, ["k", "gram"])
    start = F.col("at") - F.col("offset")
    same = (start >= F.col("low")) & (
        F.xxhash64(F.slice("near", F.greatest(start - F.col("low"), F.lit(0)) + 1, F.col("len"))) == F.col("window"))
    hit = F.when(F.col("k") > 0, F.struct(start.alias("start"), F.col("len"), F.col("window")))
    judged = stage(
        met.where((F.col("k") == 0) | same).groupBy("_key", "_text").agg(
            F.max("n_words").cast("long").alias("n_words"), F.count_if(F.col("k") == 0).alias("copies"),
            F.sort_array(F.collect_set(hit)).alias("hits")), "judged")
    merged = F.aggregate("hits", F.array().cast("array<struct<first:int,end:int>>"), lambda runs, h: F.when(
        (F.size(runs) > 0) & (F.get(runs, F.size(runs) - 1)["end"] >= h["start"]),
        F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(
            F.get(runs, F.size(runs) - 1)["first"].alias("first"),
            F.greatest(F.get(runs, F.size(runs) - 1)["end"], h["start"] + h["len"]).alias("end")))),
    ).otherwise(F.concat(runs, F.array(F.struct(
        h["start"].alias("first"), (h["start"] + h["len"]).alias("end"))))))
    touched = judged.where(F.size("hits") > 0).select("_key", "_text", F.explode(F.array_distinct(
        F.transform("hits", lambda h: F.struct(h["len"].alias("len"), h["window"].alias("window"))))).alias("h"))
    named_items = touched.select("_key", "_text", "h.len", "h.window").join(
        windows.select("len", "window", "item").distinct(), ["len", "window"])
    per_doc = named_items.groupBy("_key", "_text").agg(F.sort_array(F.collect_set("item")).alias("items")) \
        .withColumnRenamed("_key", "_k").withColumnRenamed("_text", "_t")
    found = judged.join(per_doc, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t")), "left")
    found = found.withColumn("spans", merged).withColumn("n_hit", F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"]))
    bad = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return found.select(
        F.col("_key").alias(key), "_text", "n_words", "n_hit", "spans",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), bad.alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def clean_rows(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Rows of `docs` that are not contaminated, columns as in `docs`."""
    own, tie, flag = new_name("key"), new_name("text"), new_name("flag")
    bad = stage(contamination(docs, items, key, text, **settings).where("contaminated")
                .select(F.col(key).alias(own), F.col("_text").alias(tie)).distinct(), "contaminated")
    body = F.xxhash64(text_or_empty(text))
    some = flagged(docs, F.xxhash64(named(key), body), bad.select(F.xxhash64(named(own), named(tie)).alias("hash")), flag)
    doubted = some.where(named(flag)).join(bad, named(key).eqNullSafe(named(own)) & (body == named(tie)), "left_anti")
    return some.where(~named(flag)).unionByName(doubted).select(*map(named, docs.columns))
