"""Weighted rendezvous hashing of stable keys onto shards, with gapless slots.

A record goes to the shard with the largest `-weight / ln(draw(key, shard))`. The draw
depends on key and shard alone, so another shard takes only the records on which it
outbids all others, and a changed weight moves records only from or to that shard.

Slots number the records of a shard from 0 in the order of a draw over the key. Each shard is
cut into equal pieces of that order, about as many as a piece has rows, so no task sorts a
whole shard; one count per piece gives the slots of the pieces before.

Defined cases: a null key is hashed as the empty text and a null payload as no bytes; rows
with the same key share a shard and get neighbouring slots; an empty table gives an empty
result; further columns are left alone and not returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import draw, key_text, text_or_empty


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins `key`; shards are those with a positive weight."""
    bids = F.array(*[
        F.struct((F.lit(-float(w)) / F.ln(draw(key, F.lit(str(n))))).alias("bid"), F.lit(n).alias("shard"))
        for n, w in enumerate(weights) if w > 0
    ])
    return F.array_max(bids)["shard"]


def shard_records(
    docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
    grown_weights: Sequence[float] | None = None,
) -> DataFrame:
    """Per row: the key, `size` (UTF-8 bytes plus 1), `text_crc32`, `shard`, `slot`, `grown_shard`.

    `grown_weights` gives the shard under another set of weights as well, by default the
    same ones and one more shard of the last weight.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    grown = list(grown_weights or [*weights, weights[-1]])
    body, name = text_or_empty(text), key_text(key)
    rows = stage(docs.select(
        F.col(key), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), rendezvous(name, weights).alias("shard"),
        rendezvous(name, grown).alias("grown_shard"), draw(name, F.lit("slot")).alias("_order"),
    ), "sharded")
    pieces = int((rows.count() / len(weights)) ** 0.5) + 1
    rows = rows.withColumn("_piece", F.floor(F.col("_order") * pieces))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "_piece").count().select(
        "shard", "_piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_piece").orderBy("_order", key, "size", "text_crc32")
    return (
        rows.withColumn("_rank", F.row_number().over(within)).join(starts, ["shard", "_piece"])
        .withColumn("slot", F.col("_start") + F.col("_rank") - 1)
        .select(key, "size", "text_crc32", "shard", "slot", "grown_shard")
    )
