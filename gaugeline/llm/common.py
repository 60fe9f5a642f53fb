"""Small pieces shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: Bits that `monotonically_increasing_id` leaves for the row within its partition.
ROW_BITS = 33


def named(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(named(name).cast("string"), F.lit(""))


def key_text(name: str) -> Column:
    """The key as text, null as the empty string."""
    return F.coalesce(named(name).cast("string"), F.lit(""))


def draw(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def count_words(text: Column) -> Column:
    """Runs of characters other than space and the controls 9 to 13."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def numbered(df: DataFrame, order: list[str], name: str, label: str) -> DataFrame:
    """`df` with its global position in ascending `order`, from 0, without a single-task sort.

    Rows are dealt by range and sorted in their partitions; each position is the row's
    place in its partition plus the rows of the partitions before it. Only one count per
    partition is gathered. `df` is evaluated twice (once to find the ranges).
    """
    mask = (1 << ROW_BITS) - 1
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(dealt.withColumn("_place", F.monotonically_increasing_id()), label)
    part = F.shiftright("_place", ROW_BITS)
    counts = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    starts, total = [], 0
    for number, count in counts:
        starts.append((number, total))
        total += count
    bases = df.sparkSession.createDataFrame(starts, "_part long, _base long")
    return (
        placed.withColumn("_part", part).join(F.broadcast(bases), "_part")
        .withColumn(name, F.col("_base") + F.col("_place").bitwiseAND(F.lit(mask)))
        .drop("_part", "_base", "_place")
    )


def new_name(label: str) -> str:
    """A column name that no input has."""
    return f"_{label}_{uuid.uuid4().hex}"


def flagged(rows: DataFrame, key: Column, wanted: DataFrame, name: str, most_keys: int = 1_000_000, most_maps: int = 16_384) -> DataFrame:
    """`rows` with a boolean column `name`: whether `key`, a long, is in the one column of `wanted`; exact, and `rows` stay where they are.

    Up to `most_keys` keys are broadcast as they are. More keys become bitmaps of 32,768 neighbouring keys,
    broadcast up to `most_maps` (64 MB). Only keys that are both many and far apart are joined by a shuffle of `rows`.
    """
    own, found = new_name("key"), new_name("found")
    keys = stage(wanted.select(named(wanted.columns[0]).cast("long").alias(own)).where(named(own).isNotNull()).distinct(), "keys")
    keyed = rows.withColumn(found, key)
    if keys.count() > most_keys:
        bucket, bits = new_name("bucket"), new_name("bits")
        maps = stage(keys.groupBy(F.bitmap_bucket_number(own).alias(bucket)).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias(bits)), "bitmaps")
        if maps.count() <= most_maps:
            place = F.bitmap_bit_position(found)
            byte = F.conv(F.hex(F.substr(named(bits), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            hit = F.floor(byte / F.pow(F.lit(2), place % 8)).cast("int") % 2 == 1
            joined = keyed.join(F.broadcast(maps), F.bitmap_bucket_number(found) == named(bucket), "left")
            return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop(found, bucket, bits)
        joined = keyed.join(keys, named(found) == named(own), "left")
    else:
        joined = keyed.join(F.broadcast(keys), named(found) == named(own), "left")
    return joined.withColumn(name, named(own).isNotNull()).drop(found, own)
