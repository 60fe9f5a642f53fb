"""Token ids in binary shards with a minimal perfect hash index for keyed access.

A shard holds, in this order: 16-bit little-endian ids of its documents, one after another in ascending key
order; their keys, and where each begins; then the index: bit levels with ranks, and per slot a
fingerprint, the document's number and how many documents share the key; last a footer with the
section offsets. A key is hashed level by level into bit arrays; a bit is set where exactly one key falls, the
others go on to the next level. The rank of a key's bit is its slot, so n keys take slots 0 to n - 1
and a lookup reads a few words, whatever the shard's size.

Rows are dealt by key range and sorted, so shard after shard the ids are in global key order. Tasks stream:
only keys and offsets of a shard are held. A shard is named by its committed manifest row only.

Defined cases: a null text is encoded as empty (the end id alone); a null key sorts first and is stored
as such; repeated keys are kept as separate documents, ordered by a hash of the text; an empty
table gives no shards; further columns are left alone and not returned.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import importable, new_path, stage
from .bytebpe import default_path, encoder
from .common import named, text_or_empty
from .files import new_file, opened
from .setsketch import MIX, mixed

FORMAT = b"GLTOK001"
FOOTER = "<8sQQQQQQQ"  # format, documents, ids, distinct keys, levels, then starts of keys, offsets, index
NULL_KEY = np.uint64(0xFFFFFFFFFFFFFFFF)
EMPTY_KEY = -(1 << 63)
READ_BYTES = 8 << 20


def _turn(level: int) -> np.ndarray:
    return np.array([level + 1], np.uint64) * MIX


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit key hashes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes.astype(np.uint64), words
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.uint64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        sizes, levels, rest = [], [], hashes
        while len(rest):
            if len(sizes) == 64:
                raise ValueError("two keys have the same 64-bit hash")
            size = -(-3 * len(rest) // 2 // 64) * 64 + 64
            at = mixed(rest + _turn(len(sizes))) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = rest[~alone[at.astype(np.int64)]]
        return cls(np.array(sizes, np.uint64), np.concatenate(levels) if levels else np.empty(0, "<u8"))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 where no level holds it. Hashes that were not built in may get any slot."""
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            bit = mixed(hashes[open_] + _turn(level)) % size + self.starts[level]
            word, low = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            here = (self.words[word] >> low) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << low) - np.uint64(1))
            found[open_[here]] = self.ranks[word[here]] + np.bitwise_count(below[here])
            open_ = open_[~here]
        return found


def key_hashes(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    hashed = mixed(keys.astype(np.uint64) + MIX)
    return np.where(null, NULL_KEY, hashed)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes ^ MIX) >> np.uint64(32)).astype("<u4")


def _write_index(stream, keys: list, lengths: list[int], ids: int) -> None:
    null = np.array([k is None for k in keys], bool)
    values = np.array([EMPTY_KEY if k is None else k for k in keys], "<i8")
    starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<u8")
    hashes = key_hashes(values, null)
    distinct, first, count = np.unique(hashes, return_index=True, return_counts=True)
    table = PerfectHash.build(distinct)
    slot = table.slots(distinct)
    numbers, runs, marks = np.empty(len(slot), "<u4"), np.empty(len(slot), "<u4"), np.empty(len(slot), "<u4")
    numbers[slot], runs[slot], marks[slot] = first, count, _fingerprints(distinct)
    at, places = 2 * ids, []
    for part in ((values, null.astype("u1")), (starts,), (table.sizes.astype("<u8"), table.words, marks, numbers, runs)):
        places.append(at)
        for array in part:
            at += stream.write(array.tobytes()) or array.nbytes
    stream.write(struct.pack(FOOTER, FORMAT, len(keys), ids, len(distinct), len(table.sizes), *places))


class Shard:
    """Random access to one shard; reads its index, never its payload, when opened."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = struct.calcsize(FOOTER)
        form, self.count, self.ids, distinct, levels, keys, starts, index = struct.unpack(FOOTER, self.file.read_at(tail, size - tail))
        if form != FORMAT:
            raise ValueError(f"{uri} is no token shard")
        n = self.count
        self.keys = np.frombuffer(self.file.read_at(8 * n, keys), "<i8")
        self.null = np.frombuffer(self.file.read_at(n, keys + 8 * n), "u1").astype(bool)
        self.starts = np.frombuffer(self.file.read_at(8 * (n + 1), starts), "<u8").astype(np.int64)
        rest = self.file.read_at(size - tail - index, index)
        sizes = np.frombuffer(rest, "<u8", levels)
        words = np.frombuffer(rest, "<u8", int(sizes.sum()) // 64, 8 * levels)
        at = 8 * levels + 8 * len(words)
        self.table = PerfectHash(sizes, words)
        self.marks, self.numbers, self.runs = (np.frombuffer(rest, "<u4", distinct, at + 4 * distinct * k) for k in range(3))

    def find(self, keys: list[int | None]) -> list[range]:
        """Document numbers of each key, empty where the shard lacks it (up to one in 2^32 strangers passes)."""
        null = np.array([k is None for k in keys], bool)
        hashes = key_hashes(np.array([EMPTY_KEY if k is None else k for k in keys], np.int64), null)
        slots, marks = self.table.slots(hashes), _fingerprints(hashes)
        return [range(self.numbers[s], int(self.numbers[s]) + int(self.runs[s])) if s >= 0 and self.marks[s] == m else range(0)
                for s, m in zip(slots, marks)]

    def ids_of(self, number: int) -> np.ndarray:
        first, end = self.starts[number], self.starts[number + 1]
        return np.frombuffer(self.file.read_at(2 * int(end - first), 2 * int(first)), "<u2")

    def spans(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """`(first, end, ids)` of runs of documents of about READ_BYTES."""
        first = 0
        while first < self.count:
            end = int(np.searchsorted(self.starts, self.starts[first] + READ_BYTES // 2, "right")) - 1
            end = min(max(end, first + 1), self.count)
            low, high = int(self.starts[first]), int(self.starts[end])
            yield first, end, np.frombuffer(self.file.read_at(2 * (high - low), 2 * low), "<u2")
            first = end


def write_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 2, special: bool = True,
) -> DataFrame:
    """The staged manifest: `part, path, docs, ids, base` (ids in the shards before it), `first, last` key.

    `special`: strings of added tokens in a text become their reserved ids, as the plain tokenizer has it.
    """
    spark = docs.sparkSession
    importable(spark)
    path, folder = tokenizer or default_path(), new_path(spark, "tokens")
    end = np.array([end_id], "<u2").tobytes()
    rows = docs.select(named(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select(
        "key", "text", F.spark_partition_id().alias("part"))
    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()),
                        ("first", pa.int64()), ("last", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lengths, total, part = [], [], 0, None
        with new_file(folder, ".tok") as (uri, stream):
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    some = batch.slice(at, 500).to_pydict()
                    part = some["part"][0]
                    for name, ids in zip(some["key"], encoder(path, special).encode(some["text"])):
                        stream.write(ids + end)
                        keys.append(name)
                        lengths.append(len(ids) // 2 + 1)
                        total += lengths[-1]
            _write_index(stream, keys, lengths, total)
        if keys:
            yield pa.RecordBatch.from_pylist([{"part": part, "path": uri, "docs": len(keys), "ids": total,
                                              "first": keys[0], "last": keys[-1]}], schema)
    manifest = stage(dealt.mapInArrow(write, "part int, path string, docs long, ids long, first long, last long"), "manifest")
    rows, base = [], 0
    for part, uri, docs_, ids, *ends in sorted(manifest.collect()):  # one row per shard
        rows.append((part, uri, docs_, ids, base, *ends))
        base += ids
    return spark.createDataFrame(rows, "part int, path string, docs long, ids long, base long, first long, last long")


def find_documents(manifest: DataFrame, keys: list[int | None]) -> dict[int | None, list[np.ndarray]]:
    """Ids of all documents of each key: only shards whose key range holds a key are opened, and only its ids are read."""
    found: dict[int | None, list[np.ndarray]] = {k: [] for k in keys}
    for row in manifest.orderBy("part").collect():  # one row per shard
        held = [k for k in found if (row["first"] is None if k is None else
                                     row["last"] is not None and k <= row["last"] and (row["first"] is None or k >= row["first"]))]
        if held:
            shard = Shard(row["path"])
            for key, numbers in zip(held, shard.find(held)):
                found[key] += [shard.ids_of(n) for n in numbers]
    return found


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, found through its shard's index: `key, start, n_tokens, ids_crc32`."""
    importable(manifest.sparkSession)
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    placed = manifest.repartition(max(1, manifest.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                for first, end, ids in shard.spans():
                    keys = [None if shard.null[n] else int(shard.keys[n]) for n in range(first, end)]
                    out = []
                    for n, name, held in zip(range(first, end), keys, shard.find(keys)):
                        if n not in held:
                            raise ValueError(f"the index of {row['path']} does not lead to key {name}")
                        low, high = int(shard.starts[n]), int(shard.starts[n + 1])
                        own = ids[low - int(shard.starts[first]):high - int(shard.starts[first])].astype("<u4")
                        out.append((name, row["base"] + low, high - low, zlib.crc32(own.tobytes())))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return placed.mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long")
