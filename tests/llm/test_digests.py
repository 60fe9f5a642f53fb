"""Archives, shards and rule scores recomputed by plain Python over the small tables."""

import base64
import collections
import hashlib
import math
import os
import re
import struct
import zipfile
import zlib

import numpy as np
import pytest
import xxhash
from gaugeline.llm import attention_lm as lm
from gaugeline.llm import ngram_rules, queries, warczip

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_archives_equal_digests_of_all_pages(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    largest = {}
    for page, body in pages.items():
        largest[body] = max(page, largest.get(body, page))
    got = {r["page_id"]: tuple(r)[1:] for r in queries.op4_zip_warc(spark, SMALL).collect()}
    assert got == {
        page: (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if largest[body] == page else "revisit",
               None if largest[body] == page else largest[body]) for page, body in pages.items()}


def test_directory_beyond_65535_members(tmp_path):
    path = f"{tmp_path}/wide.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        for n in range(66_000):
            out.writestr(f"m{n}", str(n * 7))
    archive = warczip.Archive(path)
    assert len(archive.members) == 66_000
    assert all(archive.read(f"m{n}") == str(n * 7).encode() for n in (0, 1, 65_534, 65_535, 65_536, 65_999))
    assert archive.read("m65999", 2, 3) == str(65_999 * 7).encode()[2:5]


def draw(*parts):
    return (int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)


def test_shards_and_slots_equal_all_bids(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op5_rendezvous_shards(spark, SMALL).collect()}

    def winner(key, shards):
        return max((-1 / math.log(draw(key, str(n))), n) for n in range(shards))[1]
    order = collections.defaultdict(list)
    for i, text in docs.items():
        g = got[i]
        assert (g["shard"], g["grown_shard"]) == (winner(str(i), 8), winner(str(i), 9))
        assert (g["size"], g["text_crc32"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        order[g["shard"]].append((draw(str(i), "slot"), i))
    for members in order.values():
        assert [got[i]["slot"] for _, i in sorted(members)] == list(range(len(members)))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else struct.pack("<q", p), seed)
    return signed(seed)


def test_likelihood_ratios_equal_plain_counts(spark):
    half = (1 << 14) // 2
    docs = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r["quality"] == 1 and not r["toxic"]}
    grams = {}
    for i, words in docs.items():
        h = [spark_hash(w.encode()) for w in words]
        grams[i] = [x % half for x in h] + [half + spark_hash(a, b) % half for a, b in zip(h, h[1:])]
    raw, target = collections.Counter(), collections.Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in trusted:
            target.update(g)
    total, good = sum(raw.values()) + 2 * half, sum(target.values()) + 2 * half
    share = [(1 + raw[n]) / total for n in range(2 * half)]
    weight = [math.log((target[n] + 2 * half * s) / good / s) for n, s in enumerate(share)]
    for r in queries.op9_ngram_rules(spark, SMALL).collect():
        own = grams[r["doc_id"]]
        want = sum(weight[g] for g in own) / max(len(own), 1)
        assert abs(r["llr"] - want) < 1e-7, r["doc_id"]
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= -0.08)
    assert ngram_rules.WINDOW == 8


def dense_score(p, vocab, ids):
    """log10 chance of a text with one head and explicit loops over positions; windows as `lm.windows` cuts them."""
    x, y, score = lm.windows(ids, vocab.end)
    total = 0.0
    for inputs, targets, wanted in zip(x, y, score):
        h = [p["ids"][vocab.row[c]].astype(float) + p["places"][n] for n, c in enumerate(inputs)]
        q, k, v = (np.array([row @ p["qkv"][:, s] for row in h]) for s in (slice(0, 16), slice(16, 32), slice(32, 48)))
        for n in np.flatnonzero(wanted):
            e = np.exp([q[n] @ k[m] for m in range(n + 1)])
            h1 = h[n] + sum(a * v[m] for m, a in enumerate(e / e.sum()))
            h2 = h1 + np.maximum(h1 @ p["inner"] + p["inner_bias"], 0) @ p["outer"]
            logits = h2 @ p["classes"] + vocab.pairs[vocab.klass[inputs[n]]]
            own = vocab.klass[targets[n]]
            total += logits[own] - np.log(np.exp(logits).sum()) + vocab.share[targets[n]]
    return total / np.log(10)


def test_scores_equal_attention_by_position(spark):
    rng = np.random.default_rng(6)
    assert lm.WIDTH == 16
    counts = rng.integers(0, 900, 3000).astype(float)
    size = lm.HEADS + lm.SHARED
    vocab = lm.with_pairs(lm.vocabulary(counts, 2999), rng.integers(0, 50, (size, size)).astype(float))
    flat = lm.initial(9)
    texts = [rng.integers(0, 2999, n).astype("<u2") for n in (0, 1, 31, 32, 33, 57, 200)]
    made = spark.createDataFrame([(n, t.tobytes()) for n, t in enumerate(texts)], "row long, ids binary")
    got = {r["row"]: r["score"] for r in lm.scored(made, vocab, flat).collect()}
    for n, ids in enumerate(texts):
        want = dense_score(lm.unpacked(flat), vocab, ids)
        assert abs(got[n] - want) < 1e-3 * max(1, abs(want))
