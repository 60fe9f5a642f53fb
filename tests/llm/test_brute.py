"""Operators against plain Python on the small tables."""

import collections
import hashlib
import os
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from gaugeline.llm import mil_quality, queries
from gaugeline.llm import queries as catalog
from gaugeline.llm import setsketch
from gaugeline.llm.bytebpe import PieceEncoder, default_path
from gaugeline.llm.tokenfiles import PerfectHash
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def result(spark, name, key="doc_id"):
    return {r[key]: r for r in catalog.queries()[name](spark, SMALL).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_mix_meets_targets(spark, docs):
    got = result(spark, "op1_pareto_mix")
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in docs.items()}
    assert {i: r["size"] for i, r in got.items()} == sizes
    per, taken = collections.Counter(), collections.Counter()
    for i, r in docs.items():
        per[r["source"]] += sizes[i]
        taken[r["source"]] += got[i]["taken"]
    names = sorted(per)
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest = sum(per.values()) - sum(3 * per[s] for s in capped)
        level = rest / sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * per[s] if s in capped else weight[s] * level for s in names}
        over = {s for s in names if target[s] > 3 * per[s]}
        if not over:
            break
        capped |= over
    for i, r in got.items():
        assert abs(r["target"] - target[docs[i]["source"]]) < 1e-6 and r["taken"] <= 3 * r["size"]
    for s in names:
        largest = max(sizes[i] for i, r in docs.items() if r["source"] == s)
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], largest / 2)
    again = result(spark, "op1_pareto_mix")
    assert {i: r["taken"] for i, r in again.items()} == {i: r["taken"] for i, r in got.items()}


def components(docs, percent=85):
    sets = {}
    for i, r in docs.items():
        w = (r["text"] or "").encode().lower().split()
        k = min(5, len(w))
        sets[i] = frozenset(tuple(w[s:s + k]) for s in range(len(w) - k + 1)) if w else frozenset()
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates_equal_all_pairs(spark, docs):
    got = result(spark, "op2_setsketch")
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == components(docs)


def test_large_groups_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{n}" for n in range(150)]
    rows = []
    for i in range(500):
        words = list(base)
        for at in rng.choice(150, rng.integers(0, 5), replace=False):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    want = components({i: {"text": t} for i, t in rows})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch.near_duplicates(made, block=64).collect()}
    assert got == want


def test_sketches_merge_by_maximum_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64)) for _ in range(2))
    both = np.union1d(a, b)
    merged = np.maximum(setsketch.registers_of(a, 280), setsketch.registers_of(b, 280))
    assert (merged == setsketch.registers_of(both, 280)).all()
    shared = np.union1d(a[:250], b)
    equal = (setsketch.registers_of(both, 280) == setsketch.registers_of(shared, 280)).mean()
    assert abs(equal - len(shared) / len(both)) < 0.08


def test_shards_move_only_into_a_new_one(spark, docs):
    got = result(spark, "op5_rendezvous_shards")
    moved = [r for r in got.values() if r["shard"] != r["grown_shard"]]
    assert moved and all(r["grown_shard"] == 8 for r in moved) and len(moved) < len(got) / 4
    for i, r in got.items():
        body = (docs[i]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))


def test_token_shards_hold_the_ids(spark, docs):
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(default_path())
    got, start = result(spark, "op6_token_shards"), 0
    for i in sorted(docs):
        ids = tool.encode(docs[i]["text"] or "", add_special_tokens=False).ids + [2]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pieces_outlive_a_full_cache(monkeypatch):
    """Ids stay those of the plain tokenizer when the cache turns over in nearly every batch, and when one batch overfills it."""
    from tokenizers import Tokenizer
    monkeypatch.setattr("gaugeline.llm.bytebpe.CACHED", 40)
    rng, plain = np.random.default_rng(7), Tokenizer.from_file(default_path())
    letters, tool = "abcdeßäéÀȳɏzkrst", PieceEncoder(default_path())
    words = ["".join(rng.choice(list(letters), rng.integers(1, 12))) + rng.choice(["", ",", "...", "%"]) for _ in range(400)]
    words += ["Ω1", "x2", "don't", "日本", "ª", "a\u0301", "\u00ad", "ŉ"]
    for size in (5, 20, 200, 5, 20):
        texts = ["".join(w + rng.choice([" ", "\n"]) for w in rng.choice(words, size)) + "end" for _ in range(6)]
        for text, found in zip(texts, tool.encode(texts)):
            assert np.frombuffer(found, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces_encode_like_whole_texts():
    tool, rng = PieceEncoder(default_path()), np.random.default_rng(2)
    parts = [" ", "\n", "a", "É", ".", "\t", "  ", "'s", "12", "\x1c", "x ", "\r", "日", "!", " \n", "<|endoftext|>", "\x85", "🙂"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 15))) for _ in range(1500)]
    for text, found in zip(texts, tool.encode(texts)):
        assert tool.tokenizer.encode(text, add_special_tokens=False).ids == np.frombuffer(found, "<u2").tolist(), text
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(default_path())  # as it comes, added tokens become their own ids
    for text, found in zip(texts, PieceEncoder(default_path(), special=True).encode(texts)):
        assert plain.encode(text, add_special_tokens=False).ids == np.frombuffer(found, "<u2").tolist(), text


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 20_000, dtype=np.uint64))
    assert (np.sort(PerfectHash.build(keys).slots(keys)) == np.arange(len(keys))).all()
    assert len(PerfectHash.build(keys[:0]).slots(keys[:0])) == 0


def test_contamination_equals_window_search(spark, docs):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = collections.defaultdict(set)
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = word.findall((r["text"] or "").translate(LOWER))
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[s:s + n])].add(str(r["item_id"]))
    sizes = {len(k) for k in windows}
    for i, r in result(spark, "op7_winnowing").items():
        w, hit, items = word.findall((docs[i]["text"] or "").translate(LOWER)), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    items |= windows[tuple(w[s:s + n])]
        assert tuple(r) == (i, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w))


def test_classifier_on_held_out_labels(spark):
    """On the middle tables: the smallest ones hold out one bad document only."""
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op8_attention_mil(spark, folder).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(got[r["doc_id"]]["score"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    larger = max(sum(q == v for _, q in held) for v in (0, 1)) / len(held)
    right = sum((s >= 0.5) == (q == 1) for s, q in held) / len(held)
    good, bad = ([s for s, q in held if q == v] for v in (1, 0))
    ordered = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert right > larger + (1 - larger) / 2 and ordered > 0.95


def test_classifier_learns_from_late_passages(spark):
    """What tells bad texts apart comes after thousands of words."""
    head = " ".join(f"plain{n % 50} of the" for n in range(1200))
    docs = [(n, head + (" $$$ ### %%%" * 60 if n % 2 else " and so it goes on" * 36)) for n in range(60)]
    made = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)], "doc_id long, quality int, toxic int")
    model = mil_quality.train(made, labels, F.lit(True))
    found = {r["doc_id"]: r["score"] for r in mil_quality.score(made, model).collect()}
    assert all((s >= 0.5) == (n % 2 == 1) for n, s in found.items())


def test_rule_counts(spark, docs):
    got = result(spark, "op9_ngram_rules")
    for i, r in docs.items():
        text = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, hit = collections.Counter(tuple(w[s:s + 8]) for s in range(len(w) - 7)), set()
        for s in range(len(w) - 7):
            if seen[tuple(w[s:s + 8])] > 1:
                hit.update(range(s, s + 8))
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        g = got[i]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def test_base_scores(spark, docs):
    counts, words = collections.Counter(), {}
    for i, r in docs.items():
        words[i] = (r["text"] or "").encode().lower().split() + [b""]
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words[i])
    total = sum(counts.values())
    got = result(spark, "op10_attention_lm")
    for i, w in words.items():
        base = sum(np.log10((counts[x] + 0.5) / (total + 0.5 * (len(counts) + 1))) for x in w)
        g = got[i]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert abs(g["base_score"] - base) < 1e-6 * abs(base) and g["score"] < 0


def test_pipeline_stages(spark, docs):
    kept = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, kept, SMALL)
        assert out.columns == kept.columns
        if name == "dedup":
            ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
            want = {i for i, (_, c, k) in components({i: docs[i] for i in ids}, 80).items() if k}
            assert {r["doc_id"] for r in out.collect()} == want
        kept = out
    final = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL)
    assert final.count() == kept.count() > 0
