"""Stages of the corpus pipeline on planted rows."""

import os

import corpus_pipeline
import pytest
from gaugeline.llm import setsketch

SMALL = "/root/testdata/sf0.001"


def planted():
    """Pairs of 140 shingles that differ in one run of words: similarity from 0.76 to 0.90."""
    rows, alike = [], {}
    for n in range(60):
        words = [f"p{n}w{i}" for i in range(144)]
        other = [*words[:40], *(f"q{n}w{i}" for i in range(4 + n % 14)), *words[44 + n % 14:]]
        rows += [(2 * n, " ".join(words), "a"), (2 * n + 1, " ".join(other), "b")]
        lost = 8 + n % 14
        alike[2 * n + 1] = (140 - lost) / (140 + lost)
    return rows, alike


def test_dedup_takes_pairs_from_080(spark):
    rows, alike = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sum(0.8 <= s < 0.85 for s in alike.values()) >= 15 and min(alike.values()) < 0.8
    want = {i for i, _, _ in rows if alike.get(i, 0) < 0.8}
    assert {r["doc_id"] for r in corpus_pipeline.dedup(spark, docs, "").collect()} == want
    at_85 = {r["doc_id"] for r in setsketch.near_duplicates(docs, percent=85).collect() if r["kept"]}
    assert at_85 == {i for i, _, _ in rows if alike.get(i, 0) < 0.85}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_dedup_equals_all_pairs_at_080(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sets = {}
    for r in docs.collect():
        w = (r["text"] or "").encode().lower().split()
        k = min(5, len(w))
        sets[r["doc_id"]] = {tuple(w[s:s + k]) for s in range(len(w) - k + 1)} if w else set()
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    got = {r["doc_id"] for r in corpus_pipeline.dedup(spark, docs, SMALL).collect()}
    assert got == {i for i in ids if find(i) == i}
