"""Skip list and forms against plain slicing."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from gaugeline.llm import fim

WORD = r"[^\x20\x09-\x0D]+"


@pytest.mark.parametrize("size", [0, 1, 15, 16, 17, 300, 4097, 70_001])
def test_every_rank_is_reached(size):
    lengths = np.random.default_rng(size).integers(1, 9, size)
    lanes, ends = fim.SkipList(lengths), np.concatenate([[0], np.cumsum(lengths)])
    for rank in {0, size, *random.Random(size).sample(range(size + 1), min(size + 1, 400))}:
        assert lanes.place(rank) == ends[rank]


def test_lanes_shrink_and_keep_their_widths():
    lanes = fim.SkipList(np.arange(1, 50_001)).lanes
    assert [len(u) for u, _, _ in lanes] == sorted((len(u) for u, _, _ in lanes), reverse=True) and len(lanes) >= 4
    assert {(int(u.sum()), int(p.sum())) for u, p, _ in lanes} == {(50_000, 50_000 * 50_001 // 2)}
    assert max(np.diff(below).max() for _, _, below in lanes[1:]) < 2 * fim.STRIDE


def test_units_tile_the_text():
    assert fim.unit_lengths(" ab  c\nd ", WORD).tolist() == [5, 2, 2]
    assert fim.unit_lengths("   ", WORD).tolist() == [3] and fim.unit_lengths("", WORD).tolist() == []
    assert fim.unit_lengths("aé🙂\n").tolist() == [1] * 4


def plain_version(key, text):
    h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[8 * n:8 * n + 8], 16) for n in range(4)]
    if not text or any(c in text for c in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    p, m, s = text[:a], text[a:b], text[b:]
    return ("spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_outputs_and_round_trip(spark):
    rng = random.Random(3)
    parts = ["a", "é", "🙂", "\n", " ", "<", "P>", "<S", ">", "\r\n", "日本", "</s>"]
    texts = [None, "", "<P>x", "a<S>", "x<M>y", "é‍", "w " * 60_000]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, "of no key")]
    docs = spark.createDataFrame([(k, t, "clash", 1, "x") for k, t in rows], "doc_id long, text string, form string, n int, `a.b` string")
    got = collections.defaultdict(list)
    for r in fim.restored(fim.transformed(docs)).collect():
        got[r["doc_id"]].append(r)
    for key, text in rows:
        body = text or ""
        form, low, width, output = plain_version("" if key is None else key, body)
        for r in got[key]:
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) == (
                len(body), form, low, width, output, body)
    assert {r["form"] for rs in got.values() for r in rs} == {"plain", "psm", "spm"} and len(got[7]) == 2
    assert fim.transformed(docs.limit(0)).count() == 0


def test_cuts_between_words(spark):
    text = " one two\nthree   four five "
    docs = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    edges = {0, len(text), *[m.start() for m in re.finditer(WORD, text)][1:]}
    for r in fim.restored(fim.transformed(docs, pattern=WORD)).collect():
        assert r["n"] == 5 and r["restored"] == text
        assert r["form"] == "plain" or {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= edges


def test_missing_marks_give_null(spark):
    made = spark.createDataFrame([("psm", "<P>a<S>b"), ("spm", "<P>a<S>b<M>c"), ("psm", "<P>a<S>b<M>c")], "form string, output string")
    assert [r["restored"] for r in fim.restored(made).collect()] == [None, None, "acb"]
