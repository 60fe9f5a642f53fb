"""Vector links against all cosines."""

import numpy as np
import pytest
from gaugeline.llm import pqlinks
from pyspark.sql import functions as F


def brute(rows, least=0.9):
    """{row number: (n_links, component)} of (id, vector) rows."""
    good = [n for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    label = {n: n for n in good}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n
    count = dict.fromkeys(range(len(rows)), 0)
    for size in {len(rows[n][1]) for n in good}:
        at = [n for n in good if len(rows[n][1]) == size]
        x = np.array([rows[n][1] for n in at], float)
        x /= np.abs(x).max(1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in np.argwhere(np.triu(x @ x.T >= least, 1)):
            count[at[a]] += 1
            count[at[b]] += 1
            label[max(top(at[a]), top(at[b]))] = min(top(at[a]), top(at[b]))
    group = {}
    for n in good:
        group.setdefault(top(n), []).append(rows[n][0])
    return [(i, count[n], min(group[top(n)]) if n in label else i) for n, (i, _) in enumerate(rows)]


def found(df, **settings):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in pqlinks.near_vectors(df, **settings).collect()), key=repr)


@pytest.fixture(scope="module")
def cloud():
    """Random vectors, pairs on both sides of the limit, a chain, a hot group of near copies, exact copies."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2500, 32))
    for n in range(0, 800, 2):
        x[n + 1] = x[n] / np.linalg.norm(x[n]) + rng.normal(size=32) * rng.uniform(0.02, 0.12)
    x[800] = rng.normal(size=32)
    for n in range(801, 840):
        x[n] = x[n - 1] / np.linalg.norm(x[n - 1]) + rng.normal(size=32) * 0.05
    x[900:1700] = rng.normal(size=32) + rng.normal(size=(800, 32)) * 0.22
    x[1700:2000] = x[5]
    return [(int(i), [float(v) for v in row]) for i, row in zip(rng.permutation(len(x)), x.astype(np.float32))]


def test_links_equal_all_cosines(spark, cloud):
    df = spark.createDataFrame(cloud, "vec_id long, embedding array<float>")
    # All lists visited: nothing but the bound of the codes rules pairs out.
    assert found(df, rows_per_list=100, deviations=1e9) == sorted(brute(cloud), key=repr)


def test_recall_of_the_visited_lists(spark, cloud):
    df = spark.createDataFrame(cloud, "vec_id long, embedding array<float>")
    want = {i: n for i, n, _ in brute(cloud)}
    got = {i: n for i, n, _ in found(df, rows_per_list=100)}
    assert all(got[i] <= n for i, n in want.items()) and sum(got.values()) > 0.995 * sum(want.values())


def test_lists_are_ruled_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    model = pqlinks.fit_model(x, 40, 4, 16)
    own, span, _, missed = model.encode(x)
    radii = np.array([span[own == n].max(initial=0) for n in range(len(model.centres))])
    wanted = pqlinks.probed_lists(x, own, model, radii, np.sqrt(0.2), np.sqrt(0.2))
    near = x @ x.T >= 0.9
    for a, b in np.argwhere(near):
        assert own[b] < own[a] or wanted[a, own[b]]
    assert wanted.sum(1).mean() < 20 and missed.max() < 1


def test_blocks_of_a_hot_list(spark, cloud, monkeypatch):
    monkeypatch.setattr(pqlinks, "BLOCK", 64)
    df = spark.createDataFrame(cloud[900:1400], "vec_id long, embedding array<float>")
    model = pqlinks.fit(pqlinks.classes(df, "vec_id", "embedding"), 1, 8, 400, 32)
    found_ = pqlinks.classes(df, "vec_id", "embedding")
    indexed = pqlinks.index(found_, model)
    made = pqlinks.links(indexed, pqlinks.visits(indexed, model, np.full(1, 2.0), 0.9, 4.0), model, 0.9, block=64)
    counts = {r["a"]: r["n"] for r in made.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")).collect()}
    ids = {r["node"]: r["id"] for r in found_.collect()}
    assert {ids[a]: n for a, n in counts.items()} == {i: n for i, n, _ in brute(cloud[900:1400]) if n}


def test_odd_vectors(spark):
    a, b = [1.0, 2.0, 0.0], [1.0, 2.0, 0.1]
    rows = [(1, a), (2, b), (2, a), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [float("nan")] * 3),
            (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (None, a), (11, [-1.0, -2.0, 0.0]), (12, [1e300, 2e300, 0.0]),
            (13, [1e-300, 2e-300, 0.0]), (0, [0.0, -0.0, 5.0]), (14, [-0.0, 0.0, 5.0]), (15, [3.0])]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<double>, label int, kept string, node int")
    assert found(df) == sorted(brute(rows), key=repr)
    assert found(df.limit(0)) == [] and found(df.where("vec_id = 3")) == [(3, 0, 3)]
    kept = {(r["vec_id"], r["kept"]) for r in pqlinks.near_vectors(df).collect()}
    assert {(None, True), (1, True), (2, False), (14, False), (10, False)} <= kept
