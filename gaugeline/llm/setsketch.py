"""Near-duplicate detection with SetSketch registers.

A document's set holds the hashes of its distinct word shingles. Each shingle starts a Poisson process
of points with rate `registers`, seeded by its hash; every point falls on one register, so a
register's smallest point is exponential in the set's size, as if each shingle had drawn one value per
register. Points above the largest register cannot change it, so generation stops early.
A register keeps the truncated logarithm of its minimum: sketches merge by maximum, and equal
registers get likelier with similarity.

1. Equal sets collapse into a class (smallest id, number of rows do not matter further).
2. Bands of registers are join keys. Every class in a bucket is paired with the bucket's pivot only.
3. Pairs are judged by the joint likelihood of their register comparisons and, where
   that leaves `target` possible, confirmed on the full sets.
4. Confirmed links give components. A bucket whose other members all lie in one component is done; in the
   others members of different components are compared block against block, in tasks of bounded size: first on
   registers, then on the full sets of those with a likely partner. So the pairs within a group never
   become rows, and no bucket or partner is capped.

Recall: with 40 bands of 7 registers a pair at similarity 0.85 shares no bucket with probability
2e-7, and the likelihood step, 0.09 or four deviations below the target, loses one in about 30,000;
either matters only where no other link joins the two. At 0.80, the limit of `one_per_group`, the bands miss one
pair in 12,000, and the likelihood step, there 0.1 below, one in 80,000.

Defined cases: null, empty or blank texts have an empty set and link with nothing; fewer words than a shingle
make one shingle of them all; rows that repeat an id are judged by their own texts (equal rows alike, so
`one_per_group` keeps or drops them together), and a component bears the smallest id of its texts; a null id is
never linked and always kept; ids are cast to long, so text ids must hold numbers; an empty table gives an
empty result; further columns are left alone and not returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import flagged, named, new_name, text_or_empty
from .rows import by_batch

MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multipliers of the hash steps
STEP = np.uint64(0xD1B54A32D192ED03)
BASE = 1.001
TOP = 65534
WORD_CACHE = 150_000
SLACK = 0.1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; arithmetic wraps."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles, A-Z lower-cased."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    width = min(words, len(one))
    rolled = np.zeros(len(one) - width + 1, np.uint64)
    for n in range(width):
        rolled = mixed(rolled * STEP + one[n:len(one) - width + 1 + n] + np.uint64(n + 1))
    return np.unique(rolled)


def registers_of(hashes: np.ndarray, m: int) -> np.ndarray:
    """Register values of one set: floor(1 - log_BASE(minimum)), shifted and kept within 0 to TOP."""
    if not len(hashes):
        return np.zeros(m, np.uint16)
    least, count = np.full(m, np.inf), len(hashes)
    state, reached, drawn = hashes[:, None], np.zeros((count, 1)), 0
    points = -(-int(m * (np.log(m) + 1)) // count)  # about as many as reach every register
    while len(state):
        turn = mixed(state + MIX * np.arange(drawn + 1, drawn + points + 1, dtype=np.uint64))
        gaps = np.log(((turn >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40)  # 40 bits for the gap, 24 for the register
        at = reached - np.cumsum(gaps, axis=1) / m
        place = ((turn & np.uint64(0xFFFFFF)) * np.uint64(m)) >> np.uint64(24)
        np.minimum.at(least, place.astype(np.int64).ravel(), at.ravel())
        drawn += points
        alive = at[:, -1] < least.max()
        state, reached, points = state[alive], at[alive, -1:], 2
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)) + TOP // 2, 0, TOP).astype(np.uint16)


def _log_likelihoods(counts: tuple[np.ndarray, np.ndarray, np.ndarray], share: np.ndarray, j: float) -> np.ndarray:
    """Log-likelihood of similarity `j` for counts of larger, smaller and equal registers.

    `share` is the first set's part of both sizes together. For sets of relative sizes u and v the
    chance of a larger register is p(u - v j), with p(x) = -log_b(1 - x (b - 1) / b).
    """
    larger, smaller, equal = counts
    other = 1 - share
    j = np.minimum(j, np.minimum(share, other) / np.maximum(share, other) * (1 - 1e-9))

    def p(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)
    first, second = p(share - other * j), p(other - share * j)
    return larger * np.log(first) + smaller * np.log(second) + equal * np.log(np.maximum(1 - first - second, 1e-12))


def likely_similar(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Whether the likeliest similarity of each pair of register rows is `least` or more (on a grid from 0.4 in steps of 0.01).

    Pairs whose share of equal registers is SLACK below `least`, seven deviations off, are ruled out beforehand.
    """
    equal = (a == b).sum(-1)
    good = equal >= (least - SLACK) * a.shape[-1]
    a, b = (rows[good] for rows in np.broadcast_arrays(a, b))
    share = n_a[good] / (n_a[good] + n_b[good])
    larger = (a > b).sum(-1).astype(float)
    counts = (larger, a.shape[-1] - larger - equal[good], equal[good].astype(float))
    grid = np.arange(0.4, 1.0, 0.01)
    if len(share):
        best = np.argmax(np.stack([_log_likelihoods(counts, share, j) for j in grid]), axis=0)
        good[good] = grid[best] >= least
    return good


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted distinct arrays."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def linked(x: bytes, y: bytes, percent: int) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    common = overlap(x, y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def sketches(docs: DataFrame, key: str, text: str, words: int, m: int, rows_per_band: int) -> DataFrame:
    """Per row: id, hash of the text, set size, digest of the set, registers and band keys."""
    def make(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("id", "n_shingles", "digest", "registers", "bands")} | {"tie": batch["tie"]}
        for name, body in zip(batch["id"], batch["text"]):
            hashes = shingles(body, words)
            out["id"].append(name)
            out["n_shingles"].append(len(hashes))
            out["digest"].append(xxhash.xxh128_digest(hashes.tobytes()))
            if not len(hashes):
                out["registers"].append(None)
                out["bands"].append([])
                continue
            values = registers_of(hashes, m)
            out["registers"].append(values.tobytes())
            out["bands"].append([
                xxhash.xxh64_intdigest(values[at:at + rows_per_band].tobytes(), at) - (1 << 63)
                for at in range(0, m, rows_per_band)])
        return out
    rows = docs.select(named(key).cast("long").alias("id"), named(text).cast("string").alias("text"), F.xxhash64(text_or_empty(text)).alias("tie"))
    return by_batch(rows, make, "id long, tie long, n_shingles long, digest binary, registers binary, bands array<long>")


def components(edges: DataFrame) -> DataFrame:
    """`(node, label)`: the smallest node of each component of staged `(a, b)`, by labels and pointer jumping."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        parents = labels.select(F.col("node").alias("p"), F.col("label").alias("grand"))
        jumped = stage(stepped.join(parents, stepped["label"] == parents["p"], "left").select(
            "node", "old", F.least("label", F.coalesce("grand", "label")).alias("label")), "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("label <> old").limit(1).count():
            return labels


class _Finder:
    """The state of one run: classes, their sketches, and the links confirmed so far."""

    def __init__(self, classes: DataFrame, texts: DataFrame, bands: int, rows: int, words: int, percent: int, margin: float):
        self.classes, self.texts, self.bands, self.m = classes, texts, bands, bands * rows
        self.words, self.percent, self.margin = words, percent, margin
        self.links: DataFrame | None = None

    def sketches_of(self, ids: DataFrame) -> DataFrame:
        """Staged `(id, n_shingles, registers)` of the classes in `ids`, looked up where they are: registers are too wide to shuffle all."""
        some = flagged(self.classes.select("id", "n_shingles", "registers"), F.col("id"), ids, "wanted").where("wanted")
        return stage(some.drop("wanted"), "registers")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs `(a, b)` of classes whose registers leave the target possible."""
        m, least = self.m, self.percent / 100 - self.margin
        sketch = self.sketches_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
        both = pairs.join(sketch.toDF("a", "n_a", "r_a"), "a").join(sketch.toDF("b", "n_b", "r_b"), "b")
        both = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)

        def make(batch: dict[str, list]) -> dict[str, list]:
            def matrix(c: str) -> np.ndarray:
                return np.frombuffer(b"".join(batch[c]), np.uint16).reshape(-1, m)
            good = likely_similar(matrix("r_a"), matrix("r_b"), np.array(batch["n_a"], float), np.array(batch["n_b"], float), least)
            return {c: [v for v, ok in zip(batch[c], good) if ok] for c in ("a", "b")}
        return by_batch(both, make, "a long, b long")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """`(id, set)` of the classes in `wanted`; only their texts are read into sets."""
        words = self.words

        def make(batch: dict[str, list]) -> dict[str, list]:
            return {"id": batch["id"], "set": [shingles(t, words).tobytes() for t in batch["text"]]}
        held = flagged(self.texts, F.col("id"), wanted, "wanted").where("wanted").dropDuplicates(["id", "text"])
        return stage(by_batch(held.select("id", "text"), make, "id long, set binary"), "sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough."""
        pairs = stage(self.likely(stage(pairs, "pairs")), "likely")
        percent = self.percent
        full = self.sets(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        both = pairs.join(full.toDF("a", "s_a"), "a").join(full.toDF("b", "s_b"), "b")

        def make(batch: dict[str, list]) -> dict[str, list]:
            kept = [linked(x, y, percent) for x, y in zip(batch["s_a"], batch["s_b"])]
            return {c: [v for v, ok in zip(batch[c], kept) if ok] for c in ("a", "b")}
        return stage(by_batch(both, make, "a long, b long"), "links")

    def add(self, found: DataFrame) -> DataFrame:
        """Labels of all classes in links, with those just confirmed."""
        self.links = found if self.links is None else self.links.unionByName(found)
        return components(self.links)


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold two or more components, with labels."""
    known = members.join(labels, members["id"] == labels["node"], "left").select(
        "bucket", "band", "id", F.coalesce("label", "id").alias("label"))
    mixed_buckets = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")) \
        .where("low < high").select("bucket")
    return known.join(mixed_buckets, "bucket", "left_semi")


def _candidates(pdf: pd.DataFrame, m: int, bands: int, least: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the likely pairs between block `x` and block `y` of a bucket.

    A pair belongs to the first band that it shares, so that no other bucket repeats it.
    """
    table = np.frombuffer(b"".join(pdf["registers"]), np.uint16).reshape(-1, m)
    ids, tags, sizes, block = (pdf[c].to_numpy() for c in ("id", "label", "n_shingles", "block"))
    x, y, band = (int(pdf[c].iloc[0]) for c in ("x", "y", "band"))
    right = np.flatnonzero(block == y)
    first, second = [np.empty(0, int)], [np.empty(0, int)]
    for n in np.flatnonzero(block == x):  # rule out by component, size and equal registers, row by row
        near = right[(ids[right] > ids[n]) if x == y else (ids[right] != ids[n])]
        low, high = np.minimum(sizes[near], sizes[n]), np.maximum(sizes[near], sizes[n])
        near = near[(tags[near] != tags[n]) & (100 * low >= percent * high)]
        same = table[near] == table[n]
        near, same = (v[same.sum(1) >= (least - SLACK) * m] for v in (near, same))
        near = near[same.reshape(len(near), bands, m // bands).all(2).argmax(1) == band]
        first.append(np.full(len(near), n))
        second.append(near)
    first, second = np.concatenate(first), np.concatenate(second)
    good = [likely_similar(table[f], table[g], sizes[f].astype(float), sizes[g].astype(float), least)
            for f, g in ((first[at:at + 4096], second[at:at + 4096]) for at in range(0, len(first), 4096))]
    good = np.concatenate([*good, np.empty(0, bool)]).astype(bool)
    return first[good], second[good]


def _block_links(members: DataFrame, finder: _Finder, side: int) -> DataFrame:
    """Confirmed links between components, of all pairs that share a bucket, found block by block.

    A bucket's members are cut into blocks of about `side`, those of its commonest component apart from the rest;
    blocks of the rest meet every block, those of the commonest component do not meet each other. A first pass
    on registers says which members have a likely partner in which meeting; only their sets are sent there, where
    the pairs are confirmed and a spanning part of the links is returned. Pairs never become rows.
    """
    main = members.groupBy("bucket").agg(
        F.mode("label", True).alias("main"))
    cut = members.join(main, "bucket").withColumn("rest", F.col("label") != F.col("main"))
    count = cut.groupBy("bucket").agg(
        F.ceil(F.count_if("rest") / side).cast("int").alias("others"), F.ceil(F.count_if(~F.col("rest")) / side).cast("int").alias("mains"))
    own = F.when(F.col("rest"), F.pmod(F.xxhash64("id"), F.greatest("others", F.lit(1)))).otherwise(
        F.col("others") + F.pmod(F.xxhash64("id"), F.greatest("mains", F.lit(1)))).cast("int")
    last = F.when(F.col("rest"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1
    met = cut.join(count, "bucket").select(
        "bucket", "band", "id", "label", own.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    keyed = met.select("bucket", "band", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "label")
    sketch = finder.sketches_of(members.select("id"))
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, long work: not to be coalesced
    meeting = ["bucket", "x", "y"]
    m, bands, least, percent = finder.m, finder.bands, finder.percent / 100 - finder.margin, finder.percent

    def partnered(pdf: pd.DataFrame) -> pd.DataFrame:
        first, second = _candidates(pdf, m, bands, least, percent)
        return pdf.iloc[np.union1d(first, second)][["bucket", "band", "x", "y", "block", "id", "label"]]
    ddl = "bucket long, band int, x int, y int, block int, id long, label long"
    needed = stage(keyed.join(sketch, "id").repartition(tasks, *meeting).groupBy(*meeting).applyInPandas(partnered, ddl), "partnered")
    full = finder.sets(needed.select("id").distinct())

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, tags, sets = pdf["id"].to_numpy(), pdf["label"].to_numpy(), pdf["set"].to_numpy()
        root: dict[int, int] = {}

        def top(t: int) -> int:
            while root.get(t, t) != t:
                t = root[t]
            return t
        found = []
        for f, g in zip(*_candidates(pdf, m, bands, least, percent)):
            a, b = top(tags[f]), top(tags[g])
            if a != b and linked(sets[f], sets[g], percent):
                root[max(a, b)] = min(a, b)
                found.append((min(ids[f], ids[g]), max(ids[f], ids[g])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    rows = needed.join(sketch, "id").join(full, "id").repartition(tasks, *meeting)
    return stage(rows.groupBy(*meeting).applyInPandas(confirm, "a long, b long"), "links")


def judged(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 85, bands: int = 40,
    rows_per_band: int = 7, margin: float = 0.09, block: int = 256,
) -> DataFrame:
    """Per row: `id, tie` (hash of the text)`, n_shingles, component_id, kept`."""
    made = stage(sketches(docs, key, text, words, bands * rows_per_band, rows_per_band), "sketches")
    linked = made.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stage(linked.groupBy("digest", "n_shingles").agg(
        F.min("id").alias("id"), F.min_by("registers", "id").alias("registers"), F.min_by("bands", "id").alias("bands")), "classes")
    texts = docs.select(named(key).cast("long").alias("id"), named(text).cast("string").alias("text"))
    finder = _Finder(classes, texts, bands, rows_per_band, words, percent, margin)
    members = classes.select("id", F.posexplode("bands").alias("band", "bucket")).repartition("bucket")  # one shuffle serves both sides
    shared = members.groupBy("bucket").agg(
        F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = stage(members.join(shared, "bucket").select("bucket", "band", "id", "pivot"), "members")
    star = members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    labels = finder.add(finder.confirmed(star))
    rest = stage(_open(members.where("id <> pivot"), labels), "open")
    if rest.limit(1).count():
        labels = finder.add(_block_links(rest, finder, block))
    groups = classes.join(labels, classes["id"] == labels["node"], "left").select(
        "digest", "n_shingles", F.coalesce("label", "id").alias("component_id"))
    rows = made.select("id", "tie", "n_shingles", "digest")
    found = rows.join(groups, ["digest", "n_shingles"], "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return found.select("id", "tie", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Per row: key, `n_shingles`, `component_id`, `kept`."""
    return judged(docs, key, text, **settings).drop("tie").withColumnRenamed("id", key)


def one_per_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, margin: float = 0.1, **settings,
) -> DataFrame:
    """Rows of `docs` that stand for their group at a similarity of `percent` or more; columns as in `docs`.

    A row goes by its id and its text, so that another text under the same id is not touched.
    """
    gone = stage(judged(docs, key, text, percent=percent, margin=margin, **settings).where("NOT kept").select("id", "tie").distinct(), "gone")
    flag, own, tie = new_name("flag"), new_name("id"), new_name("tie")
    some = flagged(docs, named(key).cast("long"), gone.select("id"), flag)
    same = (named(key).cast("long") == named(own)) & (F.xxhash64(text_or_empty(text)) == named(tie))
    doubted = some.where(named(flag)).join(gone.toDF(own, tie), same, "left_anti")
    return some.where(~named(flag)).unionByName(doubted).select(*map(named, docs.columns))
