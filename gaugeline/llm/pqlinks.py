"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table-lookup distances, exact cosines.

1. Equal vectors collapse into a class that counts its rows. Vectors of different lengths never meet.
2. `fit`: on a bounded, documented sample (`fit_rows`), k-means gives coarse centroids and, per subspace, codebooks of
   the residuals. The model is the only thing broadcast: at most `max_lists` centroids and 256 codes per subspace.
3. `index`: every class gets the list of its nearest centroid, the codes of its residual, and the exact length of
   what the codes miss.
4. `probes`: a class is compared with all lists that can hold a partner. For a pair within distance r (the chord of the
   least cosine) of each other, the partner's list is ruled out if its centroid is farther than r plus the list's radius (certain),
   or if the border to it, the plane between both centroids, is farther than `deviations` standard deviations of the
   part of a chord r that points in one fixed direction, r / sqrt(dimensions). A pair is sought from one side only, towards the higher list.
5. `links`: lists and their visitors meet in blocks of bounded size. A table per query holds its inner products with all codes;
   sums of looked-up entries estimate the cosine of every member, wrong by at most what the member's codes miss. Only pairs
   that this error could lift to the limit are compared exactly, in double precision. Nothing is lost in
   this step and nothing below the limit is linked.
6. A block returns counts per class and a spanning forest of its links, never the pairs; components come from those.

Recall: step 4 alone can miss pairs: of pairs whose difference has a random direction, one in 31,000 per list at 4 deviations.
Work per list is quadratic in blocks; a list with a third of all rows is spread over as many tasks as it has pairs of blocks.

Defined cases: null, empty and zero vectors and vectors with null, NaN or infinite components link with nothing, nor do rows
with a null id (their component is null and they are kept); rows that repeat an id are vectors of their own; an empty
table gives an empty result; further columns, labels among them, are left alone and not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable, stage
from .common import named
from .setsketch import components

CODES = 256
BLOCK = 2048


# --- model ----------------------------------------------------------------------------------------------------

def kmeans(points: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """`k` centroids (fewer if there are fewer points), from a seeded choice of points; empty ones move to a far point."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        own, far = nearest(points, centres)
        order = np.argsort(own, kind="stable")
        used, starts = np.unique(own[order], return_index=True)
        centres[used] = np.add.reduceat(points[order], starts) / np.diff(np.append(starts, len(points)))[:, None]
        idle = np.setdiff1d(np.arange(len(centres)), used)
        centres[idle] = points[np.argsort(-far, kind="stable")[:len(idle)]]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point and the squared distance, in slices."""
    norms, own, far = (centres * centres).sum(1), [], []
    for at in range(0, len(points), 4096):
        part = points[at:at + 4096]
        d = norms - 2 * part @ centres.T
        best = d.argmin(1)
        own.append(best)
        far.append(np.maximum(d[np.arange(len(part)), best] + (part * part).sum(1), 0))
    return np.concatenate([*own, np.empty(0, int)]).astype(int), np.concatenate([*far, np.empty(0)])


@dataclass
class Model:
    """Centroids, and per subspace a codebook of residuals; `width` is the padded number of dimensions."""

    centres: np.ndarray
    books: np.ndarray  # subspaces x codes x dimensions of a subspace
    width: int

    def padded(self, vectors: np.ndarray) -> np.ndarray:
        return np.pad(vectors, ((0, 0), (0, self.width - vectors.shape[1])))

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, distance to its centroid, codes, length of what the codes miss) of padded unit vectors."""
        own, _ = nearest(vectors, self.centres)
        left = vectors - self.centres[own]
        span = np.sqrt((left * left).sum(1))
        parts = left.reshape(len(left), len(self.books), -1)
        codes = np.stack([nearest(parts[:, m], book)[0] for m, book in enumerate(self.books)], axis=1).astype(np.uint8)
        missed = parts - np.stack([book[codes[:, m]] for m, book in enumerate(self.books)], axis=1)
        return own, span, codes, np.sqrt((missed * missed).sum((1, 2)))


def fit_model(sample: np.ndarray, lists: int, subspaces: int, width: int) -> Model:
    sub = -(-width // subspaces)
    padded = np.pad(sample, ((0, 0), (0, sub * subspaces - sample.shape[1])))
    centres = kmeans(padded, lists) if len(padded) else np.zeros((1, sub * subspaces))
    own, _ = nearest(padded, centres)
    left = (padded - centres[own]).reshape(len(padded), subspaces, sub)
    books = [kmeans(left[:, m], CODES, seed=m) if len(left) else np.zeros((1, sub)) for m in range(subspaces)]
    return Model(centres, np.stack(books), sub * subspaces)


def packed(values: np.ndarray) -> bytes:
    """The vector as bytes, in single precision where that loses nothing."""
    with np.errstate(over="ignore", under="ignore"):
        single = values.astype("<f4")
    return single.tobytes() if (single == values).all() else values.astype("<f8").tobytes()


def unit(raw: list[bytes], size: np.ndarray, width: int) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros, of packed ones."""
    made = np.zeros((len(raw), width))
    for n, (values, k) in enumerate(zip(raw, size)):
        made[n, :k] = np.frombuffer(values, f"<f{len(values) // k}")
    scale = np.abs(made).max(1, initial=0)[:, None]  # first to 1, so that squares neither vanish nor overflow
    made /= np.where(scale > 0, scale, 1)
    return made / np.sqrt((made * made).sum(1))[:, None]


# --- classes and index ----------------------------------------------------------------------------------------

def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Staged `(node, id, copies, vector)`: one row per different usable vector, with its smallest id."""
    rows = vectors.select(named(key).cast("long").alias("id"), named(vector).cast("array<double>").alias("vector"))
    made = rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).groupBy("vector").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"))
    return stage(made.withColumn("node", F.monotonically_increasing_id()), "classes")


def fit(found: DataFrame, lists: int, subspaces: int, fit_rows: int, width: int) -> Model:
    """The model, from the `fit_rows` classes of smallest hash; that many vectors go to the driver."""
    rows = found.select("vector", F.xxhash64("id", "vector").alias("_h")).orderBy("_h").limit(fit_rows).select("vector").toArrow()
    raw = list(_vectors(rows.column("vector").combine_chunks()))
    sample = unit([v.tobytes() for v in raw], np.array([len(v) for v in raw], int), width)
    return fit_model(sample, lists, min(subspaces, width), width)


def _vectors(column: pa.ListArray) -> Iterator[np.ndarray]:
    ends, values = np.cumsum(column.value_lengths().to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    return iter(np.split(values, ends[:-1]))


INDEX = "node long, copies long, size int, list int, span double, codes binary, missed double, vector binary"


def index(found: DataFrame, model: Model) -> DataFrame:
    """Staged index: every class with its list and codes."""
    importable(found.sparkSession)
    arrow = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("size", pa.int32()), ("list", pa.int32()), ("span", pa.float64()),
                       ("codes", pa.binary()), ("missed", pa.float64()), ("vector", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                size = part.column(2).value_lengths().to_numpy().astype(np.int32)
                raw = [packed(v) for v in _vectors(part.column(2))]
                own, span, codes, missed = model.encode(unit(raw, size, model.width))
                columns = [part.column(0), part.column(1), size, own.astype(np.int32), span, [c.tobytes() for c in codes], missed, raw]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)
                                                  for c, f in zip(columns, arrow)], schema=arrow)
    return stage(found.select("node", "copies", "vector").mapInArrow(make, INDEX), "index")


# --- search ---------------------------------------------------------------------------------------------------

def probed_lists(vectors: np.ndarray, own: np.ndarray, model: Model, radii: np.ndarray, reach: float, slack: float) -> np.ndarray:
    """Which lists (own or higher) each padded unit vector must visit."""
    centres = model.centres
    norms = (centres * centres).sum(1)
    far = np.maximum(1 + norms - 2 * vectors @ centres.T, 0)  # squared distances
    apart = np.sqrt(np.maximum(norms + norms[own][:, None] - 2 * centres[own] @ centres.T, 0))
    border = (far - far[np.arange(len(own)), own][:, None]) / (2 * np.maximum(apart, 1e-12))
    lists = np.arange(len(centres))
    wanted = (border <= slack) & (np.sqrt(far) <= reach + radii + 1e-9) & (lists >= own[:, None])
    wanted[np.arange(len(own)), own] = True
    return wanted


def visits(indexed: DataFrame, model: Model, radii: np.ndarray, least: float, deviations: float) -> DataFrame:
    """`(node, list)`: the lists that each class visits."""
    importable(indexed.sparkSession)
    reach = float(np.sqrt(2 - 2 * least))
    slack = min(reach, deviations * reach / np.sqrt(model.width))
    schema = pa.schema([("node", pa.int64()), ("target", pa.int32())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                node, own = (part.column(n).to_numpy() for n in (0, 2))
                vectors = unit(part.column(3).to_pylist(), part.column(1).to_numpy(), model.width)
                row, target = np.nonzero(probed_lists(vectors, own, model, radii, reach, slack))
                yield pa.RecordBatch.from_arrays([pa.array(node[row]), pa.array(target.astype(np.int32))], schema=schema)
    return indexed.select("node", "size", "list", "vector").mapInArrow(make, "node long, target int")


def close_pairs(
    queries: np.ndarray, members: np.ndarray, owner: int, codes: np.ndarray, missed: np.ndarray, model: Model, least: float,
    allowed: np.ndarray,
) -> Iterator[tuple[int, np.ndarray]]:
    """(query, members at cosine `least` or more), by looked-up estimates first, for the pairs `allowed`."""
    parts = queries.reshape(len(queries), len(model.books), -1)
    base = queries @ model.centres[owner]
    for at in range(0, len(queries), 256):
        part = slice(at, at + 256)
        estimate = np.repeat(base[part, None], len(members), axis=1)
        for m, book in enumerate(model.books):
            estimate += (parts[part, m] @ book.T)[:, codes[:, m]]
        possible = (estimate + missed >= least - 1e-9) & allowed[part]
        for q in np.flatnonzero(possible.any(1)):
            near = np.flatnonzero(possible[q])
            near = near[members[near] @ queries[at + q] >= least]
            if len(near):
                yield at + q, near


def block_links(pdf: pd.DataFrame, model: Model, least: float) -> pd.DataFrame:
    """Counts (a, null, n) and a spanning forest (a, b, 0) of the links between one block of members and one of visitors."""
    inside = pdf[~pdf["visitor"]]
    outside = pdf[pdf["visitor"]]
    owner = int(pdf["target"].iloc[0])
    sizes = [part["size"].to_numpy() for part in (outside, inside)]
    queries, members = (unit(list(p["vector"]), s, model.width) for p, s in zip((outside, inside), sizes))
    q_node, m_node = outside["node"].to_numpy(), inside["node"].to_numpy()
    codes = np.frombuffer(b"".join(inside["codes"]), np.uint8).reshape(len(inside), -1)
    home = outside["list"].to_numpy() == owner  # pairs within the list are taken once
    allowed = (sizes[0][:, None] == sizes[1]) & (~home[:, None] | (q_node[:, None] < m_node))
    weight = [outside["copies"].to_numpy(), inside["copies"].to_numpy()]
    counts = [np.zeros(len(outside), np.int64), np.zeros(len(inside), np.int64)]
    nodes, at = np.unique(np.concatenate([q_node, m_node]), return_inverse=True)
    label, edges = np.arange(len(nodes)), []
    q_at, m_at = at[:len(q_node)], at[len(q_node):]
    for q, near in close_pairs(queries, members, owner, codes, inside["missed"].to_numpy(), model, least, allowed):
        counts[0][q] += weight[1][near].sum()
        counts[1][near] += weight[0][q]
        groups, first = np.unique(label[m_at[near]], return_index=True)
        mine = label[q_at[q]]
        joined = groups[groups != mine]
        if len(joined):
            edges += [(q_node[q], m_node[near[f]]) for g, f in zip(groups, first) if g != mine]
            label[np.isin(label, joined)] = mine
    counted = [pd.DataFrame({"a": n[c > 0], "b": None, "n": c[c > 0]}) for n, c in zip((q_node, m_node), counts)]
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    forest = pd.DataFrame({"a": pairs.min(1, initial=1 << 62), "b": pairs.max(1, initial=0), "n": 0})
    return pd.concat([counted[0], counted[1], forest]).astype({"a": "int64", "b": "Int64", "n": "int64"})


def links(indexed: DataFrame, visiting: DataFrame, model: Model, least: float, block: int = BLOCK) -> DataFrame:
    """Staged `(a, b, n)`: link counts per class and block (b null), and enough links (a, b) to connect what is linked."""
    spark = indexed.sparkSession
    visiting = stage(visiting, "visits")
    members = indexed.groupBy(F.col("list").alias("target")).agg(F.ceil(F.count("*") / block).cast("int").alias("rooms"))
    guests = visiting.groupBy("target").agg(F.ceil(F.count("*") / block).cast("int").alias("tours"))
    plan = F.broadcast(members.join(guests, "target"))  # one row per list, so at most `max_lists`
    body = ["node", "copies", "size", "list", "codes", "missed", "vector"]
    spread = F.pmod(F.xxhash64("node"), F.col("rooms").cast("long")).cast("int")
    stay = indexed.withColumn("target", F.col("list")).join(plan, "target").select(
        "target", spread.alias("room"), F.explode(F.sequence(F.lit(0), F.col("tours") - 1)).alias("tour"), F.lit(False).alias("visitor"), *body)
    spread = F.pmod(F.xxhash64("node", F.lit(1)), F.col("tours").cast("long")).cast("int")
    come = visiting.join(indexed, "node").join(plan, "target").select(
        "target", F.explode(F.sequence(F.lit(0), F.col("rooms") - 1)).alias("room"), spread.alias("tour"), F.lit(True).alias("visitor"),
        *[F.lit(None).cast("binary").alias(c) if c == "codes" else F.col(c) for c in body])
    importable(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # small rows, long work: not to be coalesced
    meeting = ["target", "room", "tour"]

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["visitor"].all() or not pdf["visitor"].any():
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
        return block_links(pdf, model, least)
    rows = stay.unionByName(come).repartition(tasks, *meeting)
    return stage(rows.groupBy(*meeting).applyInPandas(work, "a long, b long, n long"), "links")


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, rows_per_list: int = 4096, max_lists: int = 4096,
    subspaces: int = 8, fit_rows: int = 32_768, deviations: float = 4.0,
) -> DataFrame:
    """Per row: key, `n_links` (other rows at cosine `least` or more), `component_id`, `kept`."""
    found = classes(vectors, key, vector)
    total, width = found.agg(F.count("*"), F.max(F.size("vector"))).first()
    rows = vectors.select(named(key).cast("long").alias("id"), named(vector).cast("array<double>").alias("vector"))
    if not total:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    model = fit(found, max(1, min(max_lists, total // rows_per_list)), subspaces, fit_rows, width)
    indexed = index(found, model)
    radii = np.zeros(len(model.centres))
    for row in indexed.groupBy("list").agg(F.max("span").alias("span")).collect():  # one row per list
        radii[row["list"]] = row["span"]
    linked = links(indexed, visits(indexed, model, radii, least, deviations), model, least)
    counts = linked.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    labels = components(linked.where("b IS NOT NULL"))
    smallest = labels.join(found.select("node", "id"), "node").groupBy("label").agg(F.min("id").alias("component"))
    grouped = labels.join(smallest, "label").select("node", "component")
    per_class = found.join(counts, "node", "left").join(grouped, "node", "left").select(
        "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    # Unusable rows find no class: their vectors are not among the classes.
    joined = rows.join(per_class, "vector", "left")
    counted = F.when(F.col("id").isNotNull(), F.col("n_links"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return joined.select(F.col("id").alias(key), F.coalesce(counted, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
