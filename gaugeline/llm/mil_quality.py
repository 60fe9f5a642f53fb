"""Quality classifier: gated attention over the passages of a document.

A passage is a run of `passage_words` words. It is encoded as shares of hashed word shapes and character pairs
plus a few ratios, passed through one tanh layer. A gated attention (tanh times sigmoid) scores the
passages, a softmax over a document's passages weighs them, and a logistic unit scores the weighted
sum. Only document labels are used; gradients reach passages through the weights.

Fitting takes a bounded sample: at most `fit_rows` labelled documents by a hash of their key, of which at
most half bear the commoner label, and the intercept is set back to the labels' shares afterwards. Of these documents
all passages are learned from: tasks write them to the shared folder, and the driver goes over those files batch by
batch, holding the passages of one batch of documents at a time. Scoring covers every whole text in batches of
bounded size; the model, a few kilobytes, goes with the task. Only texts enter a score.

Defined cases: a null or blank text is one empty passage and gets a score like any other; labels that are
null or lack a text are not learned from; with labels of one kind only every score is that kind's share;
repeated labels count once per row; an empty table gives an empty result; further columns are left
alone and not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_path
from .common import key_text, named, text_or_empty
from .files import opened
from .rows import by_batch, kept_rows

BUCKETS = 512
RATIOS = 8
CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Byte classes: lower, upper, digit, white space, above 0x7F, other.
_KIND = np.full(256, 5, np.uint8)
for _low, _high, _kind in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (128, 255, 4)):
    _KIND[_low:_high + 1] = _kind
_KIND[_SPACE] = 3


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    layer: np.ndarray
    layer_bias: np.ndarray
    view: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    intercept: float


def passages(text: str | None, words: int) -> np.ndarray:
    """One row of features per passage of the whole text, built from chunks of bounded size."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    blank = _SPACE[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.empty(0, np.int64)
    cuts = starts[::words] if len(starts) else np.zeros(1, np.int64)
    ends = np.append(cuts[1:], len(data))
    made = np.zeros((len(cuts), BUCKETS + RATIOS), np.float32)
    first = 0
    while first < len(cuts):
        last = max(first + 1, int(np.searchsorted(ends, cuts[first] + CHUNK_BYTES, "right")))
        _encode(data[cuts[first]:ends[last - 1]], cuts[first:last] - cuts[first], made[first:last])
        first = last
    return made


def _encode(data: np.ndarray, cuts: np.ndarray, made: np.ndarray) -> None:
    if not len(data):
        return
    count, n = len(cuts), len(data)
    owner = np.repeat(np.arange(count), np.diff(np.append(cuts, n)))
    kind = _KIND[data].astype(np.int64)
    low = np.where(kind == 1, data + 32, data).astype(np.int64)
    pair = (low[:-1] * 256 + low[1:]) * 40503 % 65521 % (BUCKETS - 64) if n > 1 else np.empty(0, np.int64)
    made[:, 64:BUCKETS] = np.bincount(owner[:-1] * (BUCKETS - 64) + pair, minlength=count * (BUCKETS - 64)).reshape(count, -1)
    three = kind[:-2] * 36 + kind[1:-1] * 6 + kind[2:] if n > 2 else np.empty(0, np.int64)
    made[:, :64] = np.bincount(owner[:-2] * 64 + three % 64, minlength=count * 64).reshape(count, 64) if n > 2 else 0
    size = np.maximum(np.bincount(owner, minlength=count), 1)
    made[:, :BUCKETS] = np.sqrt(made[:, :BUCKETS] / size[:, None])
    for k in range(6):
        made[:, BUCKETS + k] = np.bincount(owner[kind == k], minlength=count) / size
    edge = np.flatnonzero(_SPACE[data])
    made[:, BUCKETS + 6] = np.bincount(owner[edge], minlength=count) / size
    words = np.concatenate([[0], edge + 1])
    words = words[words < n]
    heads = np.add.reduceat(low * (np.arange(n) % 7 + 1) * 2654435761 % 4294967291, words)
    same = np.flatnonzero(heads[1:] == heads[:-1]) + 1
    made[:, BUCKETS + 7] = np.bincount(owner[words[same]], minlength=count) / np.maximum(
        np.bincount(owner[words], minlength=count), 1)
    made[:, BUCKETS + 7] = np.maximum(made[:, BUCKETS + 7], _variety(heads, owner[words], count))


def _variety(heads: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Share of a passage's words that occurred in it before."""
    seen = np.unique((owner.astype(np.int64) << 42) | (heads & ((1 << 42) - 1)))
    total = np.bincount(owner, minlength=count)
    return 1 - np.bincount(seen >> 42, minlength=count) / np.maximum(total, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(model: Model, rows: np.ndarray, starts: np.ndarray) -> tuple:
    """Scores of documents whose passages are `rows[starts[i]:starts[i + 1]]`, with the parts that gradients need."""
    x = (rows - model.mean) / model.scale
    h = np.tanh(x @ model.layer + model.layer_bias)
    v, g = np.tanh(h @ model.view), _sigmoid(h @ model.gate)
    e = (v * g) @ model.attend
    counts = np.diff(np.append(starts, len(rows)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
    a = e / np.repeat(np.add.reduceat(e, starts), counts)
    z = np.add.reduceat(a[:, None] * h, starts)
    return _sigmoid(z @ model.out + model.intercept), x, h, v, g, a, z, counts


class Bags:
    """Passages of the fitted documents, in files of the shared folder; read again for each epoch."""

    def __init__(self, folder: str):
        self.system, root = opened(folder)
        self.files = sorted(f.path for f in self.system.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet"))

    def batches(self, order: list[int], documents: int = 64) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """`(passages of each document, labels)` of up to `documents` documents, file by file."""
        for n in order:
            with self.system.open_input_file(self.files[n]) as stream:
                for batch in pq.ParquetFile(stream).iter_batches(documents, columns=["label", "bag"], use_threads=False):
                    if batch.num_rows:
                        bags = [np.frombuffer(b.as_buffer(), "<f2").astype(np.float32).reshape(-1, BUCKETS + RATIOS) for b in batch.column("bag")]
                        yield bags, batch.column("label").to_numpy().astype(float)

    def moments(self) -> tuple[np.ndarray, np.ndarray, float, int]:
        """Mean and spread of the passages, mean label, number of documents."""
        count, total, squares, labels, documents = 0, 0.0, 0.0, 0.0, 0
        for bags, target in self.batches(list(range(len(self.files)))):
            for bag in bags:
                wide = bag.astype(np.float64)
                count, total, squares = count + len(bag), total + wide.sum(0), squares + (wide * wide).sum(0)
            labels, documents = labels + target.sum(), documents + len(target)
        mean = total / max(count, 1)
        spread = np.sqrt(np.maximum(squares / max(count, 1) - mean * mean, 0))
        return np.float32(mean), np.float32(spread + 1e-3), labels / max(documents, 1), documents


PASSAGES = 8192  # passages of one gradient, more only if one document has more


def _gradient(model: Model, bags: list[np.ndarray], labels: np.ndarray, documents: int) -> dict[str, np.ndarray]:
    """Gradient of the log-loss of some whole documents, as a part of `documents`."""
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    score, x, h, v, g, a, z, counts = forward(model, np.concatenate(bags), starts)
    d = (score - labels) / documents
    dz = np.repeat(d[:, None] * model.out, counts, axis=0)
    da = (dz * h).sum(1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
    dv, dg = de[:, None] * model.attend * g * (1 - v * v), de[:, None] * model.attend * v * g * (1 - g)
    dh = (a[:, None] * dz + dv @ model.view.T + dg @ model.gate.T) * (1 - h * h)
    return {"layer": x.T @ dh, "layer_bias": dh.sum(0), "view": h.T @ dv, "gate": h.T @ dg,
            "attend": (de[:, None] * v * g).sum(0), "out": z.T @ d, "intercept": np.array([d.sum()])}


def _groups(bags: list[np.ndarray]) -> Iterator[slice]:
    """Runs of documents of at most PASSAGES passages together."""
    first, held = 0, 0
    for n, bag in enumerate(bags):
        if held and held + len(bag) > PASSAGES:
            yield slice(first, n)
            first, held = n, 0
        held += len(bag)
    yield slice(first, len(bags))


def fit(bags: Bags, hidden: int = 24, gates: int = 12, epochs: int = 30,
        rate: float = 4e-3, decay: float = 1e-3, seed: int = 7) -> Model:
    """Adam on the log-loss, batches of up to 64 documents; the same sample gives the same model."""
    rng = np.random.default_rng(seed)
    mean, scale, _, _ = bags.moments()
    width = len(mean)
    p = {"layer": rng.normal(0, width**-0.5, (width, hidden)), "layer_bias": np.zeros(hidden),
         "view": rng.normal(0, hidden**-0.5, (hidden, gates)), "gate": rng.normal(0, hidden**-0.5, (hidden, gates)),
         "attend": rng.normal(0, gates**-0.5, gates), "out": rng.normal(0, hidden**-0.5, hidden), "intercept": np.zeros(1)}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        for some, labels in bags.batches(rng.permutation(len(bags.files)).tolist()):
            model = Model(mean, scale, p["layer"], p["layer_bias"], p["view"], p["gate"], p["attend"], p["out"], p["intercept"][0])
            parts = [_gradient(model, some[s], labels[s], len(some)) for s in _groups(some)]
            step += 1
            pace = rate * (1 - epoch / epochs)
            for k in p:
                grad = sum(part[k] for part in parts)
                if p[k].ndim == 2:
                    grad = grad + decay * p[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                p[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    small = {k: v.astype(np.float32) for k, v in p.items() if k != "intercept"}
    return Model(mean, scale, intercept=float(p["intercept"][0]), **small)


def _constant(share: float) -> Model:
    """A model that gives `share` to every text."""
    width = BUCKETS + RATIOS
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros((1, 1)),
                 np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
          label: str = "quality", fit_rows: int = 3000, passage_words: int = 64, files: int = 8) -> Model:
    """Fit on at most `fit_rows` labelled rows for which `learn`, a condition on `labels`, holds; whole texts."""
    usable = labels.where(learn & named(label).isin(0, 1) & named(key).isNotNull()).select(
        named(key).alias("_key"), named(label).cast("int").alias("_label"))
    shares = dict(map(tuple, usable.groupBy("_label").count().collect()))
    if len(shares) < 2:
        return _constant(float(next(iter(shares), 0.5)))
    rare = min(shares.values())
    part = min(max(rare, 1), fit_rows // 2)
    order = [F.xxhash64("_key"), F.col("_key")]
    chosen = None
    for value in (0, 1):
        own = usable.where(F.col("_label") == value).orderBy(*order).limit(part if shares[value] == rare else fit_rows - part)
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = docs.select(named(key).alias("_own"), text_or_empty(text).alias("_text"))
    sample = texts.join(F.broadcast(chosen), F.col("_own") == F.col("_key")).select("_key", "_text", "_label")

    def make(batch: dict[str, list]) -> dict[str, list]:
        return {"key": batch["_key"], "label": batch["_label"],
                "bag": [passages(body, passage_words).astype("<f2").tobytes() for body in batch["_text"]]}
    made = by_batch(sample, make, "key long, label int, bag binary")
    folder = new_path(docs.sparkSession, "bags")
    # Mixed by a hash of the key within each file, which is the order of learning.
    made.repartition(files, "key").sortWithinPartitions(F.xxhash64("key"), "key", "label", F.xxhash64("bag")).write.parquet(folder)
    bags = Bags(folder)
    _, _, fitted, _ = bags.moments()
    if not 0 < fitted < 1:
        return _constant(shares.get(1, 0) / sum(shares.values()))
    model = fit(bags)
    true = shares[1] / sum(shares.values())
    shift = np.log(true / (1 - true)) - np.log(fitted / (1 - fitted))
    return model._replace(intercept=float(model.intercept + shift))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", passage_words: int = 64) -> DataFrame:
    """Per row: key, `score` in 0 to 1, `passages`, `weight_top` (the largest attention weight)."""
    def make(batch: dict[str, list]) -> dict[str, list]:
        scores, counts, tops = [], [], []
        for body in batch["text"]:
            rows = passages(body, passage_words)
            value, _, _, _, _, a, _, _ = forward(model, rows, np.zeros(1, int))
            scores.append(float(value[0]))
            counts.append(len(rows))
            tops.append(float(a.max()))
        return {"key": batch["key"], "score": scores, "passages": counts, "weight_top": tops}
    rows = docs.select(named(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return by_batch(rows, make, "key long, score double, passages long, weight_top double").withColumnRenamed("key", key)


def held_out(key: str) -> Column:
    """Rows never learned from: crc32 of the key's text, modulo 3, is 1."""
    return F.crc32(key_text(key).cast("binary")) % 3 == 1


def good_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Rows of `docs` that score `least` or more; columns as in `docs`."""
    model = train(docs, labels, ~held_out(key), key, text)

    def good(texts: list) -> list[bool]:
        return [bool(forward(model, passages(t, 64), np.zeros(1, int))[0][0] >= least) for t in texts]
    return kept_rows(docs, good, text)
