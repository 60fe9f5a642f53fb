"""Language-model scores: a causal self-attention model over subword ids, beside a word-unigram base.

Ids fall into classes: the commonest ones are classes of their own, the others share classes of about
equal weight. The chance of an id is that of its class given the ids before, times its smoothed share of
the class. One attention head and a small feed-forward layer over the last `WINDOW` ids give
class logits, added to the log of smoothed class-pair counts, so that the model starts from
what the corpus says and learns the rest.

What is gathered from the training texts: word counts, id counts, class-pair counts and the weights,
each from all of them. Weights are fitted in `ROUNDS` rounds; each text is learned in one round, by tasks of about
`PART_IDS` ids that pass over their part with Adam, so the number of tasks grows with the input; after each round they are
averaged per parameter in Spark. Texts are scored in windows that overlap by `WINDOW - STRIDE` ids; every id is scored
once, in the first window that reaches it; batches of windows share one masked attention.

Word counts form a table of any size. The commonest `HOT_WORDS` words go to the tasks; other words are
joined by word, so nothing that grows is broadcast.

Defined cases: null texts are empty and consist of the end alone; a null key hashes as the empty text and is
trained on; repeated rows count and are scored as separate rows; without training texts all counts are
0; an empty table gives an empty result; further columns are left alone and not returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import importable, stage
from .bytebpe import default_path, encoder
from .common import key_text, named, text_or_empty
from .rows import by_batch

WINDOW, STRIDE = 32, 24
HEADS, SHARED = 104, 24  # classes of one id, classes of many
KNOWN = 1024            # ids with an embedding of their own
WIDTH, INNER = 16, 32
HOT_WORDS = 100_000
PART_IDS, ROUNDS = 500_000, 3
LIMIT = np.float32(50)  # bound of exponents
BATCH = 64              # windows at once: their arrays stay in a core's cache
PAST = np.tril(np.ones((WINDOW, WINDOW), np.float32))


class Vocabulary(NamedTuple):
    """Class and embedding row of each id, log share of an id in its class, and log pair chances of classes."""

    klass: np.ndarray
    row: np.ndarray
    share: np.ndarray
    pairs: np.ndarray
    end: int


def vocabulary(counts: np.ndarray, end: int) -> Vocabulary:
    """Classes from id counts; class pairs are filled in later."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    klass, row = np.empty(len(counts), np.int64), np.empty(len(counts), np.int64)
    rest = counts[order[HEADS:]] + 0.5
    klass[order[:HEADS]] = np.arange(HEADS)
    klass[order[HEADS:]] = HEADS + np.minimum(np.cumsum(rest) - rest, rest.sum() * (1 - 1e-9)) * SHARED // rest.sum()
    row[order[:KNOWN]] = np.arange(KNOWN)
    row[order[KNOWN:]] = KNOWN + klass[order[KNOWN:]]
    total = np.bincount(klass, counts + 0.5, HEADS + SHARED)
    share = np.log((counts + 0.5) / total[klass]).astype(np.float32)
    return Vocabulary(klass, row, share, np.zeros((HEADS + SHARED, HEADS + SHARED), np.float32), end)


def with_pairs(vocab: Vocabulary, pairs: np.ndarray) -> Vocabulary:
    alone = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * len(pairs))
    chance = (pairs + 20 * alone) / (pairs.sum(1, keepdims=True) + 20)
    return vocab._replace(pairs=np.log(chance).astype(np.float32))


SHAPES = {
    "ids": (KNOWN + HEADS + SHARED, WIDTH), "places": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH),
    "inner": (WIDTH, INNER), "inner_bias": (INNER,), "outer": (INNER, WIDTH), "classes": (WIDTH, HEADS + SHARED),
}


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def initial(seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    spread = {"ids": 0.5, "places": 0.1, "inner_bias": 0.0, "classes": 0.02}
    return np.concatenate([rng.normal(0, spread.get(n, s[0]**-0.5), s).ravel() for n, s in SHAPES.items()]).astype(np.float32)


def windows(ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and whether to score, per window; inputs are the ids before, the end id first and last."""
    full = np.concatenate([[end], ids, [end]]).astype(np.int64)
    n = len(full) - 1
    starts = np.arange(0, max(n - (WINDOW - STRIDE), 1), STRIDE)
    at = starts[:, None] + np.arange(WINDOW)
    score = (at < n) & ((starts[:, None] == 0) | (np.arange(WINDOW) >= WINDOW - STRIDE))
    return full[np.minimum(at, n - 1)], full[np.minimum(at + 1, n)], score


def run(p: dict[str, np.ndarray], vocab: Vocabulary, x: np.ndarray) -> dict[str, np.ndarray]:
    """Hidden states of a batch of windows of ids, with what gradients need."""
    rows = vocab.row[x]
    h0 = np.take(p["ids"], rows, axis=0)
    h0 += p["places"]
    qkv = (h0.reshape(-1, WIDTH) @ p["qkv"]).reshape(len(x), WINDOW, -1)
    q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]
    a = np.matmul(q, k.transpose(0, 2, 1))
    np.clip(a, -LIMIT, LIMIT, out=a)
    np.exp(a, out=a)
    a *= PAST
    a *= 1 / a.sum(-1, keepdims=True)
    h1 = np.matmul(a, v)
    h1 += h0
    u = h1.reshape(-1, WIDTH) @ p["inner"]
    u += p["inner_bias"]
    np.maximum(u, 0, out=u)
    h2 = (u @ p["outer"]).reshape(h1.shape)
    h2 += h1
    return {"rows": rows, "h0": h0, "q": q, "k": k, "v": v, "a": a, "h1": h1, "u": u, "h2": h2}


class _Room:
    """Two arrays of class scores that every batch of a worker uses again: fresh ones of this size cost more than what fills them."""

    def __init__(self):
        self.held = np.empty((2, 0, HEADS + SHARED), np.float32)

    def take(self, rows: int) -> np.ndarray:
        if self.held.shape[1] < rows:
            self.held = np.empty((2, rows, HEADS + SHARED), np.float32)
        return self.held[:, :rows]


_room = _Room()


def class_logits(p: dict[str, np.ndarray], vocab: Vocabulary, h: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Logits of the classes; the array is overwritten by the next call."""
    logits, pairs = _room.take(len(h))
    np.matmul(h, p["classes"], out=logits)
    np.take(vocab.pairs, vocab.klass[before], axis=0, out=pairs, mode="clip")
    logits += pairs
    return np.minimum(logits, LIMIT, out=logits)


def log_chances(p: dict[str, np.ndarray], vocab: Vocabulary, x: np.ndarray, y: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Natural log chance of each scored target, in window order."""
    target = y[score]
    logits = class_logits(p, vocab, run(p, vocab, x)["h2"][score], x[score])
    own = logits[np.arange(len(target)), vocab.klass[target]].copy()
    return own - np.log(np.exp(logits, out=logits).sum(1)) + vocab.share[target]


def gradients(p: dict[str, np.ndarray], vocab: Vocabulary, x: np.ndarray, y: np.ndarray, score: np.ndarray) -> dict[str, np.ndarray]:
    s = run(p, vocab, x)
    h = s["h2"][score]
    d = class_logits(p, vocab, h, x[score])
    np.exp(d, out=d)
    d *= np.float32(1 / max(len(d), 1)) / d.sum(1, keepdims=True)
    d[np.arange(len(d)), vocab.klass[y[score]]] -= np.float32(1 / max(len(d), 1))
    g = {"classes": h.T @ d}
    d2 = np.zeros_like(s["h2"])
    d2[score] = d @ p["classes"].T
    flat = d2.reshape(-1, WIDTH)
    g["outer"] = s["u"].T @ flat
    du = flat @ p["outer"].T
    du *= s["u"] > 0
    g["inner"], g["inner_bias"] = s["h1"].reshape(-1, WIDTH).T @ du, du.sum(0)
    d1 = d2
    d1 += (du @ p["inner"].T).reshape(d2.shape)
    ds = np.matmul(d1, s["v"].transpose(0, 2, 1))
    ds -= np.einsum("nij,nij->ni", s["a"], ds)[:, :, None]
    ds *= s["a"]
    dqkv = np.concatenate([np.matmul(ds, s["k"]), np.matmul(ds.transpose(0, 2, 1), s["q"]),
                           np.matmul(s["a"].transpose(0, 2, 1), d1)], axis=2).reshape(-1, 3 * WIDTH)
    g["qkv"] = s["h0"].reshape(-1, WIDTH).T @ dqkv
    d0 = d1
    d0 += (dqkv @ p["qkv"].T).reshape(d1.shape)
    g["places"] = d0.sum(0)
    at = (s["rows"].reshape(-1, 1) * WIDTH + np.arange(WIDTH)).ravel()
    g["ids"] = np.bincount(at, d0.ravel(), SHAPES["ids"][0] * WIDTH).astype(np.float32).reshape(SHAPES["ids"])
    return g


class Trainer:
    """Adam over batches of windows; windows beyond a full batch wait for the next text."""

    def __init__(self, flat: np.ndarray, vocab: Vocabulary, rate: float):
        self.flat, self.vocab, self.rate, self.steps, self.seen = flat.copy(), vocab, rate, 0, 0
        self.first, self.second = np.zeros_like(flat), np.zeros_like(flat)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray) -> None:
        x, y, score = windows(ids, self.vocab.end)
        for at in range(0, len(x), BATCH):
            self.waiting.append((x[at:at + BATCH], y[at:at + BATCH], score[at:at + BATCH]))
            if sum(len(w[0]) for w in self.waiting) >= BATCH:
                self.step()

    def step(self) -> None:
        if not self.waiting:
            return
        x, y, score = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting = []
        g = gradients(unpacked(self.flat), self.vocab, x, y, score)
        grad = np.concatenate([g[n].ravel() for n in SHAPES])
        self.steps += 1
        self.seen += int(score.sum())
        self.first *= 0.9
        self.first += 0.1 * grad
        grad *= grad
        self.second *= 0.99
        self.second += 0.01 * grad
        spread = np.sqrt(self.second, out=grad)
        spread *= (1 - 0.99**self.steps) ** -0.5
        spread += 1e-8
        self.flat -= self.rate / (1 - 0.9**self.steps) * self.first / spread


def held_out(key: str) -> Column:
    """Rows never learned from: crc32 of the key's text, modulo 5, is 1."""
    return F.crc32(key_text(key).cast("binary")) % 5 == 1


def word_counts(rows: DataFrame) -> DataFrame:
    """`(word, n)` of training texts; the end is the empty word. Counted per batch, then summed by Spark."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=schema)
            found.clear()
            return made
        for batch in batches:
            for text in batch.column("text"):
                found.update(text.as_py().encode("utf-8", "surrogatepass").lower().split())
                found[b""] += 1
                if len(found) > 400_000:
                    yield flushed()
        yield flushed()
    counted = rows.where("NOT held_out").select("text").mapInArrow(count, "word binary, n long")
    return stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


def _commonest(words: DataFrame, most: int) -> DataFrame:
    """Words above the lowest count that at most `most` words reach, found from a histogram of a few hundred rows."""
    steps = words.groupBy(F.floor(F.log2("n") * 8).alias("step")).count().collect()
    taken, least = 0, None
    for step, count in sorted(map(tuple, steps), reverse=True):
        taken += count
        if taken > most:
            break
        least = step
    return words.where(F.floor(F.log2("n") * 8) >= least) if least is not None else words.limit(0)


def _prepared(rows: DataFrame, hot: dict[bytes, float], path: str, end: int) -> DataFrame:
    """Per row: ids of the text and the base score of its common words; rarer words are listed."""
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def make(batch: dict[str, list]) -> dict[str, list]:
        known = shared.value
        out: dict[str, list] = {n: [] for n in ("n_tokens", "hot_known", "hot_score", "rare_word", "rare_n")}
        for text in batch["text"]:
            words = text.encode("utf-8", "surrogatepass").lower().split()
            words.append(b"")
            values = [known.get(w) for w in words]
            rare = Counter(w for w, v in zip(words, values) if v is None)
            out["n_tokens"].append(len(words))
            out["hot_known"].append(len(words) - rare.total())
            out["hot_score"].append(float(sum(v for v in values if v is not None)))
            out["rare_word"].append(list(rare))
            out["rare_n"].append(list(rare.values()))
        ids = encoder(path).encode(batch["text"])
        return {"key": batch["key"], "held_out": batch["held_out"], **out, "ids": ids}
    made = by_batch(rows, make, "key long, held_out boolean, n_tokens long, hot_known long, hot_score double, "
                                "rare_word array<binary>, rare_n array<long>, ids binary")
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "prepared")


def _bincounts(ids: DataFrame, make, end: int, size: int) -> np.ndarray:
    """Sum of `make(ids)`, an array of `size` counts, over runs of texts with `end` after each; one row per value and task is shuffled."""
    schema = pa.schema([("value", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                texts = [np.frombuffer(raw.as_buffer(), "<u2") for raw in batch.column("ids").slice(at, 200)]
                total += make(np.concatenate([part for text in texts for part in (text, np.array([end]))]))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], schema=schema)
    out = np.zeros(size)
    for value, n in ids.select("ids").mapInArrow(count, "value int, n long").groupBy("value").agg(F.sum("n")).collect():
        out[value] = n
    return out


def _counted(prepared: DataFrame, path: str) -> tuple[Vocabulary, int]:
    """Classes and their pairs from the training texts, and the number of ids in these."""
    tokenizer = encoder(path).tokenizer
    size = tokenizer.get_vocab_size() + 1
    end = size - 1
    learned = prepared.where("NOT held_out")
    counts = _bincounts(learned, lambda ids: np.bincount(ids, minlength=size), end, size)
    vocab = vocabulary(counts, end)
    wide, klass = HEADS + SHARED, vocab.klass

    def pairs(ids: np.ndarray) -> np.ndarray:
        c = klass[np.concatenate([[end], ids])]
        return np.bincount(c[:-1] * wide + c[1:], minlength=wide * wide)
    return with_pairs(vocab, _bincounts(learned, pairs, end, wide * wide).reshape(wide, wide)), int(counts.sum())


def fit(prepared: DataFrame, vocab: Vocabulary, n_ids: int, rate: float = 6e-3) -> np.ndarray:
    """Weights from all training texts, which hold `n_ids` ids: each is learned in one of `ROUNDS` averaged rounds."""
    spark = prepared.sparkSession
    parts = max(1, round(n_ids / ROUNDS / PART_IDS))
    learned = prepared.where("NOT held_out").select("row", "ids")
    flat = initial()
    schema = pa.schema([("weight", pa.int64()), ("values", pa.list_(pa.float32()))])
    for turn in range(ROUNDS):
        chosen = learned.where(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == turn)
        shared = spark.sparkContext.broadcast((flat, vocab))
        pace = rate * (1 - turn / ROUNDS)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, pace=pace) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(*shared.value, pace)
            for batch in batches:
                for raw in batch.column("ids"):
                    trainer.add(np.frombuffer(raw.as_buffer(), "<u2"))
            trainer.step()
            if trainer.seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([trainer.seen], pa.int64()), pa.array([trainer.flat.tolist()], schema.field(1).type)], schema=schema)
        made = chosen.repartition(parts, "row").sortWithinPartitions("row").select("ids").mapInArrow(learn, "weight long, values array<float>")
        each = made.select("weight", F.posexplode("values").alias("at", "value"))
        mean = each.groupBy("at").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value")).collect()
        for at, value in mean:
            flat[at] = value
        shared.unpersist()
    return flat


def scored(prepared: DataFrame, vocab: Vocabulary, flat: np.ndarray) -> DataFrame:
    """`prepared` without ids, with `score`: log10 of the text's chance, the end included."""
    shared = prepared.sparkSession.sparkContext.broadcast((flat, vocab))
    kept = [c for c in prepared.columns if c != "ids"]

    schema = to_arrow_schema(StructType([prepared.schema[c] for c in kept] + [StructField("score", DoubleType())]))

    def chances(texts: list[bytes], p: dict[str, np.ndarray], vocab: Vocabulary) -> np.ndarray:
        owners, parts, total = [], [], np.zeros(len(texts))

        def flush() -> None:
            x, y, score = (np.concatenate(c) for c in zip(*parts))
            who = np.repeat(np.array([o for o, _ in owners]), [n for _, n in owners])
            for at in range(0, len(x), BATCH):
                cut = slice(at, at + BATCH)
                found = log_chances(p, vocab, x[cut], y[cut], score[cut])
                total[:] += np.bincount(np.repeat(who[cut], score[cut].sum(1)), found, len(total))
            owners.clear()
            parts.clear()
        held = 0
        for n, raw in enumerate(texts):
            made = windows(np.frombuffer(raw, "<u2"), vocab.end)
            owners.append((n, len(made[0])))
            parts.append(made)
            held += len(made[0])
            if held >= 16 * BATCH:
                flush()
                held = 0
        if parts:
            flush()
        return total / np.log(10)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vocab = shared.value
        p = unpacked(weights)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = chances(part.column("ids").to_pylist(), p, vocab)
                columns = [part.column(c).cast(schema.field(c).type) for c in kept]  # as they came, never as Python values
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], schema=schema)
    ddl = ", ".join(f"{c} {prepared.schema[c].dataType.simpleString()}" for c in kept) + ", score double"
    return prepared.mapInArrow(score, ddl)


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per row: key, `held_out, n_tokens, n_known, train_tokens, base_score, score`."""
    importable(docs.sparkSession)
    path = tokenizer or default_path()
    rows = docs.select(named(key).cast("long").alias("key"), held_out(key).alias("held_out"), text_or_empty(text).alias("text"))
    words = word_counts(rows)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    below = np.log10(total + 0.5 * (distinct + 1))
    hot = {bytes(w): float(np.log10(n + 0.5) - below) for w, n in _commonest(words, HOT_WORDS).collect()}
    prepared = _prepared(rows, hot, path, 0)
    vocab, n_ids = _counted(prepared, path)
    done = stage(scored(prepared, vocab, fit(prepared, vocab, n_ids)), "scored")
    rare = done.select("row", F.explode(F.arrays_zip("rare_word", "rare_n")).alias("r")).select(
        "row", F.col("r.rare_word").alias("word"), F.col("r.rare_n").alias("times"))
    met = rare.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5)) - F.lit(float(below)))).alias("rare_score"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    return done.join(met, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"), "score")
