"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: each word (a hash bucket, so the table is bounded) has a fixed sparse ternary index vector;
its word vector is the sum, over all documents, of the index vectors of its neighbours within two places.
Tasks sum their own documents; the partial tables are added up in a tree of bounded groups. A document's
features are pools of its word vectors and of nothing else: their weighted mean and spread (rare words weigh
more), and the means of the products of each vector with the next one and the one after that. A network of one hidden layer, in numpy, is trained on a bounded sample of labelled rows (`TRAIN_ROWS`, least
hashes first), and a temperature fitted on rows that the weights never saw calibrates its probabilities.

Only the text enters a score. Rows whose crc32(doc_id as text) mod 5 is 0 are never learnt from.

Defined results: null text is empty; an empty text is scored from zero features; repeated rows are scored
alike; a null doc_id is never held out nor labelled; labels other than 0 and 1 are ignored, and the largest
of several counts; with one class or no labels the score is the rate of 1 (0.5 for none); an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import materialize

BUCKETS = 1 << 14
DIMS = 32
NONZERO = 2
WINDOW = 2
HIDDEN = 32
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5
BLOCK = 1024
FAN_IN = 64
RARE = 1e-3
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\s]+")
STRETCH = 400_000
FEATURES = (2 + WINDOW) * DIMS


class Buckets(dict):
    """Word to bucket; a bounded memo."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        bucket = self[word] = zlib.crc32(word) % BUCKETS
        return bucket


_MEMO = Buckets()


def word_buckets(text: bytes) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, TOKEN.findall(text.lower())), dtype=np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector; fixed by a seed."""
    rng = np.random.default_rng(7)
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def _stretches(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of some documents end to end, and each document's number of words."""
    parts: list[np.ndarray] = []
    size = 0
    for text in texts:
        parts.append(word_buckets(text))
        size += len(parts[-1])
        if size > STRETCH:
            yield np.concatenate(parts), np.array([len(p) for p in parts])
            parts, size = [], 0
    if parts:
        yield np.concatenate(parts), np.array([len(p) for p in parts])


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (x.as_py() for x in batch.column("text"))


def word_table(docs: DataFrame) -> np.ndarray:
    """[bucket, DIMS + 1]: context sums and, last, counts over all documents (about 2 MB, whatever the input)."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros((BUCKETS, DIMS + 1))
        any_rows = False
        for batch in batches:
            for words, lengths in _stretches(_texts(batch)):
                any_rows = True
                doc = np.repeat(np.arange(len(lengths)), lengths)
                total[:, DIMS] += np.bincount(words, minlength=BUCKETS)
                flat = np.zeros(BUCKETS * DIMS)
                for step in range(1, WINDOW + 1):
                    same = doc[step:] == doc[:-step]
                    left, right = words[:-step][same], words[step:][same]
                    for k in range(NONZERO):
                        flat += np.bincount(left * DIMS + place[right, k], weights=sign[right, k], minlength=BUCKETS * DIMS)
                        flat += np.bincount(right * DIMS + place[left, k], weights=sign[left, k], minlength=BUCKETS * DIMS)
                total[:, :DIMS] += flat.reshape(BUCKETS, DIMS)
        if any_rows:
            part = int.from_bytes(np.random.default_rng().bytes(4), "little")  # only spreads the sums
            blocks = range(0, BUCKETS, BLOCK)
            data = [zlib.compress(total[b : b + BLOCK].astype("<i4").tobytes(), 1) for b in blocks]
            yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK for b in blocks]), pa.array([part] * len(data), pa.int64()), pa.array(data, pa.binary())], names=["block", "part", "data"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK * (DIMS + 1), dtype=np.int64)
        for x in table.column("data"):
            raw = zlib.decompress(x.as_py())
            total += np.frombuffer(raw, dtype="<i4" if len(raw) == 4 * len(total) else "<i8")
        return pa.table({"block": [table.column("block")[0].as_py()], "part": pa.array([table.column("part")[0].as_py() // FAN_IN], pa.int64()), "data": pa.array([zlib.compress(total.astype("<i8").tobytes(), 1)], pa.binary())})

    schema = "block long, part long, data binary"
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    sums = materialize(docs.select(text).mapInArrow(partial, schema), "word-sums")
    rows = sums.count()
    groups = max(1, -(-rows // (BUCKETS // BLOCK) // FAN_IN))
    while True:
        sums = sums.groupBy("block", F.pmod("part", F.lit(groups)).alias("group")).applyInArrow(lambda t: add(t), schema)
        if groups == 1:
            break
        groups = -(-groups // FAN_IN)
    out = np.zeros((BUCKETS, DIMS + 1))
    for block, data in sums.select("block", "data").collect():  # BUCKETS / BLOCK rows
        out[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(zlib.decompress(data), dtype="<i8").reshape(BLOCK, DIMS + 1)
    return out


def pooling_table(table: np.ndarray) -> np.ndarray:
    """[bucket, DIMS + 1]: unit word vectors and, last, the words' weights in a pool."""
    counts = table[:, DIMS]
    vectors = table[:, :DIMS] / np.maximum(1.0, counts)[:, None]
    vectors -= np.average(vectors, axis=0, weights=counts) if counts.sum() else 0.0
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    weight = RARE / (RARE + counts / max(1.0, counts.sum()))
    return np.hstack([vectors / np.maximum(norms, 1e-9), weight[:, None]]).astype(np.float32)


def features(texts: Iterable[bytes], pool: np.ndarray) -> np.ndarray:
    """A row for each text: weighted mean and spread of its word vectors, means of products with the following ones."""
    vectors, weights = pool[:, :DIMS], pool[:, DIMS]
    rows = [np.zeros((0, FEATURES), dtype=np.float32)]
    for words, lengths in _stretches(texts):
        full = lengths > 0
        starts = (np.cumsum(lengths) - lengths)[full]
        x = np.zeros((len(lengths), FEATURES), dtype=np.float32)
        if len(words):
            w = weights[words][:, None]
            v = vectors[words]
            mass = np.add.reduceat(w, starts, axis=0)
            x[full, :DIMS] = np.add.reduceat(v * w, starts, axis=0) / mass
            square = np.add.reduceat(v * v * w, starts, axis=0) / mass
            x[full, DIMS : 2 * DIMS] = np.sqrt(np.maximum(0.0, square - x[full, :DIMS] ** 2))
            doc = np.repeat(np.arange(len(lengths)), lengths)
            for step in range(1, WINDOW + 1):
                product = np.zeros_like(v)
                product[:-step] = v[step:] * v[:-step] * (doc[step:] == doc[:-step])[:, None]
                x[full, (1 + step) * DIMS : (2 + step) * DIMS] = np.add.reduceat(product, starts, axis=0) / np.maximum(1, lengths[full] - step)[:, None]
        rows.append(x)
    return np.concatenate(rows)


@dataclass
class Network:
    """score = sigmoid((tanh(z W1 + b1) w2 + b2) / temperature), z the features in standard units."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 3) -> Network:
    """Adam on the log loss with weight decay; every fifth row only fits the temperature."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if n else (np.zeros(d), np.ones(d))
    if n < 20 or y.min() == y.max():
        rate = np.clip(y.mean() if n else 0.5, 0.01, 0.99)
        return Network(mean, scale, np.zeros((d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(rate / (1 - rate))))
    check = np.arange(n) % 5 == 4
    z, t = ((x - mean) / scale)[~check], y[~check]
    params = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        for at in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            step += 1
            h = np.tanh(z[at] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40)))
            e = (p - t[at]) / len(at)
            back = np.outer(e, params[2]) * (1 - h * h)
            grads = [z[at].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ e + 1e-4 * params[2], np.array([e.sum()])]
            for k, g in enumerate(grads):
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    logits, told = net.logits(x[check]), y[check]
    loss = lambda s: np.logaddexp(0, -(2 * told - 1) * logits / s).mean()
    net.temperature = float(min(np.geomspace(0.3, 10, 80), key=loss))
    return net


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _text() -> F.Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def labelled_rows(docs: DataFrame, labels: DataFrame, pool) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most TRAIN_ROWS labelled documents that are not held out."""
    told = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").cast("double").alias("y"))
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    known = told.filter(~held_out(F.col("id"))).join(ids, "id", "left_semi")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), _text().alias("text")).join(F.broadcast(sample), "id")  # TRAIN_ROWS rows at most

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(_texts(batch), pool.value)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * FEATURES
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel())), batch.column("y")], names=["id", "x", "y"])

    each = texts.select("id", "text", "y").mapInArrow(run, "id long, x array<float>, y double")
    rows = each.groupBy("id").agg(F.min("x").alias("x"), F.first("y").alias("y")).orderBy(F.xxhash64("id"), "id").collect()
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, FEATURES)
    return x, np.array([r["y"] for r in rows], dtype=np.float64)


def fit(docs: DataFrame, labels: DataFrame):
    """A function from texts to scores, to be sent to tasks."""
    pool = docs.sparkSession.sparkContext.broadcast(pooling_table(word_table(docs)))
    net = train(*labelled_rows(docs, labels, pool))
    return lambda texts: net.score(features(texts, pool.value).astype(np.float64))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The operator: doc_id, held_out, score, predicted; one row for each document."""
    score = fit(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score(_texts(batch)), pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), _text().alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents without those that the classifier rejects; scored and filtered in one pass, no shuffle."""
    score = fit(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((x.as_py() or "").encode() for x in batch.column("text"))
            yield batch.filter(pa.array(score(texts) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
