"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities.

Words are known by two numbers: a hash of their bytes and a shape (how many capitals, small letters, digits, marks and
other characters). Each number has a fixed sparse random index vector; a number's word vector is the sum of the index
vectors of the words beside it (and of its own) over all documents, labelled or not. A document is the mean of its
words' vectors, with the shares of repeated and of distinct words and its length beside it.

Network and temperature are learned on at most ``SAMPLE`` labelled documents of the training fold, those with the least
hash of their id; all learning is deterministic. Every document is scored, whole. Null texts and texts without a word
are scored too, by what the network makes of no words. Without any labelled row all scores are 0.5. An id that is
labelled twice counts with its lower label, one that several documents have with the least of their texts. Ids may be
null: such rows are scored and add to the word vectors, but give no label.
Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm import bytewords as B
from gleanery.llm.bytewords import row_slices

SAMPLE = 8000  # the bound on labelled rows that are learned from
TASKS = 8  # the tasks that read the sample
BUCKETS, SHAPES, SIZE = 1 << 14, 1024, 32
WORDS = 1 << 15  # words whose neighbours are added up at once
HIDDEN, ROUNDS, SEED = 32, 400, 7


def _classes() -> np.ndarray:
    """For each byte a one in the field of its class: capital, small, digit, mark, other."""
    out = np.zeros(256, np.uint64)
    for b in range(256):
        c = chr(b)
        k = 4 if b > 127 else 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3
        out[b] = 1 << 12 * k
    return out


_CLASS = _classes()
#: The numbers of steps of each class count, and of the length.
_STEPS = ((3, 0), (2, 12), (3, 24), (4, 36), (2, 48))


def shapes(data: np.ndarray, words: B.Words) -> np.ndarray:
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_CLASS[data])])
    packed = sums[words.end] - sums[words.start]
    out = np.minimum((words.end - words.start) // 6, 3)
    for steps, shift in _STEPS:
        out = out * steps + np.minimum((packed >> np.uint64(shift)).astype(np.int64) & 0xFFF, steps - 1)
    return out


@cache
def index_vectors(n: int, seed: int) -> np.ndarray:
    """Sparse random vectors: two ones and two minus ones each."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, SIZE), np.float32)
    at = np.argsort(rng.random((n, SIZE)), axis=1)[:, :4]
    out[np.arange(n)[:, None], at] = np.array([1, 1, -1, -1], np.float32)
    return out


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, B.Words]:
    words = B.find_words(data, offsets)
    hashes = B.word_hashes(data, words)
    return hashes, (hashes >> np.uint64(50)).astype(np.int64), shapes(data, words), words


def context_sums(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed index vectors of the words up to two places away, for each hash and each shape."""
    _, bucket, shape, words = _keys(data, offsets)
    out = []
    for key, n, seed in ((bucket, BUCKETS, SEED), (shape, SHAPES, SEED + 1)):
        total = np.zeros((n, SIZE), np.float32)
        for a in range(0, len(key), WORDS):
            lo, hi = max(0, a - 2), min(len(key), a + WORDS + 2)
            near = _near(key[lo:hi], words.row[lo:hi], index_vectors(n, seed))[a - lo : a - lo + WORDS]
            mine = key[a : a + WORDS]
            order = np.argsort(mine.astype(np.uint16), kind="stable")  # below 65,536, sorted by digits
            first = np.flatnonzero(np.diff(mine[order], prepend=-1))
            total[mine[order][first]] += np.add.reduceat(near[order], first)
        out.append(total)
    return out[0], out[1]


def _near(key: np.ndarray, row: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each word the index vectors of its own number and of the words up to two places away in its document."""
    own = index[key]
    near = own.copy()
    for step in (1, 2):
        near[step:] += own[:-step]
        near[:-step] += own[step:]
        apart = np.flatnonzero(row[:-step] != row[step:])  # few: words of two documents are no neighbours
        near[apart + step] -= own[apart]
        near[apart] -= own[apart + step]
    return near


def word_vectors(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The unit word vector of each hash and of each shape, from all documents.

    A task adds up what its documents give and hands out one row for each number that it met, with whole numbers
    that Spark adds up in any order; the driver gets one row a number, ``BUCKETS + SHAPES`` at most.
    """
    names = [f"c{i}" for i in range(SIZE)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS + SHAPES, SIZE), np.int64)
        for batch in batches:
            for _, _, data, offsets in _slices(batch.column(0), 1 << 20):
                total += np.concatenate(context_sums(data, offsets)).astype(np.int64)
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, total[some].T.copy())], ["number", *names])

    parts = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(sums, "number long, " + ", ".join(f"{c} long" for c in names))
    rows = parts.groupBy("number").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    total = np.zeros((BUCKETS + SHAPES, SIZE))
    total[rows.column("number").to_numpy()] = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    return total[:BUCKETS].astype(np.float32), total[BUCKETS:].astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A row of features for each document."""
    hashes, bucket, shape, words = _keys(data, offsets)
    n = np.diff(words.first)
    some, starts = np.flatnonzero(n), words.first[:-1][n > 0]
    row = words.row
    out = np.zeros((len(n), 2 * SIZE + 4), np.float32)
    if not len(some):
        return out
    many = n[some, None].astype(np.float32)
    out[some, :SIZE] = np.add.reduceat(vectors[0][bucket], starts) / many
    out[some, SIZE : 2 * SIZE] = np.add.reduceat(vectors[1][shape], starts) / many
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(r), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    out[:, -4] = np.bincount(row[again], minlength=len(n)) / np.maximum(n, 1)
    out[:, -3] = np.bincount(r[new], minlength=len(n)) / np.maximum(n, 1)
    out[:, -2] = np.log1p(n)
    out[:, -1] = np.bincount(row, words.end - words.start, minlength=len(n)) / np.maximum(n, 1)
    return out


@dataclass
class Model:
    vectors: tuple[np.ndarray, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((features - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(vectors: tuple[np.ndarray, np.ndarray], features: np.ndarray, labels: np.ndarray) -> Model:
    """Full-batch Adam on four fifths of the rows; the rest sets the temperature."""
    size = features.shape[1] if len(labels) else 2 * SIZE + 4
    rng = np.random.default_rng(SEED)
    weights = [rng.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
    if not len(labels):
        return Model(vectors, np.zeros(size), np.ones(size), weights)
    weights[2] = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x, y = (features - mean) / scale, labels.astype(float)
    held = np.arange(len(y)) % 5 == 4
    xs, ys = x[~held], y[~held]
    share = np.clip(ys.mean(), 0.02, 0.98)
    cost = np.where(ys > 0, 0.5 / share, 0.5 / (1 - share)) / len(ys)  # both labels weigh the same
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, ROUNDS + 1):
        hidden = np.tanh(xs @ weights[0] + weights[1])
        off = (_sigmoid(hidden @ weights[2] + weights[3][0]) - ys) * cost
        back = off[:, None] * weights[2] * (1 - hidden**2)
        slopes = [xs.T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ off + 1e-4 * weights[2], off.sum(keepdims=True)]
        for k, g in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, weights)
    if held.any():
        z, want = model.logits(features[held]), y[held]
        grid = np.exp(np.linspace(-1.5, 3, 91))
        loss = [-np.mean(np.log(np.clip(np.where(want > 0, _sigmoid(z / t), 1 - _sigmoid(z / t)), 1e-9, 1))) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def _slices(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = B.buffer_of(column)
    for a, b in row_slices(offsets, limit):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def fold(id: str) -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % 3


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id: str = "doc_id") -> Model:
    """The model learned from the labelled rows of the training fold."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & (fold(id) != 1))
    known = known.groupBy(F.col(id).alias("_id")).agg(F.min(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
    some = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("text"))
    some = some.join(F.broadcast(known), "_id").groupBy("_id", "label").agg(F.min("text").alias("text")).repartition(TASKS)
    vectors = word_vectors(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in _slices(batch.column("text")):
                rows = pooled(data, offsets, shared.value)
                columns = [batch.column("_id").slice(a, b - a), batch.column("label").slice(a, b - a), pa.array([r.tobytes() for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "label", "features"])

    kind = some.schema["_id"].dataType.simpleString()
    rows = some.mapInArrow(features, f"_id {kind}, label int, features binary").collect()  # at most SAMPLE rows
    rows.sort(key=lambda r: (r["_id"], r["features"]))
    x = np.array([np.frombuffer(r["features"], np.float32) for r in rows], np.float64)
    return train(vectors, x, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    some = docs.select(F.col(id).alias("doc_id"), F.coalesce(fold(id) == 1, F.lit(False)).alias("held_out"), F.col(text).cast("binary").alias("text"))
    kind = some.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            found = [model.scores(pooled(data, offsets, model.vectors)) for _, _, data, offsets in _slices(batch.column(2))]
            p = np.concatenate(found) if found else np.zeros(0)
            columns = [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return some.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
