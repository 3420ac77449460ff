"""Quality scores: random-indexing word vectors, pooled, and a small network.

Every word bucket has a sparse random index vector. A word's vector is the sum
of the index vectors of its neighbours, rotated by their distance, over all
texts. A document is the mean of its words' unit vectors, with its length and the
mean cosine of neighbouring words. A network with one
hidden layer, written in numpy, is trained on labelled documents, and a temperature
fitted on held-back training rows makes its scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.support import Scratch, by_value, crc_part, table
from rollcall.llm.wordhash import Hasher, lowered, pieces, text_bytes

by_value(__name__)

# Word buckets, the first ones for kinds of tokens; width of the vectors; nonzero places of an index vector.
BUCKETS, KINDS, WIDTH, PLACES = 8192, 8, 64, 4
NEAR = (1, 2)
# Of a document: its mean vector, the logarithm of its length, and how alike neighbouring words are.
FEATURES = WIDTH + 2
SEED = 4711
# Labelled rows the network is trained on: those with the smallest hash of doc_id.
TRAINING_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
CHUNK = 300_000


def byte_classes() -> np.ndarray:
    """0 white space, 1 letters and bytes of other scripts, 2 digits, 3 punctuation, 4 line ends."""
    out = np.full(256, 3, dtype=np.int8)
    out[[32, 9, 11, 12, 13]] = 0
    out[10] = 4
    out[48:58] = 2
    out[65:91] = out[97:123] = 1
    out[128:] = 1
    return out


class Reader:
    """Token buckets of texts."""

    def __init__(self):
        self.hasher, self.low, self.classes = Hasher(), lowered(), byte_classes()

    def tokens(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each run of one byte class, and the number of runs up to each text's begin."""
        kind = self.classes[data]
        edge = np.ones(len(data), dtype=bool)
        edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 4)
        edge[begins[:-1][begins[:-1] < len(data)]] = True
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(data))
        full = kind[starts] != 0
        starts, ends = starts[full], ends[full]
        hashed = self.hasher.ranges(self.low[data], starts, ends)
        bucket = (hashed >> np.uint64(20)).astype(np.int64) % (BUCKETS - KINDS) + KINDS
        # Words in capitals, numbers and line ends are kinds of their own.
        upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
        kinds = kind[starts]
        capitals = (kinds == 1) & (ends - starts > 1) & (2 * (upper[ends] - upper[starts]) > ends - starts)
        bucket[capitals] = 1
        bucket[kinds == 2] = 2
        bucket[kinds == 4] = 3
        return bucket, np.searchsorted(starts, begins)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Nonzero places and their signs for each bucket."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    return rng.integers(0, WIDTH, (BUCKETS, PLACES)), rng.choice([-1.0, 1.0], (BUCKETS, PLACES))


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word vectors of one partition: (bucket, vector as bytes)."""
    reader, (places, signs) = Reader(), index_vectors()
    total = np.zeros(BUCKETS * WIDTH)
    for batch in batches:
        data, begins = text_bytes(batch.column(0))
        for a, b in pieces(begins, CHUNK):
            bucket, first = reader.tokens(data[begins[a] : begins[b]], begins[a : b + 1] - begins[a])
            owner = np.repeat(np.arange(b - a), np.diff(first))
            for far in NEAR:
                same = np.flatnonzero(owner[far:] == owner[:-far])
                left, right = bucket[same], bucket[same + far]
                for word, other, turn in ((left, right, far), (right, left, -far)):
                    cells = word[:, None] * WIDTH + (places[other] + turn) % WIDTH
                    total += np.bincount(cells.ravel(), weights=signs[other].ravel(), minlength=BUCKETS * WIDTH)
    total = total.reshape(BUCKETS, WIDTH).astype("<i4")
    used = np.flatnonzero(total.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([total[i].tobytes() for i in used], pa.binary())], names=["bucket", "vector"]
        )


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by bucket; a task holds at most one vector per bucket."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(v, "<i4").astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], names=["bucket", "vector"]
        )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all word buckets, from all texts; a table of fixed size."""
    parts = docs.select("text").mapInArrow(gather, "bucket bigint, vector binary")
    sums = parts.repartition("bucket").mapInArrow(add_up, "bucket bigint, vector array<bigint>")
    out = np.zeros((BUCKETS, WIDTH))
    for row in sums.collect():
        out[row["bucket"]] = row["vector"]
    out -= out.mean(axis=0)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(batches: Iterator[pa.RecordBatch], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Features of each text; zeros without tokens."""
    reader = Reader()
    for batch in batches:
        data, begins = text_bytes(batch.column(2))
        out = np.zeros((batch.num_rows, FEATURES), dtype=np.float32)
        for a, b in pieces(begins, CHUNK):
            bucket, first = reader.tokens(data[begins[a] : begins[b]], begins[a : b + 1] - begins[a])
            n = np.diff(first)
            some = np.flatnonzero(n)
            if len(some):
                words = vectors[bucket]
                sums = np.add.reduceat(words, first[:-1][some], axis=0, dtype=np.float64)
                out[a + some, :WIDTH] = sums / n[some, None]
                out[a + some, WIDTH] = np.log1p(n[some]) / 10
                # The first word of a text has no neighbour before it.
                alike = np.zeros(len(bucket))
                alike[1:] = np.einsum("ij,ij->i", words[1:], words[:-1])
                alike[first[:-1][some]] = 0
                out[a + some, WIDTH + 1] = np.add.reduceat(alike, first[:-1][some]) / n[some]
        cells = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), FEATURES).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells], names=["doc_id", "held_out", "vector"])


class Network:
    """One hidden layer, trained by Adam on the log loss; seeded, so equal data give equal weights."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.rate = float(y.mean()) if len(y) else 0.5
        self.layers: list[np.ndarray] = []
        self.temperature = 1.0
        if len(y) < 10 or self.rate in (0.0, 1.0):
            return
        rng = np.random.Generator(np.random.PCG64(SEED))
        order = rng.permutation(len(y))
        held, used = order[: len(y) // 5], order[len(y) // 5 :]
        self.mean, self.scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
        xs = (x - self.mean) / self.scale
        width = x.shape[1]
        self.layers = [
            rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        first, second = [np.zeros_like(w) for w in self.layers], [np.zeros_like(w) for w in self.layers]
        step = 0
        for _ in range(EPOCHS):
            rng.shuffle(used)
            for i in range(0, len(used), BATCH):
                step += 1
                at = used[i : i + BATCH]
                for j, g in enumerate(self.gradients(xs[at], y[at])):
                    first[j] = 0.9 * first[j] + 0.1 * g
                    second[j] = 0.999 * second[j] + 0.001 * g * g
                    change = first[j] / (1 - 0.9**step) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
                    self.layers[j] = self.layers[j] - RATE * (change + DECAY * self.layers[j])
        # The temperature with the least log loss on rows the weights have not seen.
        z = self.raw(xs[held])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        sign = 2 * y[held] - 1
        self.temperature = float(grid[np.argmin([np.logaddexp(0, -sign * z / t).mean() for t in grid])])

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w1, b1, w2, b2 = self.layers
        h = np.maximum(x @ w1 + b1, 0)
        d = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -60, 60))) - y) / len(y)
        back = np.outer(d, w2) * (h > 0)
        return [x.T @ back, back.sum(axis=0), h.T @ d, np.array([d.sum()])]

    def raw(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1; the share of label 1 where nothing could be learned."""
        if not self.layers:
            return np.full(len(x), self.rate)
        z = self.raw((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def score(batches: Iterator[pa.RecordBatch], network: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, FEATURES)
        p = network.score(x.astype(float))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )


def train(pooled: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Network:
    """A network from at most ``rows`` labelled documents outside the held-out fold."""
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    joined = pooled.where("NOT held_out").join(known, "doc_id").select("doc_id", "quality", "vector")
    sample = joined.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows).toPandas()
    x = np.array(sample["vector"].tolist(), dtype=float).reshape(len(sample), FEATURES)
    return Network(x, sample["quality"].to_numpy(dtype=float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Rows whose crc32(doc_id) mod 3 is 1 are held out of training. NULL and empty
    texts have a zero vector and are scored like any other; labels other than
    0 and 1 teach nothing. Without labels of both kinds the score is constant.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    vectors = word_vectors(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (crc_part("doc_id", 3) == 1).alias("held_out"), "text")
    pooled = rows.mapInArrow(lambda it: pool(it, vectors), "doc_id bigint, held_out boolean, vector array<float>")
    pooled = scratch.save(pooled, "pooled")
    network = train(pooled, labels)
    return pooled.mapInArrow(
        lambda it: score(it, network), "doc_id bigint, held_out boolean, score double, predicted int"
    )


def op6_quality(spark: SparkSession, directory: str) -> DataFrame:
    return scored(table(spark, directory, "documents"), table(spark, directory, "labels"))
