"""Text quality by a factorisation machine.

Inputs of a score are a text's words, hashed into a fixed number of buckets, statistics of its structure, and its size as
metadata. Besides a weight each, inputs interact in pairs through the dot products of low-rank vectors. The sum over
all pairs takes linear time: ``sum_{i<j} <v_i, v_j> x_i x_j`` is half of, over the ranks, the square of ``sum v_i x_i``
less the sum of ``v_i^2 x_i^2``. The machine is fitted on a bounded sample of labelled rows.

Labels, language, source and id are no inputs. NULL text counts as empty; an empty text has no words and zero statistics
and is scored like any other. NULL labels and labels of missing documents are not used. Without labels of both kinds
every score is 0.5. Repeated rows and NULL ids stay rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.columns import CLASSES, PUNCTUATION, character_classes, words
from wearline.llm.common import by_column, by_task, held_out, load, ready

BUCKETS = 4096
RANK = 8
# Labelled rows the machine is fitted on.
SAMPLE = 8192
EPOCHS = 12
BATCH = 256
STATISTICS = [*CLASSES, "size", "words", "word_length", "distinct", "repeated", "common", "runs"]


def bucket(word: str) -> int:
    plain = word.strip(PUNCTUATION)
    return zlib.crc32(plain.encode()) % BUCKETS if plain else -1


@dataclass
class Inputs:
    """Inputs of texts: (row, bucket, value) of words, and a matrix of statistics."""

    rows: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    statistics: np.ndarray


def inputs(texts: pa.Array) -> Inputs:
    n = len(texts)
    bounds, codes, distinct = words(texts)
    real = np.array([bool(w) for w in distinct], dtype=bool)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    rows, codes = rows[real[codes]], codes[real[codes]]
    per_row = np.bincount(rows, minlength=n)
    # How often each word is in each text.
    pairs, counts = np.unique(rows * max(len(distinct), 1) + codes, return_counts=True)
    pair_rows, pair_words = pairs // max(len(distinct), 1), pairs % max(len(distinct), 1)
    lengths = np.array([len(w) for w in distinct], dtype=np.float64)
    total = np.maximum(per_row, 1)
    classes = character_classes(texts)
    size = classes.sum(axis=1)
    most = np.zeros(n)
    np.maximum.at(most, pair_rows, counts)
    same = (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])
    statistics = np.column_stack(
        [
            classes / np.maximum(size, 1)[:, None],
            np.log1p(size) / 10,
            np.log1p(per_row) / 10,
            np.bincount(rows, weights=lengths[codes], minlength=n) / total / 10,
            np.bincount(pair_rows, minlength=n) / total,
            np.bincount(pair_rows, weights=(counts - 1.0) ** 2, minlength=n) / total**2,
            most / total,
            np.bincount(rows[1:][same], minlength=n) / total,
        ]
    )
    of = np.array([bucket(w) for w in distinct], dtype=np.int64)
    used = of[pair_words] >= 0
    keys, where = np.unique(pair_rows[used] * BUCKETS + of[pair_words[used]], return_inverse=True)
    values = np.log1p(np.bincount(where, weights=counts[used], minlength=len(keys)))
    key_rows = keys // BUCKETS
    norms = np.sqrt(np.bincount(key_rows, weights=values**2, minlength=n))
    return Inputs(key_rows, keys % BUCKETS, values / np.maximum(norms[key_rows], 1e-12), statistics)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Machine:
    """Weights of the buckets and, behind them, of the standardised statistics."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def _standard(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip((statistics - self.mean) / self.scale, -5, 5)

    def _sums(self, x: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Linear part, sum of v x, sum of (v x)^2 and the standardised statistics of each row."""
        n = len(x.statistics)
        dense = self._standard(x.statistics)
        linear = np.bincount(x.rows, weights=self.weights[x.buckets] * x.values, minlength=n)
        linear = linear + dense @ self.weights[BUCKETS:]
        first = dense @ self.vectors[BUCKETS:]
        second = dense**2 @ self.vectors[BUCKETS:] ** 2
        for f in range(RANK):
            part = self.vectors[x.buckets, f] * x.values
            first[:, f] += np.bincount(x.rows, weights=part, minlength=n)
            second[:, f] += np.bincount(x.rows, weights=part * part, minlength=n)
        return linear, first, second, dense

    def score(self, x: Inputs) -> np.ndarray:
        linear, first, second, _ = self._sums(x)
        return sigmoid(self.bias + linear + 0.5 * (first**2 - second).sum(axis=1))


def fit(x: Inputs, labels: np.ndarray, *, seed: int = 1, rate: float = 0.02, l2: float = 1e-4) -> Machine:
    """Adam on the logistic loss, in batches of rows in a fixed random order."""
    n, width = len(labels), BUCKETS + len(STATISTICS)
    draw = np.random.default_rng(seed)
    mean, scale = x.statistics.mean(axis=0), x.statistics.std(axis=0) + 1e-6
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(width), draw.normal(0, 0.05, (width, RANK)), mean, scale
    )
    starts = np.searchsorted(x.rows, np.arange(n + 1))
    moments = [np.zeros((width, RANK + 1)) for _ in range(2)]
    bias_moments, step = [0.0, 0.0], 0
    for _ in range(EPOCHS):
        order = draw.permutation(n)
        for i in range(0, n, BATCH):
            some = np.sort(order[i : i + BATCH])
            places = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in some])
            rows = np.repeat(np.arange(len(some)), starts[some + 1] - starts[some])
            part = Inputs(rows, x.buckets[places], x.values[places], x.statistics[some])
            linear, first, second, dense = machine._sums(part)
            error = sigmoid(machine.bias + linear + 0.5 * (first**2 - second).sum(axis=1)) - labels[some]
            error /= len(some)
            gradient = np.zeros((width, RANK + 1))
            pull = error[rows] * part.values
            gradient[:BUCKETS, 0] = np.bincount(part.buckets, weights=pull, minlength=BUCKETS)
            gradient[BUCKETS:, 0] = dense.T @ error
            for f in range(RANK):
                own = machine.vectors[part.buckets, f] * part.values
                gradient[:BUCKETS, f + 1] = np.bincount(
                    part.buckets, weights=pull * (first[rows, f] - own), minlength=BUCKETS
                )
            gradient[BUCKETS:, 1:] = dense.T @ (error[:, None] * first)
            gradient[BUCKETS:, 1:] -= (dense**2).T @ error[:, None] * machine.vectors[BUCKETS:]
            gradient[:, 0] += l2 * machine.weights
            gradient[:, 1:] += l2 * machine.vectors
            step += 1
            for m, g, d in ((0, gradient, 0.9), (1, gradient**2, 0.99)):
                moments[m] = d * moments[m] + (1 - d) * g
            up = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
            machine.weights = machine.weights - rate * up[:, 0]
            machine.vectors = machine.vectors - rate * up[:, 1:]
            slope = float(error.sum())
            bias_moments = [0.9 * bias_moments[0] + 0.1 * slope, 0.99 * bias_moments[1] + 0.01 * slope**2]
            machine.bias -= rate * bias_moments[0] / (1 - 0.9**step) / (
                np.sqrt(bias_moments[1] / (1 - 0.99**step)) + 1e-8
            )
    return machine


def train(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """Learn from ``labels`` (doc_id, quality) of ``docs`` (doc_id, text); None without labels of both kinds."""
    ready(docs.sparkSession)
    chosen = labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = inputs(batch.column("text"))
            cuts = np.searchsorted(x.rows, np.arange(batch.num_rows + 1))
            held = [slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("quality"),
                    pa.array([x.buckets[h].astype("<u2").tobytes() for h in held], pa.binary()),
                    pa.array([x.values[h].astype("<f4").tobytes() for h in held], pa.binary()),
                    pa.array(list(x.statistics), pa.list_(pa.float64())),
                ],
                names=["doc_id", "quality", "buckets", "weights", "statistics"],
            )

    # At most SAMPLE rows with at most BUCKETS inputs each reach the driver: those of the smallest hashes of ids.
    kind = docs.schema["doc_id"].dataType.simpleString()
    some = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    sample = (
        rows.select("doc_id", "quality", "text")
        .mapInArrow(by_task(run), f"doc_id {kind}, quality int, buckets binary, weights binary, statistics array<double>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "buckets")
        .limit(SAMPLE)
        .collect()
    )
    marks = np.array([float(r["quality"] > 0) for r in sample])
    if not len(marks) or marks.min() == marks.max():
        return None
    buckets = [np.frombuffer(r["buckets"], "<u2") for r in sample]
    return fit(
        Inputs(
            np.repeat(np.arange(len(sample)), [len(b) for b in buckets]),
            np.concatenate(buckets).astype(np.int64),
            np.concatenate([np.frombuffer(r["weights"], "<f4") for r in sample]).astype(np.float64),
            np.array([r["statistics"] for r in sample]),
        ),
        marks,
    )


def scored(docs: DataFrame, machine: Machine | None, text: str = "text") -> Column:
    """The score of a text column of ``docs``, between 0 and 1."""
    ready(docs.sparkSession)
    if machine is None:
        return F.lit(0.5)

    def compute(column: pa.Array) -> pa.Array:
        return pa.array(machine.score(inputs(column)))

    return by_column(compute, "double")(F.col(text))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of the whole table ``documents``, learned from two thirds of the ids in ``labels``."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    apart = held_out(F.col("doc_id"), 3)
    machine = train(docs, labels.where(~apart))
    return docs.select("doc_id", apart.alias("held_out"), scored(docs, machine).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
