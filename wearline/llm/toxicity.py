"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other, and each model sees, besides the text's features, the probabilities of
the categories before it. For training these come from models that did not see the row (out of fold), as they will when
scoring. Features are words and beginnings of words that toxic training rows hold more often than clean ones, counted
over all labelled training rows; of words longer than ``LONGEST`` letters the first ones count. The linear models are
fitted on a bounded sample of the rows.

The labels give one category, ``toxic``. Two more come before it, derived from the labelled rows: ``abusive`` (toxic,
with a telling feature) and ``dense`` (toxic, with several). They say no more than the label and the features do, and the
features are chosen before the folds are cut, so without further label columns the chain is one classifier in three
steps. A caller with more label columns names them instead.

NULL text counts as empty, and a text without features gets the models' base rates. Labels that are NULL or whose
document is missing are not used; of equal texts with equal labels one is used. Without a single toxic or clean training row, all probabilities are 0. Repeated rows and NULL ids
stay rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.columns import PUNCTUATION, words
from wearline.llm.common import by_column, by_task, fresh, load, materialised, ready
from wearline.session import broadcast_if_small

# Features kept, and least number of toxic rows that hold one.
FEATURES = 2048
LEAST_ROWS = 2
# How many times more often toxic rows must hold a feature than clean ones.
LEAST_LIFT = 3.0
# Rows the linear models are fitted on.
SAMPLE = 8192
FOLDS = 4
BEGINNINGS = (4, 5)
LONGEST = 40
# Features that would look as telling by chance alone.
BY_CHANCE = 1.0
# Features that make a toxic text a dense one.
DENSE = 4
THRESHOLD = 0.5


def features_of(word: str) -> list[str]:
    """The word without punctuation around it, long ones by their first letters, and its first letters marked as such."""
    plain = word.strip(PUNCTUATION)
    if not plain:
        return []
    return [plain[:LONGEST], *("^" + plain[:n] for n in BEGINNINGS if len(plain) > n)]


def _sets(texts: pa.Array) -> Iterator[set[str]]:
    """The features of each text."""
    bounds, codes, distinct = words(texts)
    of = [features_of(w) for w in distinct]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield {f for c in np.unique(codes[a:b]).tolist() for f in of[c]}


def feature_counts(labelled: DataFrame) -> DataFrame:
    """In how many toxic and clean rows of ``labelled`` (text, toxic) each feature is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for label, held in zip(batch.column("toxic").to_pylist(), _sets(batch.column("text")), strict=True):
                counts[int(label > 0)].update(held)
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(names, pa.string()),
                    "toxic": pa.array([counts[1][n] for n in names], pa.int64()),
                    "clean": pa.array([counts[0][n] for n in names], pa.int64()),
                }
            )

    rows = labelled.select("text", "toxic").mapInArrow(by_task(run), "feature string, toxic long, clean long")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit_linear(x: np.ndarray, y: np.ndarray, *, l2: float = 1e-5, steps: int = 400, rate: float = 0.3) -> np.ndarray:
    """Weights of a logistic regression, the last one the intercept."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    n = max(len(x), 1)
    w = np.zeros(x.shape[1], dtype=x.dtype)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = x.T @ (sigmoid(x @ w) - y) / n + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


@dataclass
class Chain:
    """Category names in order, the features' columns, and one weight vector per category."""

    categories: list[str]
    columns: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> None:
        seen = x
        for k in range(len(self.categories)):
            y = labels[:, k].astype(np.float32)
            unseen = np.zeros(len(x), dtype=np.float32)
            for f in np.unique(folds):
                inside = folds == f
                unseen[inside] = _scores(seen[inside], fit_linear(seen[~inside], y[~inside]))
            self.weights.append(fit_linear(seen, y))
            seen = np.hstack([seen, unseen[:, None]])

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros((len(x), len(self.categories)))
        for w in self.weights:
            x = np.hstack([x, _scores(x, w)[:, None].astype(np.float32)])
        return x[:, -len(self.categories) :].astype(np.float64)

    def score_texts(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of each category; features are looked up once per distinct word."""
        bounds, codes, distinct = words(texts)
        found = [[self.columns[f] for f in features_of(w) if f in self.columns] for w in distinct]
        telling = np.array([bool(f) for f in found], dtype=bool)
        x = np.zeros((len(texts), len(self.columns)), dtype=np.float32)
        places = np.flatnonzero(telling[codes])
        owners = np.searchsorted(bounds, places, side="right") - 1
        for owner, code in zip(owners.tolist(), codes[places].tolist(), strict=True):
            x[owner, found[code]] = 1
        return self.predict(x)


def train(docs: DataFrame, labels: DataFrame, categories: list[str] | None = None) -> Chain:
    """Learn a chain from ``labels`` (doc_id, toxic and any ``categories`` before it) of ``docs`` (doc_id, text)."""
    ready(docs.sparkSession)
    given = categories or []
    chain = Chain([*(given or ["abusive", "dense"]), "toxic"])
    chosen = labels.where(F.col("toxic").isNotNull()).select("doc_id", *[F.col(c).cast("int") for c in [*given, "toxic"]])
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(broadcast_if_small(chosen), "doc_id")
    # One row of equal texts, or copies would count as evidence over and over.
    singles = rows.groupBy(F.xxhash64("text").alias("_text"), "toxic").agg(F.min("doc_id").alias("doc_id"))
    rows = rows.join(broadcast_if_small(singles.select("doc_id").distinct()), "doc_id", "left_semi")
    clean, toxic = rows.agg(F.count_if(F.col("toxic") <= 0), F.count_if(F.col("toxic") > 0)).first()
    if not toxic or not clean:
        return chain
    counts = materialised(feature_counts(rows), "toxicity-features")
    n, rate = counts.count(), toxic / (toxic + clean)
    t, c = F.col("toxic"), F.col("clean")
    surprise = t * F.log(t / ((t + c) * rate)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - rate)))).otherwise(0.0)
    kept = (
        counts.where((t >= LEAST_ROWS) & (t > (t + c) * rate))
        .select("feature", surprise.alias("surprise"), (t * clean >= LEAST_LIFT * c * toxic).alias("lifted"))
        .where(F.col("lifted") & (F.col("surprise") > math.log(max(n, 1) / BY_CHANCE)))
        .orderBy(F.desc("surprise"), "feature")
        .limit(FEATURES)
        .collect()
    )
    chain.columns = {r["feature"]: i for i, r in enumerate(kept)}
    columns = chain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(columns[f] for f in s if f in columns) for s in _sets(batch.column("text"))]
            rest = batch.drop_columns(["text"])
            yield rest.append_column("held", pa.array(held, pa.list_(pa.int32())))

    kind = rows.schema["doc_id"].dataType.simpleString()
    names = "".join(f", {n} int" for n in [*given, "toxic"])
    # At most SAMPLE rows reach the driver: those of the smallest hashes of ids.
    some = singles.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = (
        rows.join(F.broadcast(some), "doc_id", "left_semi")
        .select("doc_id", *given, "toxic", "text")
        .mapInArrow(by_task(run), f"doc_id {kind}{names}, held array<int>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "held")
        .limit(SAMPLE)
        .collect()
    )
    x = np.zeros((len(sample), len(columns)), dtype=np.float32)
    y = np.zeros((len(sample), len(chain.categories)), dtype=np.float32)
    folds = np.array([zlib.crc32(str(r["doc_id"]).encode()) % FOLDS for r in sample])
    for i, r in enumerate(sample):
        x[i, r["held"]] = 1
        signs = len(r["held"])
        before = [r[g] > 0 for g in given] if given else [signs >= 1, signs >= DENSE]
        y[i] = [*(b and r["toxic"] > 0 for b in before), r["toxic"] > 0]
    chain.fit(x, y, folds)
    return chain


def scored(docs: DataFrame, chain: Chain, text: str = "text") -> Column:
    """The probabilities of the chain's categories as a struct column of ``docs``."""
    ready(docs.sparkSession)
    names = [f"p_{c}" for c in chain.categories]

    def compute(column: pa.Array) -> pa.Array:
        p = chain.score_texts(column)
        return pa.StructArray.from_arrays([pa.array(p[:, k]) for k in range(len(names))], names=names)

    return by_column(compute, ", ".join(f"{n} double" for n in names))(F.col(text))


def kept_documents(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that the chain calls toxic; columns as given."""
    (scores,) = fresh(docs, "_scores")
    return (
        docs.withColumn(scores, scored(docs, chain))
        .where(F.col(scores)["p_toxic"] < threshold)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of the whole table ``documents``, learned from ``labels``."""
    docs = load(spark, sf_dir, "documents")
    chain = train(docs, load(spark, sf_dir, "labels"))
    scores = docs.select("doc_id", scored(docs, chain).alias("s")).select("doc_id", "s.*")
    return scores.withColumn("toxic", F.col("p_toxic") >= THRESHOLD)
