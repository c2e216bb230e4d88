"""Hard negatives by BOND: branch and bound on vectors stored by dimension.

Vectors lie in blocks, in which each dimension is one array, rows are sorted by label, and the smallest and largest value of each dimension is known. An
anchor reads a block's dimensions in descending magnitude of its own components. After every few dimensions
each candidate's score lies between the partial sum plus the least, and plus the most, that the remaining dimensions can add; a bitmap
keeps the candidates whose range still matters. Two searches follow each other:

1. positives: the best rows of the anchor's label; a row is out once its most is below the best rows' least.
2. negatives: rows of other labels inside the window of each positive; a row is out once its range misses every window, or its most is
   below the least of enough rows that are surely inside.

What is left is scored to the end, in exact integers. Anchors travel in packs of bounded size, each of which is joined with shelves of
blocks, so that a task holds one pack and one block at a time, and every task returns at most a few rows for each anchor. Nothing is
broadcast, and no block, label or vector is ever gathered whole.

Rows with a NULL id, label or vector, or with a component that is NULL, NaN or infinite, take no part. Rows of equal id are rows of their own: each is an
anchor, and a positive or negative to the others. Where scores and ids tie, rows are equal in all that is returned. Vectors of different lengths are compared as if the shorter
went on with zeros. An empty table gives no rows. Other columns are ignored. Components whose scaled value
exceeds 2**27 raise ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import by_task, load, materialised, ready
from wearline.llm.vectors import as_matrix, on_grid, usable

BLOCK_ROWS = 8192
PACK_ANCHORS = 256
# Dimensions read between two looks at the bitmap.
STEP = 8
# Integers up to here are exact in float64.
EXACT = 1 << 53
NONE = np.iinfo(np.int64).min

_BLOCK = "dims int, ids binary, labels binary, rows binary, anchors binary, columns binary"
_PACK = "pack long, dims int, labels binary, rows binary, vectors binary, wanted binary"


def _bytes(values: np.ndarray, kind: str = "<i8") -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _numbers(value: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(value, dtype=kind)


def _by_dimension(columns: bytes, dims: int, rows: bytes) -> np.ndarray:
    return _numbers(columns, "<i4").reshape(dims, len(rows) // 8)


def in_blocks(vectors: DataFrame, scale: int) -> DataFrame:
    """Blocks of up to ``BLOCK_ROWS`` rows of ``vectors`` (vec_id, label, embedding, row, anchor), stored by dimension."""

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        column = table["embedding"].combine_chunks()
        values, lengths = on_grid(column, scale)
        dims = int(lengths.max())
        labels = table["label"].to_numpy()
        order = np.argsort(labels, kind="stable")
        matrix = as_matrix(values, lengths, dims)[order]
        return pa.RecordBatch.from_pydict(
            {
                "dims": pa.array([dims], pa.int32()),
                "ids": [_bytes(table["vec_id"].to_numpy()[order])],
                "labels": [_bytes(labels[order])],
                "rows": [_bytes(table["row"].to_numpy()[order])],
                "anchors": [_bytes(table["anchor"].to_numpy()[order], "u1")],
                "columns": [_bytes(matrix.T, "<i4")],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(first, BLOCK_ROWS)
                if n + some.num_rows > BLOCK_ROWS:
                    yield block(held)
                    held, n = [], 0
                held.append(some)
                n += some.num_rows
        if n:
            yield block(held)

    return vectors.mapInArrow(by_task(run), _BLOCK)


def anchors_of(blocks: DataFrame) -> DataFrame:
    """The rows marked as anchors: row, vec_id, label, vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                chosen = np.flatnonzero(_numbers(b["anchors"], "u1"))
                vectors = _by_dimension(b["columns"], b["dims"], b["rows"])[:, chosen].T
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": _numbers(b["rows"])[chosen],
                        "vec_id": _numbers(b["ids"])[chosen],
                        "label": _numbers(b["labels"])[chosen],
                        "vector": pa.array([_bytes(v, "<i4") for v in vectors], pa.binary()),
                    }
                )

    return blocks.mapInArrow(by_task(run), "row long, vec_id long, label long, vector binary")


def in_packs(anchors: DataFrame) -> DataFrame:
    """Packs of up to ``PACK_ANCHORS`` rows of ``anchors`` (row, label, vector, wanted).

    ``wanted`` lists each anchor's positives; a pack holds their scores, padded to equal length.
    """

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = [_numbers(v, "<i4") for v in batch.column("vector").to_pylist()]
        dims = max(map(len, vectors))
        wanted = batch.column("wanted").to_pylist()
        scores = np.full((len(wanted), max(1, max(map(len, wanted)))), NONE, dtype=np.int64)
        for i, found in enumerate(wanted):
            scores[i, : len(found)] = [p["score"] for p in found]
        return pa.RecordBatch.from_pydict(
            {
                "pack": batch.column("row")[:1],
                "dims": pa.array([dims], pa.int32()),
                "labels": [_bytes(batch.column("label").to_numpy())],
                "rows": [_bytes(batch.column("row").to_numpy())],
                "vectors": [_bytes(np.stack([np.pad(v, (0, dims - len(v))) for v in vectors]), "<i4")],
                "wanted": [_bytes(scores)],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PACK_ANCHORS):
                yield pack(batch.slice(first, PACK_ANCHORS))

    return anchors.select("row", "label", "vector", "wanted").mapInArrow(by_task(run), _PACK)


@dataclass
class Block:
    """Vectors by dimension, sorted by label."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    columns: np.ndarray

    def __post_init__(self) -> None:
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def search(self, vector: np.ndarray, candidates: np.ndarray, narrowed) -> tuple[np.ndarray, np.ndarray]:
        """Positions that survive and their exact scores.

        ``narrowed(least, most)`` says which candidates still matter, given the range of each one's score.
        """
        dims = min(len(vector), len(self.columns))
        vector, columns = vector[:dims], self.columns[:dims]
        order = np.argsort(-np.abs(vector), kind="stable")
        ends = np.stack([vector * self.low[:dims], vector * self.high[:dims]])[:, order]
        # What the dimensions from each place on can add.
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        reach = np.abs(vector).astype(float) @ np.maximum(np.abs(self.low), np.abs(self.high))[:dims].astype(float)
        if reach >= EXACT:
            raise ValueError("scores beyond 2**53 are not exact")
        query = vector.astype(np.float64)
        partial = np.zeros(len(candidates))
        everything = len(candidates) == columns.shape[1]
        for at in range(0, dims, STEP):
            some = order[at : at + STEP]
            read = columns[some] if everything else columns[some[:, None], candidates]
            partial += query[some] @ read
            done = min(at + STEP, dims)
            stays = narrowed(partial + least[done], partial + most[done])
            if not stays.all():
                candidates, partial, everything = candidates[stays], partial[stays], False
            if not len(candidates):
                break
        return candidates, partial.astype(np.int64)


@dataclass
class Best:
    """The best rows so far, by descending score and ascending id."""

    size: int
    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, size: int) -> Best:
        return cls(size, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def floor(self) -> float:
        """No row below this can be among the best."""
        return self.scores[-1] if len(self.scores) == self.size else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        reaching = scores >= self.floor()
        scores, ids = np.append(self.scores, scores[reaching]), np.append(self.ids, ids[reaching])
        order = np.lexsort((ids, -scores))[: self.size]
        self.scores, self.ids = scores[order], ids[order]


def _floor(least: np.ndarray, size: int) -> float:
    """A score that ``size`` of the candidates surely reach."""
    return np.partition(least, -size)[-size] if len(least) >= size else -np.inf


@dataclass
class Anchor:
    """One anchor of a pack and what it has found in a shelf; ``windows`` are (lowest, highest score) or None for positives."""

    row: int
    label: int
    vector: np.ndarray
    windows: list[tuple[int, int]] | None
    best: list[Best]

    def look(self, block: Block) -> None:
        begin, end = np.searchsorted(block.labels, [self.label, self.label + 1])
        if self.windows is None:
            same = np.arange(begin, end)
            self._positives(block, same[block.rows[same] != self.row])
        elif self.windows:
            self._negatives(block, np.concatenate([np.arange(begin), np.arange(end, len(block.labels))]))

    def _positives(self, block: Block, candidates: np.ndarray) -> None:
        best = self.best[0]

        def narrowed(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            return most >= max(best.floor(), _floor(least, best.size))

        found, scores = block.search(self.vector, candidates, narrowed)
        best.add(scores, block.ids[found])

    def _negatives(self, block: Block, candidates: np.ndarray) -> None:
        def narrowed(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            stays = np.zeros(len(least), dtype=bool)
            for (low, high), best in zip(self.windows, self.best, strict=True):
                inside = (least >= low) & (most <= high)
                stays |= (least <= high) & (most >= max(low, best.floor(), _floor(least[inside], best.size)))
            return stays

        found, scores = block.search(self.vector, candidates, narrowed)
        for (low, high), best in zip(self.windows, self.best, strict=True):
            inside = (scores >= low) & (scores <= high)
            best.add(scores[inside], block.ids[found[inside]])


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest whole score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def searched(packs: DataFrame, blocks: DataFrame, size: int, bounds: tuple[int, int] | None) -> DataFrame:
    """The best rows of each shelf: row of the anchor, place of the window, score, vec_id.

    Without ``bounds`` rows of the anchor's label are looked for, else rows of other labels whose score is within these
    percentages of each wanted score.
    """
    spark = blocks.sparkSession
    # Every pack meets every shelf once; the result does not depend on how many there are.
    shelves = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shelved = blocks.drop("anchors").withColumn("shelf", F.pmod(F.xxhash64("rows"), F.lit(shelves)).cast("int"))
    used = [r.shelf for r in shelved.select("shelf").distinct().collect()]
    names = [f"b_{c}" for c in ("dims", "ids", "labels", "rows", "columns")]
    shelved = shelved.withColumnsRenamed({n.removeprefix("b_"): n for n in names})
    sent = packs.withColumn("shelf", F.explode(F.array(*map(F.lit, used)) if used else F.array().cast("array<int>")))

    def anchors(p: dict) -> list[Anchor]:
        labels, rows = _numbers(p["labels"]), _numbers(p["rows"])
        vectors = _numbers(p["vectors"], "<i4").reshape(len(rows), p["dims"]).astype(np.int64)
        wanted = _numbers(p["wanted"]).reshape(len(rows), -1)
        out = []
        for i, vector in enumerate(vectors):
            windows = None
            if bounds:
                windows = [window(int(s), *bounds) for s in wanted[i] if s != NONE]
            found = [Best.none(size) for _ in ([None] if windows is None else windows)]
            out.append(Anchor(int(rows[i]), int(labels[i]), vector, windows, found))
        return out

    def found(held: list[Anchor]) -> pa.RecordBatch:
        hits = [(a.row, w, s, i) for a in held for w, b in enumerate(a.best) for s, i in zip(b.scores, b.ids, strict=True)]
        columns = zip(*hits, strict=True) if hits else [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ("row", "place", "score", "vec_id")
        return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a pack usually follow each other, so that what one block showed narrows the search of the next.
        current, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                (p,) = batch.slice(i, 1).to_pylist()
                if p["pack"] != current:
                    if held:
                        yield found(held)
                    current, held = p["pack"], anchors(p)
                columns = _by_dimension(p["b_columns"], p["b_dims"], p["b_rows"]).astype(np.float64)
                block = Block(_numbers(p["b_ids"]), _numbers(p["b_labels"]), _numbers(p["b_rows"]), columns)
                for anchor in held:
                    anchor.look(block)
        if held:
            yield found(held)

    return sent.join(shelved, "shelf").drop("shelf").mapInArrow(by_task(run), "row long, place int, score long, vec_id long")


def best_of(hits: DataFrame, size: int) -> DataFrame:
    """The best ``size`` hits of each anchor and window, numbered from 1 in the column ``rank``."""
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 5,
    bounds: tuple[int, int] = (80, 100),
    scale: int = 256,
) -> DataFrame:
    """For each anchor of ``vectors`` (vec_id, label, embedding) and each of its positives, the hardest negatives.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. A negative's score is within
    ``bounds`` per cent of the positive's.
    """
    ready(vectors.sparkSession, times=2)
    there = usable(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    rows = vectors.where(there).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        "embedding",
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    # Stored, as row numbers must hold from here on.
    blocks = materialised(in_blocks(rows, scale), "vector-blocks")
    anchors = anchors_of(blocks)
    wanted = "array<struct<rank:int,score:bigint,vec_id:bigint>>"
    packs = in_packs(anchors.withColumn("wanted", F.array().cast(wanted)))
    near = best_of(searched(packs, blocks, positives, None), positives)
    # At most ``positives`` entries per anchor.
    listed = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("wanted"))
    asked = materialised(anchors.join(listed, "row"), "anchors")
    hits = best_of(searched(in_packs(asked), blocks, negatives, bounds), negatives)
    of = F.element_at("wanted", F.col("place") + 1)
    return hits.join(asked.select("row", F.col("vec_id").alias("anchor_id"), "wanted"), "row").select(
        "anchor_id",
        of["vec_id"].alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        of["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives in the whole table ``embeddings``; anchors are the ids divisible by 100, one id in seven has a wrong label."""
    vectors = load(spark, sf_dir, "embeddings")
    wrong = (F.col("label") + 1) % 10
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, wrong).otherwise(F.col("label")))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)
