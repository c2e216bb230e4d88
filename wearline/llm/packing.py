"""Packing of tokenised documents into sequences by the sum-of-squares rule.

Documents are encoded, ended with an end id and cut into pieces only where they are longer than a sequence. A piece
goes where the sum over all residual gaps of the squared number of open sequences with that gap becomes smallest,
be that an open sequence or a new one; full sequences leave the count. Pieces are packed in shares of a bounded number
of tokens, longest first, each inside one task, so the work needs no shuffle and grows with the input only.

NULL text counts as empty and gives one piece with the end id. Repeated rows, equal and NULL ids are packed each for
themselves. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import by_task, load, ready
from wearline.llm.word_ids import WordEncoder, read_tokenizer

LENGTH = 2048
END = 0
# Tokens packed together; 32 MB of ids.
SHARE = 8 << 20


class SquaresPacker:
    """Places lengths one by one; ``counts[g]`` is the number of open bins with gap g."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.bins = 0

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of this length."""
        counts, size = self.counts, self.size
        # Moving a bin from gap g to g - length changes the sum by 2 (n[g - length] - n[g] + 1); closing one by
        # 1 - 2 n[g], and opening one by 2 n[size - length] + 1.
        before = counts[length:]
        change = 2 * (counts[: size + 1 - length] - before) + 2
        change[0] = 1 - 2 * before[0]
        change[before == 0] = np.iinfo(np.int64).max
        change[size - length] = 2 * counts[size - length] + 1 if length < size else 0
        gap = length + int(np.argmin(change))
        if gap == size:
            where, self.bins = self.bins, self.bins + 1
        else:
            where = self.open[gap].pop()
            counts[gap] -= 1
        if gap > length:
            self.open[gap - length].append(where)
            counts[gap - length] += 1
        return where, size - gap


def pack(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, longest first, and the number of bins."""
    packer = SquaresPacker(size)
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], offsets[i] = packer.place(int(lengths[i]))
    return bins, offsets, packer.bins


def _pieces(doc_ids: list, ids: np.ndarray, counts: np.ndarray, size: int, end: int) -> Iterator[tuple]:
    """(doc_id, piece, start, ids) of each document with its end id."""
    first = 0
    for doc_id, n in zip(doc_ids, counts.tolist(), strict=True):
        whole = np.append(ids[first : first + n], end).astype("<u4")
        first += n
        for k in range(0, n + 1, size):
            yield doc_id, k // size, k, whole[k : k + size]


def packed(docs: DataFrame, tokenizer: str, *, length: int = LENGTH, end: int = END, share: int = SHARE) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their places: sequence_id, offset, and their ids as 32-bit integers.

    ``tokenizer`` is the content of a tokenizer file, see ``read_tokenizer``.
    """
    ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, sequence_id long, offset long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One encoder per task: a Python worker that goes on to other work keeps none of its memory.
        encode = WordEncoder(tokenizer).encode
        bins_before = TaskContext.get().partitionId() << 36
        held: list[tuple] = []
        tokens = 0
        id_type = None

        def placed() -> Iterator[pa.RecordBatch]:
            nonlocal bins_before
            lengths = np.array([len(p[3]) for p in held], dtype=np.int64)
            bins, offsets, n = pack(lengths, length)
            for rows in np.array_split(np.arange(len(held)), -(-len(held) // 1024)):
                some = [held[i] for i in rows.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in some], id_type),
                        pa.array([p[1] for p in some], pa.int32()),
                        pa.array([p[2] for p in some], pa.int64()),
                        pa.array(lengths[rows]),
                        pa.array(bins[rows] + bins_before),
                        pa.array(offsets[rows]),
                        pa.array([p[3].tobytes() for p in some], pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"],
                )
            bins_before += n

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            ids, counts = encode(batch.column("text"))
            for piece in _pieces(batch.column("doc_id").to_pylist(), ids, counts, length, end):
                held.append(piece)
                tokens += len(piece[3])
                if tokens >= share:
                    yield from placed()
                    held, tokens = [], 0
        if held:
            yield from placed()

    return docs.select("doc_id", "text").mapInArrow(by_task(run), schema)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table ``documents`` packed into sequences of 2048 ids."""
    import public_tokenizers

    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return packed(load(spark, sf_dir, "documents"), tokenizer).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
