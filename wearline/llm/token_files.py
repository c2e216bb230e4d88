"""Token ids on disk, in ascending document order, coded with Simple-8b.

Documents are ranged and sorted by id, encoded, and written as segments: the ids of a run of documents as one coded
byte string, whose blocks can be read alone, next to the documents' ids and lengths. Segments are written by Spark's
own committer, so a lost executor or a repeated task leaves neither gaps nor copies. Shards (one per task) and
segments are numbered; the global position of a document follows from one count per shard.

NULL text counts as empty and has the end id only. A NULL doc_id comes before all others; documents with the same id
keep some order among themselves, fixed once written. An empty table writes no segments and reads as no rows. Other
columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm import simple8b
from wearline.llm.common import by_task, load, ready, spans
from wearline.llm.word_ids import REMEMBERED, WordEncoder, read_tokenizer
from wearline.session import broadcast_if_small, scratch

END = 1


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer: str) -> WordEncoder:
    """One encoder per Python worker, which keeps its words over tasks."""
    return WordEncoder(tokenizer, remembered=2 * REMEMBERED)


def write(docs: DataFrame, path: str, tokenizer: str, *, end: int = END) -> None:
    """Write the ids of ``docs`` (doc_id, text) with an end id each; ``tokenizer`` as in ``read_tokenizer``."""
    ready(docs.sparkSession, times=2)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        encode = _encoder(tokenizer).encode
        for number, batch in enumerate(batches):
            ids, counts = encode(batch.column("text"))
            # The end id goes behind each document.
            whole = np.insert(ids, np.cumsum(counts), end)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "segment": pa.array([number], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n_ids": pa.array([len(whole)], pa.int64()),
                    "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                    "lengths": pa.array([(counts + 1).tolist()], pa.list_(pa.int64())),
                    "data": pa.array([simple8b.encode(whole)], pa.binary()),
                }
            )
            before += len(whole)

    schema = (
        f"shard int, segment int, before long, n_ids long, doc_ids array<{kind}>, lengths array<bigint>, data binary"
    )
    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(by_task(run), schema)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of files written by :func:`write`; ids as little-endian 32-bit integers."""
    ready(spark)
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    # One row per shard.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    placed = segments.join(broadcast_if_small(starts), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["data"]).astype("<u4")
                lengths = np.array(row["lengths"], dtype=np.int64)
                places = spans(lengths)
                raw = ids.tobytes()
                ends = (places + lengths).tolist()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                        "start": pa.array(places + row["start"]),
                        "n_tokens": pa.array(lengths),
                        "ids": pa.array([raw[4 * a : 4 * b] for a, b in zip(places.tolist(), ends, strict=True)]),
                    }
                )

    return placed.select("doc_ids", "lengths", "data", (F.col("_first") + F.col("before")).alias("start")).mapInArrow(
        by_task(run), f"doc_id {kind}, start long, n_tokens long, ids binary"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table ``documents`` written as ids and read back."""
    import public_tokenizers

    path = scratch(spark, "token-files")
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    write(load(spark, sf_dir, "documents"), path, tokenizer)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
