"""Helpers shared by the operators on documents."""

from __future__ import annotations

import ctypes
import functools
import shutil
import tempfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.session import scratch

Batches = Iterator[pa.RecordBatch]

# Rows and bytes that one Arrow batch may hold; they bound the memory of a Python worker.
BATCH_ROWS = 1024
BATCH_BYTES = 8 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession, times: int = 1) -> None:
    """Bound the Arrow batches sent to Python workers, as rows are whole texts, and send them this package.

    ``times`` as large batches suit work whose cost is by distinct word of a batch.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", times * BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", times * BATCH_BYTES)
    _send_package(spark.sparkContext.applicationId)


@functools.cache
def _send_package(application: str) -> None:
    """Once per application; the archive stays in the driver's temporary folder, from which Spark serves it."""
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='wearline-package-')}/{package.name}"
    SparkContext.getOrCreate().addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, more of them than run at a time."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def by_column(compute: Callable[[pa.Array], pa.Array], kind: str) -> Callable[..., Column]:
    """An Arrow function of one column that gives memory back after each batch."""

    def run(column: pa.Array) -> pa.Array:
        out = compute(column)
        give_back()
        return out

    return F.arrow_udf(run, kind)


def by_task(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow`` that gives memory back as it goes and at its end."""

    def kept(batches: Batches) -> Batches:
        for out in run(batches):
            yield out
            del out
            give_back()
        give_back()

    return kept


def materialised(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder once and read back.

    Cuts the lineage in storage that outlives executors and keeps values such as generated row ids
    stable for all later uses. Results may read the copy long after the call, so it stays until whoever owns the
    shared folder clears it.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key of a row that holds its id and its whole text; equal rows share it, NULLs included."""
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.concat_ws(":", ident, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names like these that ``docs`` has no column of."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``_key`` (see :func:`row_key`) in ``kept``; same columns.

    Both steps need rows of a key together, so the texts move once.
    """
    (key,) = fresh(docs, "_key")
    return (
        docs.withColumn(key, row_key())
        .join(kept.select(F.col("_key").alias(key)).distinct(), key, "left_semi")
        .dropDuplicates([key])
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def spans(lengths: np.ndarray) -> np.ndarray:
    """Start of each span when spans of these lengths follow each other."""
    starts = np.zeros(len(lengths), dtype=np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return starts


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s:s+n]`` for each (s, n), one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    where = np.repeat(starts - spans(lengths), lengths)
    where += np.arange(total)
    return values[where]


def held_out(doc_id: Column, modulus: int, remainder: int = 1) -> Column:
    """Whether crc32 of the id written as text leaves ``remainder``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def crc32_of_ids(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def in_chunks(items: list, size: int) -> Iterator[list]:
    for i in range(0, len(items), size):
        yield items[i : i + size]
