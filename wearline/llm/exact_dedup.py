"""Exact dedup by composable polynomial fingerprints.

A text is a polynomial in its bytes modulo two primes. Texts are cut into chunks that are hashed independently of
each other, and the hash of a text follows from those of its chunks by shifting each by the length before it:
``H(AB) = H(A) + base**len(A) * H(B)``. Texts with equal fingerprint and length are then compared chunk by chunk;
a group whose chunks differ is split by the chunks themselves, so a collision never merges texts.

NULL text counts as empty, all empty texts are equal. Rows repeated with the same id stay apart: exactly one row of
a group is kept, and among rows with the largest id any one of them. A NULL id is smaller than all others. An
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import by_column, load, materialised, only, ready, row_key, utf8
from wearline.session import broadcast_if_small

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_213_961_297, 1_957_433_011)
CHUNK = 1024
# Bytes compared at a time.
COMPARED = 16_384
# Chunks hashed at a time: bounds the working memory at about 32 MB.
AT_ONCE = 4096


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo prime."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, step = 1, base % prime
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step) % np.uint64(prime)
        done, step = done + more, step * step % prime
    return out[:n]


def combine(left: tuple[int, ...], left_length: int, right: tuple[int, ...], primes=PRIMES, bases=BASES):
    """The fingerprint of AB from those of A and B and the length of A."""
    return tuple(
        (a + pow(base, left_length, prime) * b) % prime
        for a, b, prime, base in zip(left, right, primes, bases, strict=True)
    )


def chunk_hashes(chunks: np.ndarray, primes=PRIMES, bases=BASES) -> np.ndarray:
    """Hashes of zero-padded chunks, one row each. Exact: sums stay below 2**8 * 2**31 * 2**10."""
    table = np.stack([powers(b, p, chunks.shape[1]) for p, b in zip(primes, bases, strict=True)], axis=1)
    sums = chunks.astype(np.float64) @ table.astype(np.float64)
    return sums.astype(np.uint64) % np.array(primes, dtype=np.uint64)


def fingerprints(texts: list[bytes], primes=PRIMES, bases=BASES) -> np.ndarray:
    """One row per text and one column per prime."""
    counts = np.array([-(-len(t) // CHUNK) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), len(primes)), dtype=np.uint64)
    if not counts.sum():
        return out
    shifts = np.stack(
        [powers(pow(b, CHUNK, p), p, int(counts.max())) for p, b in zip(primes, bases, strict=True)], axis=1
    )
    modulus = np.array(primes, dtype=np.uint64)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    for first in range(0, len(owner), AT_ONCE):
        rows = slice(first, first + AT_ONCE)
        block = b"".join(
            texts[o][k * CHUNK : (k + 1) * CHUNK].ljust(CHUNK, b"\0")
            for o, k in zip(owner[rows].tolist(), place[rows].tolist(), strict=True)
        )
        hashes = chunk_hashes(np.frombuffer(block, np.uint8).reshape(-1, CHUNK), primes, bases)
        np.add.at(out, owner[rows], hashes * shifts[place[rows]] % modulus)
    return out % modulus


def fingerprint_column(text: Column, primes=PRIMES, bases=BASES) -> Column:
    """Length and fingerprint of a text as one string."""

    def compute(column: pa.Array) -> pa.Array:
        texts = utf8(column)
        marks = fingerprints(texts, primes, bases).tolist()
        return pa.array([f"{len(t)}:" + "".join(f"{h:08x}" for h in m) for t, m in zip(texts, marks, strict=True)])

    return by_column(compute, "string")(text)


def _chunks(docs: DataFrame, keys: DataFrame, primes, bases) -> DataFrame:
    """Rows (_key, _print, _no, _chunk) of all texts whose fingerprint is in ``keys``."""
    size = F.length("_data")
    parts = F.transform(
        F.sequence(F.lit(0), F.ceil(size / COMPARED).cast("int") - 1),
        lambda i: F.struct(
            i.alias("_no"), F.substring(F.col("_data"), i * COMPARED + 1, F.lit(COMPARED)).alias("_chunk")
        ),
    )
    return (
        docs.select("doc_id", "text")
        .withColumn("_print", fingerprint_column(F.col("text"), primes, bases))
        .join(broadcast_if_small(keys), "_print", "left_semi")
        .select(row_key().alias("_key"), "_print", F.col("text").cast("binary").alias("_data"))
        .where(size > 0)
        .select("_key", "_print", F.inline(parts))
    )


def _split(marks: DataFrame, chunks: DataFrame) -> DataFrame:
    """``marks`` with the classes of colliding fingerprints told apart by which variant of each chunk they hold."""
    variants = chunks.groupBy("_print", "_no", "_chunk").count().drop("count")
    numbered = variants.withColumn(
        "_variant", F.row_number().over(Window.partitionBy("_print", "_no").orderBy("_chunk"))
    )
    held = F.array_sort(F.collect_set(F.struct("_no", "_variant")))
    numbers = (
        chunks.join(numbered, ["_print", "_no", "_chunk"])
        .groupBy("_key")
        .agg(F.concat_ws(",", F.transform(held, lambda v: v["_variant"].cast("string"))).alias("_numbers"))
    )
    return marks.join(numbers, "_key", "left").withColumn("_class", F.concat_ws("/", "_class", "_numbers"))


def exact_groups(docs: DataFrame, *, primes=PRIMES, bases=BASES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its group of equal texts.

    Returns doc_id, keep_id, group_size, kept, text_sha256, fingerprint and _key (see ``row_key``).
    """
    ready(docs.sparkSession)
    marks = materialised(
        docs.select(
            "doc_id",
            fingerprint_column(F.col("text"), primes, bases).alias("_print"),
            row_key().alias("_key"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "exact-marks",
    )
    several = marks.groupBy("_print").count().where("count > 1").select("_print")
    # Equal chunks collapse inside each task, so copies never meet in one place as rows.
    variants = _chunks(docs, several, primes, bases).groupBy("_print", "_no", "_chunk").count()
    differing = materialised(
        variants.groupBy("_print", "_no").count().where("count > 1").select("_print").distinct(), "exact-collisions"
    )
    marks = marks.withColumn("_class", F.col("_print"))
    if not differing.isEmpty():
        marks = _split(marks, _chunks(docs, differing, primes, bases))
    # Stored, so that the join below has plain exchanges, whose hot keys adaptive execution splits.
    classes = materialised(
        marks.groupBy("_class")
        .agg(F.count(F.lit(1)).alias("_size"), F.max(F.struct("doc_id", "_row")).alias("_winner"))
        .where("_size > 1"),
        "exact-classes",
    )
    alone = F.col("_size").isNull()
    return marks.join(broadcast_if_small(classes), "_class", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_winner.doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_row") == F.col("_winner._row"))).alias("kept"),
        F.substring_index("_key", ":", -1).alias("text_sha256"),
        F.col("_print").alias("fingerprint"),
        "_key",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id; columns as given."""
    return only(docs, exact_groups(docs).where("kept"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over the whole table ``documents``."""
    return exact_groups(load(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
