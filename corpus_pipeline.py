"""From raw documents to packed sequences: toxicity, exact dedup, near-dedup, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
stage works on what the one before it kept, written as Parquet and read again.

NULL text counts as empty in every stage: it is not toxic, equals other empty texts, and ends as one id. A NULL id is an id
like any other: of equal texts, or near ones, a row with an id goes before one without; rows that are equal in
id and text count as one. Further columns, whatever their names, come back as they were from all stages but the last. An empty
table stays empty.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wearline.llm import exact_dedup, packing, secret_scan, simhash, toxicity  # noqa: E402
from wearline.llm.common import load, materialised  # noqa: E402
from wearline.llm.word_ids import read_tokenizer  # noqa: E402

# SQL can't express the trained models, the fingerprints' linking or the tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the classifier chain, trained on all labelled documents of the table, calls toxic."""
    chain = toxicity.train(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return toxicity.kept_documents(docs, chain)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 3-word shingles at most 3 bits apart, that with the smallest id."""
    return simhash.kept_documents(docs, words_each=3, max_bits=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of sequences of 2048 ids."""
    import public_tokenizers

    return packing.packed(docs, read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
