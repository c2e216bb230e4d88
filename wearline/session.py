"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
# Of a value whose width its type does not tell.
UNKNOWN_BYTES = 1024

SETTINGS = {
    # A value that does not parse, or an integer that overflows, must stop the job.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows placed by (id) need not move again for a join on (id, cycle).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # Java does not compile methods above 8,000 bytes of code; expressions over 66 features in one loop are far above. Spark
    # then cuts them into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="wearline-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: what the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call was given."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in reliable storage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path made by :func:`scratch`."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, for jobs that pass over it many times.

    The copy has a short lineage and outlives lost executors; it is deleted at the end.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    try:
        df.write.partitionBy(*partition_by).parquet(path)
        yield spark.read.schema(df.schema).parquet(path).select(*df.columns)
    finally:
        discard(spark, path)


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes up."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.StructType):
        return sum((value_bytes(value[f.name], f.dataType) for f in kind), F.lit(8))
    if isinstance(kind, T.ArrayType):
        size = F.greatest(F.size(value), F.lit(0))
        if isinstance(kind.elementType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            return 8 * size + 16
        total = F.aggregate(value, F.lit(16).cast("long"), lambda s, x: s + value_bytes(x, kind.elementType).cast("long"))
        return F.coalesce(total, F.lit(0).cast("long"))
    if isinstance(kind, (T.AtomicType, T.NullType)):
        return F.lit(8)
    return F.lit(UNKNOWN_BYTES)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` hinted for broadcast if it has at most MAX_BROADCAST_ROWS rows of MAX_BROADCAST_BYTES in all, else as it is.

    Meant for tables that are cheap to read twice. Past the bound the
    join shuffles and adaptive execution splits its hot keys.
    """
    size = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(16))
    found = df.limit(MAX_BROADCAST_ROWS + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes")
    )
    n, held = found.first()
    return F.broadcast(df) if n <= MAX_BROADCAST_ROWS and held <= MAX_BROADCAST_BYTES else df
