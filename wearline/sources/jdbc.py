"""Tables kept in a relational database.

The driver jar of the database must be on the class path of the session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    column: str = "id",
    bounds: tuple[int, int],
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """``table`` read in ``partitions`` parallel ranges of ``column``; filters are pushed down."""
    low, high = bounds
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write ``df`` to ``table`` from all its tasks."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))
