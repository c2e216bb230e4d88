"""Declared constraints as DataFrames of violations.

Each check returns the rows (or counts) that break it, so it can be reported,
stored, or turned into an error with :func:`require_empty`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHOWN = 5


class ConstraintViolation(ValueError):
    """Rows break a key, reference, not-null or domain constraint."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def stored_keys(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``new`` that ``stored`` already holds."""
    return new.select(*keys).join(stored.select(*keys), list(keys), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Child keys without a parent row, with their number of rows.

    ``keys`` maps child columns to parent columns. The child is counted per key
    before the join, so a frequent key crosses the shuffle once per task.
    NULL keys are no references and are left out.
    """
    used = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).dropna(subset=list(keys))
    known = parent.select(*[F.col(p).alias(c) for c, p in keys.items()])
    return used.join(known, list(keys), "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``column_name, n_null`` for ``columns``, from one aggregation."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])
    return totals.select(F.inline(pairs))


def outside_domain(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    """Rows whose value is not one of ``allowed``; NULL is left to the not-null check."""
    return df.where(~F.col(column).isin(list(allowed)))


def require_empty(violations: DataFrame, message: str) -> None:
    """Raise :class:`ConstraintViolation` naming a few rows if there are any."""
    rows = violations.limit(SHOWN).collect()
    if rows:
        raise ConstraintViolation(f"{message}, e.g. {[row.asDict() for row in rows]}")


def require_not_null(df: DataFrame, columns: Sequence[str], message: str) -> int:
    """Raise if a required column has NULLs; returns the number of rows of the same pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    ).first()
    missing = {c: counted[c] for c in columns if counted[c]}
    if missing:
        raise ConstraintViolation(f"{message}: NULL in {missing}")
    return counted["_n"]


def require_key(df: DataFrame, key: Sequence[str], message: str, required: Sequence[str] = ()) -> int:
    """Raise if ``key`` identifies no row or several, or a key or required column has NULLs; returns the rows.

    One grouping by key tells it all; rows are looked up only to name some that are wrong.
    """
    required = [c for c in required if c not in key]
    nulls = {c: F.sum(F.when(F.col(c).isNull(), F.col("_n")).otherwise(0)) for c in key}
    groups = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required]
    )
    counted = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
        F.count_if((F.col("_n") > 1) & ~_any_null(key)).alias("_repeated"),
        *[n.alias(c) for c, n in nulls.items()],
        *[F.sum(c).alias(c) for c in required],
    ).first()
    missing = {c: counted[c] for c in (*key, *required) if counted[c]}
    if missing:
        raise ConstraintViolation(f"{message}: NULL in {missing}")
    if counted["_repeated"]:
        require_empty(duplicate_keys(df, key), f"{message}: key occurs twice")
    return counted["_n"]


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def require_rows(df: DataFrame, k: int, purpose: str) -> None:
    """Raise ValueError unless ``df`` has at least ``k`` rows, without counting beyond that."""
    n = df.limit(k).count()
    if n < k:
        raise ValueError(f"need at least {k} rows to {purpose}, got {n}")


def require_label(df: DataFrame, label: str, allowed: Sequence[str]) -> None:
    if label not in allowed:
        raise ValueError(f"label must be {' or '.join(map(repr, allowed))}, got {label!r}")
    if label not in df.columns:
        raise ValueError(f"label column {label!r} missing; columns are {df.columns}")
