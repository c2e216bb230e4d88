"""Rows of vectors as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Squares of differences of such components, and products of them, add up within 64 bits for 64 components.
LARGEST = 1 << 27


def usable(embedding: Column, size: int | None = None) -> Column:
    """Whether a vector is there, all its components are finite and, with ``size``, as many as that."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    there = embedding.isNotNull() & finite
    there = there if size is None else there & (F.size(embedding) == size)
    return F.coalesce(there, F.lit(False))


def on_grid(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of all components, one vector after the other, and the length of each vector.

    Raises for components that do not fit the exact arithmetic (see ``LARGEST``).
    """
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(column.flatten().cast(pa.float64()).to_numpy() * scale)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"components times {scale} must not exceed {LARGEST}, got {np.abs(values).max()}")
    return values.astype(np.int64), lengths


def as_matrix(values: np.ndarray, lengths: np.ndarray, dims: int) -> np.ndarray:
    """One row per vector; missing components are 0."""
    out = np.zeros((len(lengths), dims), dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out
