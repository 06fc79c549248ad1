"""Helpers for vector operators: valid rows, bounded samples, centroids, batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_vector(x: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0)


def usual_length(vectors: DataFrame, column: str = "x") -> int:
    """The most frequent vector length (the smaller one of a tie); 0 for an empty table."""
    row = vectors.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else 0


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column of one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, dims))
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dims)


def sample(vectors: DataFrame, key: str, column: str, total: int, bound: int, dims: int, seed: int) -> np.ndarray:
    """At most ``bound`` vectors: those of least seeded hash, the same on every run."""
    share = min(1.0, 2.0 * bound / max(total, 1))
    drawn = vectors.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) < int(np.ceil(share * 1_000_000)))
    rows = drawn.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(bound).select(column).toArrow()
    return matrix(rows.column(0), dims)


def centroids(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means over a bounded sample."""
    rng = np.random.default_rng(seed)
    if not len(points):
        return np.zeros((1, points.shape[1] if points.ndim == 2 else 0))
    k = max(1, min(k, len(points)))
    c = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        own = (points @ c.T - 0.5 * (c**2).sum(1)).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=k)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def list_array(x: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Matrix rows as a list column."""
    n, d = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(x.ravel(), kind))
