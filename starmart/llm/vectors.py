"""Vectors in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Neither null nor empty, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A row per vector in double precision; shorter ones end in zeros."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    found = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    found[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return found
