"""Vectors in tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and has neither NULL nor NaN nor infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column in double precision; shorter vectors go on with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype("float64")
    sizes = np.diff(offsets)
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((len(sizes), width))
    if len(sizes) and (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width).copy()
    for k, (start, size) in enumerate(zip(offsets.tolist(), sizes.tolist(), strict=False)):
        out[k, :size] = flat[start : start + size]
    return out


def widened(vectors: np.ndarray, width: int) -> np.ndarray:
    return vectors if vectors.shape[1] == width else np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
