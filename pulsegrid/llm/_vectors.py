"""Integer vectors, and exact squared distances between them, for the clustering operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integer components end here on either side, so that squared distances of 128 components fit 64 bits.
LARGEST = 1 << 27
#: Below this, sums of products of integers are exact in double precision.
_EXACT = float(1 << 52)


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, between the two largest integers."""
    return F.transform(vector, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))


def squared_distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances (rows of x, points) of integer vectors, as int64."""
    most = float(max(np.abs(x).max(initial=0), np.abs(points).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < _EXACT:
        x, points = x.astype(np.float64), points.astype(np.float64)
        d = (x * x).sum(1)[:, None] - 2 * (x @ points.T) + (points * points).sum(1)[None, :]
        return d.astype(np.int64)
    x, points = x.astype(np.int64), points.astype(np.int64)
    return np.stack([((x - p) ** 2).sum(1) for p in points], axis=1) if len(points) else np.empty((len(x), 0), np.int64)
