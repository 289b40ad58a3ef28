"""What the two operators on embeddings share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, not zero, all components finite."""
    infinite = F.lit(float("inf"))
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite),
    )
    return F.coalesce(
        F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def stacked(column, dtype=np.float64) -> np.ndarray:
    """A matrix of an Arrow column of lists of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(column), -1)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2.0 * (a @ b.T)
    return np.maximum(out, 0.0)


def k_means(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids; an empty cluster restarts at the point farthest from its own centroid."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), k, replace=len(points) < k)].copy()
    for _ in range(rounds):
        distance = squared_distances(points, centres)
        nearest = distance.argmin(axis=1)
        count = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
        if not full.all():
            far = np.argsort(-distance[np.arange(len(points)), nearest])[: int((~full).sum())]
            centres[np.flatnonzero(~full)[: len(far)]] = points[far]
    return centres
