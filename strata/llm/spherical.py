"""Unit vectors, sound rows and spherical k-means on a bounded sample, for the vector operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 20240502


def is_sound(vector: Column) -> Column:
    """True for vectors that are not NULL or empty and hold finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component: exact, and no square over- or underflows."""
    most = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1]
    return np.ldexp(np.ldexp(vectors, -(most // 2)), -(most - most // 2))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is divided out first, so no square over- or underflows.
    Zero rows stay zero."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / np.where(most > 0, most, 1.0)
    length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / np.where(length > 0, length, 1.0)


def sample(rows: DataFrame, vec_col: str, size: int) -> dict[int, np.ndarray]:
    """At most ``size`` rows in the order of a hash, as unit vectors per vector length.

    Each task keeps its ``size`` smallest hashes, so neither it nor the driver holds more.
    """
    few = rows.select(F.col(vec_col).alias("v")).orderBy(F.xxhash64("v"), F.size("v")).limit(size).toArrow()
    by_dim: dict[int, list] = {}
    for v in few["v"].to_pylist():
        by_dim.setdefault(len(v), []).append(v)
    return {dim: unit(np.asarray(v, np.float64)) for dim, v in by_dim.items()}


def dense_first(points: np.ndarray, cosine: float, most: int) -> np.ndarray:
    """Up to ``most`` seeds: again and again the point with the most others within ``cosine``, whose
    ball then leaves; lone points follow in the given order."""
    near = np.concatenate([points[i : i + 512] @ points.T >= cosine for i in range(0, len(points), 512)])
    free, seeds = np.ones(len(points), bool), []
    degree = near.sum(axis=1)
    while len(seeds) < most and free.any():
        at = int(np.argmax(np.where(free, degree, -1)))
        seeds.append(at)
        gone = np.flatnonzero(near[at] & free)
        free[gone] = False
        degree = degree - near[:, gone].sum(axis=1)
    return points[seeds]


def spherical_kmeans(points: np.ndarray, k: int, cosine: float = 0.95, rounds: int = 8) -> np.ndarray:
    """At most ``k`` unit centroids of unit points; of two closer than ``cosine`` the emptier one is left out."""
    centroids = dense_first(points, cosine, k)
    for _ in range(rounds):
        home = (points @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, points)
        lost = np.abs(sums).max(axis=1) == 0
        centroids = unit(np.where(lost[:, None], centroids, sums))
    filled = np.bincount((points @ centroids.T).argmax(axis=1), minlength=len(centroids))
    kept: list[int] = []
    for at in np.argsort(-filled, kind="stable"):
        if not kept or (centroids[kept] @ centroids[at]).max() < cosine:
            kept.append(int(at))
    return centroids[kept]
