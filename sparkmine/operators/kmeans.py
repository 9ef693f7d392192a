"""K-means over ``(id, v array<double>)`` points.

* assign (nearest centroid, squared Euclidean, exact, ties to the lowest centroid id): one
  vectorised numpy pass over each Arrow batch, with the k x d centroids (bounded by the
  parameters, never by the data) shipped with the task.
* update (mean of members): each task sums its members into one row per centroid, so k
  rows of d sums per task cross the shuffle; a hot cluster costs nothing extra.
* fit: a driver loop that collects only the k x d new centroid values per round. An
  empty cluster disappears (k shrinks), as in the reference. Points are persisted
  (memory and disk, recomputed from the parquet scan if an executor is lost).

A point that is null, has another length than the centroids, or holds a null, NaN or an
infinite component has no nearest centroid (and doesn't start as one): its ``cid`` and ``dist`` are null, and it belongs to no cluster.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pandas alone

Centroids = Sequence[tuple[int, Sequence[float]]]
ROWS_AT_ONCE = 4096
# A centroid that moves by no more than this share of its length has stayed: sums in
# another order differ by as much.
STAYED = 1e-12


class Fit(NamedTuple):
    centroids: list[tuple[int, list[float]]]
    rounds: int
    converged: bool


def _matrix(centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    if not centroids:
        raise ValueError("no centroids")
    ordered = sorted((int(c), [float(x) for x in v]) for c, v in centroids)
    return np.array([c for c, _ in ordered]), np.array([v for _, v in ordered], dtype=np.float64)


def _points(vectors: pd.Series, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are points of ``dims`` numbers, their matrix)."""
    usable = [i for i, v in enumerate(vectors) if v is not None and len(v) == dims]
    x = np.array([np.asarray(vectors.iat[i], dtype=np.float64) for i in usable]).reshape(len(usable), dims)
    whole = np.isfinite(x).all(axis=1)  # a null arrives as NaN
    return np.array(usable, dtype=np.int64)[whole], x[whole]


def _nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); of equal ones the first."""
    best, dist = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
    for j, c in enumerate(centroids):
        d = ((x - c) ** 2).sum(axis=1)
        nearer = d < dist
        best[nearer], dist[nearer] = j, d[nearer]
    return best, dist


def assign(points: DataFrame, centroids: Centroids, vec: str = "v") -> DataFrame:
    """Adds ``cid`` (nearest centroid id) and ``dist`` (squared distance) to every point."""
    ids, matrix = _matrix(centroids)
    kind = T.StructType([T.StructField("cid", T.LongType()), T.StructField("dist", T.DoubleType())])

    @F.pandas_udf(kind)
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            rows, x = _points(vectors, matrix.shape[1])
            out = pd.DataFrame({"cid": pd.array([None] * len(vectors), dtype="Int64"), "dist": pd.array([None] * len(vectors), dtype="Float64")})
            for at in range(0, len(rows), ROWS_AT_ONCE):
                best, dist = _nearest(x[at:at + ROWS_AT_ONCE], matrix)
                out.iloc[rows[at:at + ROWS_AT_ONCE], 0] = ids[best]
                out.iloc[rows[at:at + ROWS_AT_ONCE], 1] = dist
            yield out

    kept = [c for c in points.columns if c not in ("cid", "dist")]
    return points.withColumn("_n", nearest(F.col(vec))).select(*kept, F.col("_n.cid").alias("cid"), F.col("_n.dist").alias("dist"))


def _means(partials: DataFrame) -> DataFrame:
    """(cid, n, sums) of each task to the long form (cid, dim, x)."""
    long = partials.select("cid", "n", F.posexplode("sums").alias("dim", "s"))
    return long.groupBy("cid", "dim").agg((F.sum("s") / F.sum("n")).alias("x"))


_PARTIAL = "cid long, n long, sums array<double>"


def update(assigned: DataFrame, vec: str = "v") -> DataFrame:
    """New centroids in long form ``(cid, dim, x)``: per-dimension means of members."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for batch in batches:
            member = batch[batch["cid"].notna()]
            for cid, own in member.groupby("cid")[vec]:
                x = np.array(own.tolist(), dtype=np.float64)
                seen = total.setdefault(int(cid), [0, np.zeros(x.shape[1])])
                seen[0] += len(x)
                seen[1] += x.sum(axis=0)
        yield pd.DataFrame([(c, n, s) for c, (n, s) in total.items()], columns=["cid", "n", "sums"])

    return _means(assigned.select("cid", vec).mapInPandas(sums, _PARTIAL))


def step(points: DataFrame, centroids: Centroids, vec: str = "v") -> DataFrame:
    """Assign and update in one pass: the new centroids as ``(cid, dim, x)``."""
    ids, matrix = _matrix(centroids)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(len(ids), dtype=np.int64), np.zeros(matrix.shape)
        for batch in batches:
            _, x = _points(batch[vec], matrix.shape[1])
            for at in range(0, len(x), ROWS_AT_ONCE):
                part = x[at:at + ROWS_AT_ONCE]
                best, _ = _nearest(part, matrix)
                n += np.bincount(best, minlength=len(ids))
                for j in np.unique(best):
                    total[j] += part[best == j].sum(axis=0)
        yield pd.DataFrame([(int(ids[j]), int(n[j]), total[j]) for j in np.flatnonzero(n)], columns=["cid", "n", "sums"])

    return _means(points.select(vec).mapInPandas(sums, _PARTIAL))


def _collect_centroids(long: DataFrame) -> list[tuple[int, list[float]]]:
    """The k x d centroid values to the driver (bounded by the parameters, not the data)."""
    cents: dict[int, dict[int, float]] = {}
    for r in long.collect():
        cents.setdefault(int(r["cid"]), {})[int(r["dim"])] = float(r["x"])
    return [(c, [v[i] for i in range(len(v))]) for c, v in sorted(cents.items())]


def initial_centroids(points: DataFrame, k: int, id_col: str = "vec_id", vec: str = "v",
                      seed: int | None = None) -> list[tuple[int, list[float]]]:
    """k starting points: the k lowest ids, or the k lowest ``xxhash64(id, seed)``
    (a repeatable sample without replacement). Ordered top-k, no full sort."""
    key = F.col(id_col) if seed is None else F.xxhash64(F.col(id_col), F.lit(seed))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = points.filter(finite).orderBy(key, F.col(id_col)).limit(k).select(vec).collect()
    return [(i, list(r[0])) for i, r in enumerate(rows)]


def movement(old: list[tuple[int, list[float]]], new: list[tuple[int, list[float]]]) -> float:
    """Total squared movement of the centroids that survived, without rounding noise."""
    prev, total = dict(old), 0.0
    for cid, v in new:
        moved = sum((a - b) * (a - b) for a, b in zip(prev[cid], v))
        if moved > STAYED**2 * sum(a * a for a in v):
            total += moved
    return total


def fit(points: DataFrame, k: int | None = None, init: list[tuple[int, list[float]]] | None = None,
        vec: str = "v", id_col: str = "vec_id", seed: int | None = None, max_iter: int = 100,
        tol: float = 0.0) -> Fit:
    """Iterate assign + update until the movement is ``<= tol`` (0 = unchanged) or
    ``max_iter`` rounds; ``converged`` tells which. No points: no centroids."""
    if init is None:
        if not k:
            raise ValueError("give k or init")
        init = initial_centroids(points, k, id_col, vec, seed)
    pts = points.select(vec).persist(StorageLevel.MEMORY_AND_DISK)
    cents, rounds, converged = init, 0, not init
    try:
        while rounds < max_iter and not converged:
            new = _collect_centroids(step(pts, cents, vec))
            rounds += 1
            converged = len(new) == len(cents) and movement(cents, new) <= tol
            cents = new
            if not cents:
                break
    finally:
        pts.unpersist()
    return Fit(cents, rounds, converged)
